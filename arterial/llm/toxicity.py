"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exception phrases.

Folding lower-cases, turns homoglyphs into the letters they imitate, digits and signs inside words into the letters they
replace, and everything that is no letter into a space. The lexicon (whole words, word beginnings, and short phrases that
excuse a word) and its weights are learned from labelled texts; matching it is one pass of an automaton over the text.

Defined cases: null, empty and wordless texts get the score of a text without matches; repeated rows get equal scores;
without labels of both kinds every score is the share of toxic labels (0 if there are none); columns named like results
are replaced; several labels of one document count as toxic if any is.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arterial.llm import text as tx

HOLD_OUT = 5
SAMPLE_ROWS = 2500  # labelled texts per label that the lexicon is fitted on
SAMPLE_CHARS, SAMPLE_PIECES = 30_000, 10
FIELDS = "score double, predicted int, matches array<string>"

# fixed values: characters that imitate Latin letters, and signs that replace them inside words
HOMOGLYPHS = {
    "а": "a", "ɑ": "a", "α": "a", "ь": "b", "с": "c", "ϲ": "c", "ԁ": "d", "е": "e", "ҽ": "e", "ε": "e", "ɡ": "g", "һ": "h",
    "і": "i", "ι": "i", "ı": "i", "ј": "j", "κ": "k", "к": "k", "ⅼ": "l", "ӏ": "l", "м": "m", "ո": "n", "η": "n", "о": "o",
    "ο": "o", "օ": "o", "р": "p", "ρ": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "τ": "t", "υ": "u", "ս": "u", "ν": "v",
    "ѵ": "v", "ԝ": "w", "ω": "w", "х": "x", "χ": "x", "у": "y", "γ": "y", "ᴢ": "z",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}


class _Fold(dict):
    """Translation table of one character each, filled as characters turn up. Signs stay until their word is known."""

    def __missing__(self, code: int) -> str:
        plain = unicodedata.normalize("NFKC", chr(code)).lower()
        plain = "".join(HOMOGLYPHS.get(c, c) for c in plain)
        self[code] = plain if all(c.isalpha() or c in SUBSTITUTES for c in plain) else " "
        return self[code]


_fold = _Fold()
_signs = str.maketrans(SUBSTITUTES)
_no_signs = str.maketrans({c: " " for c in SUBSTITUTES})
_sign_set = frozenset(SUBSTITUTES)


def fold(text: str) -> list[str]:
    """Folded words. A sign counts as a letter only between letters of the same word ("m0ron", not "no. 5" or "oh!")."""
    words = []
    for word in text.translate(_fold).split():
        if _sign_set.isdisjoint(word):
            words.append(word)
            continue
        core = word.strip("!") if not word.isalpha() else word
        if any(c.isalpha() for c in core):
            inner = core.translate(_signs) if not core[-1] in "$@" else core[:-1].translate(_signs)
            words += inner.split()
        else:
            words += core.translate(_no_signs).split()
    return words


class Lexicon:
    """Terms " word " (whole) and " begin" (word beginning) with weights, exception phrases, and the score's curve."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.excused: dict[str, float] = {}
        self.curve = np.zeros(4)
        self.automaton = None

    def build(self) -> "Lexicon":
        self.automaton = ahocorasick.Automaton()
        for term in {*self.weights, *self.excused}:
            self.automaton.add_word(term, term)
        if self.weights:
            self.automaton.make_automaton()
        return self

    def find(self, words: list[str]) -> list[str]:
        """Matched terms: the heaviest per word, without words inside an exception phrase."""
        if not self.weights or not words:
            return []
        best: dict[int, str] = {}
        free: list[tuple[int, int]] = []
        for last, term in self.automaton.iter(f" {' '.join(words)} "):
            first = last - len(term) + 1
            if term in self.excused:
                free.append((first, last))
            if term in self.weights and self.weights[term] > self.weights.get(best.get(first), 0):
                best[first] = term
        return [t for at, t in sorted(best.items()) if not any(a <= at < b for a, b in free)]

    def measures(self, words: list[str], found: list[str]) -> np.ndarray:
        total = sum(self.weights[t] for t in found)
        return np.array([1.0, math.log1p(total), total / math.sqrt(len(words) + 20), 100 * total / (len(words) + 50)])

    def score(self, words: list[str]) -> tuple[float, list[str]]:
        found = self.find(words)
        return float(1 / (1 + np.exp(-np.clip(self.measures(words, found) @ self.curve, -30, 30)))), found

    def fit(self, texts: list[tuple[str, int]], rows: dict[int, int]) -> "Lexicon":
        """Weights are the smoothed log-odds of a term's documents, above a threshold of support and strength; the curve
        is a logistic regression on total and length-normalised weight, with the labels' true shares.

        Half the texts choose terms, the other half fit the curve, so that chance terms do not look good to it.
        """
        toxic = rows.get(1, 0) / max(1, sum(rows.values()))
        self.curve[0] = math.log((toxic + 1e-6) / (1 - toxic + 1e-6))
        if len({label for _, label in texts}) < 2:
            return self.build()
        folded = sorted(((fold(body), label) for body, label in texts), key=lambda x: x[1])
        chosen = folded[::2]
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        pairs: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for words, label in chosen:
            terms = set()
            for word in set(words):
                terms.add(f" {word} ")
                terms.update(f" {word[:k]}" for k in range(4, min(len(word), 10)))
            counts[label].update(terms)
        n = {label: sum(1 for _, x in chosen if x == label) for label in (0, 1)}
        found = {}
        for term, support in counts[1].items():
            if support < max(4, 0.004 * n[1]):
                continue
            low = math.log((support + 0.5) / (n[1] + 1) / ((counts[0][term] + 0.5) / (n[0] + 1)))
            if low > 2.0:
                found[term] = low
        # a beginning stands for its continuations: drop terms whose beginning is nearly as telling
        self.weights = {
            t: w for t, w in found.items()
            if not any(found.get(t.rstrip()[:k], 0) >= w - 0.7 for k in range(5, len(t.rstrip()) + (t[-1] == " ")))
        }
        self.build()
        for words, label in chosen:
            for a, b in {(a, b) for a, b in zip(words, words[1:])}:
                for word in (a, b):
                    if f" {word} " in self.weights or any(f" {word[:k]}" in self.weights for k in range(4, len(word))):
                        pairs[f" {a} {b} "][label] += 1
        share = {label: rows.get(label, 0) / max(1, n[label]) for label in (0, 1)}
        self.excused = {p: 1.0 for p, (clean, bad) in pairs.items() if clean >= 5 and clean * share[0] > 4 * bad * share[1]}
        self.build()
        held = folded[1::2]
        x = np.array([self.measures(words, self.find(words)) for words, _ in held])
        y = np.array([label for _, label in held])
        seen = {label: max(1, int((y == label).sum())) for label in (0, 1)}
        weight = np.array([rows.get(label, 1) / seen[label] for label in y])
        weight /= weight.sum()
        for _ in range(60):  # Newton steps of a slightly damped logistic regression
            p = 1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30)))
            gradient = x.T @ (weight * (y - p)) - 1e-4 * self.curve
            hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(4)
            step = np.linalg.solve(hessian, gradient)
            self.curve += step * min(1, 3 / max(1e-9, np.abs(step).max()))
        return self

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.build()


def fit_lexicon(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
    per_label: int = SAMPLE_ROWS,
) -> Lexicon:
    """Fit on about ``per_label`` labelled training texts per label, chosen by their id (``SAMPLE_CHARS`` of a long one, in pieces)."""
    usable = labels.select(id_col, label_col).where(
        (tx.crc_remainder(F.col(id_col), HOLD_OUT) != 0) & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()
    ).groupBy(id_col).agg(F.max(label_col).alias("_label"))
    sample, counts = tx.bounded_sample(usable, id_col, "_label", per_label)
    texts = docs.select(id_col, tx.spread(text_col, SAMPLE_CHARS, SAMPLE_PIECES).alias(text_col)).where(F.col(text_col).isNotNull())
    rows = texts.join(F.broadcast(sample), id_col).select(text_col, "_label").collect()  # about two rows per ``per_label``
    return Lexicon().fit(sorted((r[0], int(r[1])) for r in rows), {int(k): v for k, v in counts.items()})


def _judge(batch: pa.RecordBatch, column: str, lexicon: Lexicon) -> dict[str, pa.Array]:
    judged = [lexicon.score(fold(v.as_py() or "")) for v in batch.column(batch.schema.get_field_index(column))]
    return {
        "score": pa.array([s for s, _ in judged], pa.float64()),
        "predicted": pa.array([int(s >= 0.5) for s, _ in judged], pa.int32()),
        "matches": pa.array([[t.strip() for t in found] for _, found in judged], pa.list_(pa.string())),
    }


def score_toxicity(docs: DataFrame, lexicon: Lexicon, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` (columns ``keep``, default all) with score (0 to 1), predicted (score >= 0.5) and matches (terms)."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the sample it was fitted on
    return tx.annotate(docs, lambda b: _judge(b, text_col, shared.value), FIELDS, docs.columns if keep is None else keep, [text_col])
