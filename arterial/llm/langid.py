"""Language identification: a linear-chain conditional random field over the words of a text.

Every word has hashed affix, character n-gram and lexicon (whole word) features; transitions between the labels of
neighbouring words are learned from code-switched sequences glued together from labelled texts. Forward-backward gives
each word's label probabilities; a text's language is the one with the largest share of them. A forward-backward step
works on all texts of a batch at once.

Defined cases: ``und`` with score 0 for null and empty texts, for texts without a letter, and everywhere if nothing is
labelled; equal shares go to the language that sorts first; repeated rows get equal results; rows without id are held out;
columns named like results are replaced. Languages are those of the training rows, one weight vector each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arterial.llm import text as tx

UNKNOWN = "und"
HOLD_OUT = 5
SAMPLE_ROWS = 120  # labelled texts per language that the model is fitted on
SAMPLE_CHARS = 20_000  # of longer texts, so many characters in pieces spread over the whole text are used for fitting
SAMPLE_PIECES = 20
FIELDS = "lang_pred string, score double"

_ROWS = 1 << 16
_LETTERS = tx.byte_set(lambda b: b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
_GROUP = 1 << 20


def _slot(codes: np.ndarray, salt: int) -> np.ndarray:
    return (tx.mix(codes + np.uint64(salt * 0x1000003)) >> np.uint64(48)).astype(np.int32)


class Features:
    """Rows of the weight table that each word uses: fixed ones per word, and one per character trigram."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends, self.row = tx.word_positions(data, offsets, _LETTERS)
        self.data = data
        words = tx.word_hashes(data, self.starts, self.ends)
        per_word = [_slot(words, 1)]
        low = data | np.uint8(0x20) * ((data >= 65) & (data <= 90)).astype(np.uint8)
        size = self.ends - self.starts
        prefix = np.zeros(len(words), np.uint64)
        suffix = np.zeros(len(words), np.uint64)
        for k in range(4):
            has = size > k
            prefix = prefix * np.uint64(257) + np.where(has, low[np.minimum(self.starts + k, len(low) - 1)].astype(np.uint64) + 1, 0).astype(np.uint64)
            suffix = suffix * np.uint64(257) + np.where(has, low[np.maximum(self.ends - 1 - k, 0)].astype(np.uint64) + 1, 0).astype(np.uint64)
            per_word += [_slot(prefix, 2 + k), _slot(suffix, 6 + k)]
        self.per_word = per_word
        self.low = low

    def groups(self):
        """(first word, last word, byte range) of runs of words of about ``_GROUP`` bytes."""
        i = 0
        while i < len(self.starts):
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + _GROUP, side="right")))
            yield i, j, int(self.starts[i]), int(self.ends[j - 1])
            i = j

    def trigrams(self, i: int, j: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(slot, word) of every trigram inside words i..j."""
        low = self.low[a:b].astype(np.uint64)
        word = np.zeros(b - a, np.int32)
        word[self.starts[i:j] - a] = 1
        word = np.cumsum(word) - 1
        at = np.arange(b - a)
        inside = at + 3 <= (self.ends[i:j] - a)[word]
        at = at[inside]
        codes = (low[at] << np.uint64(16)) | (low[at + 1] << np.uint64(8)) | low[at + 2]
        return _slot(codes, 11), word[inside] + i


class Crf:
    def __init__(self, labels: list[str]):
        self.labels = labels
        self.weights = np.zeros((_ROWS, len(labels)), np.float32)
        self.moves = np.zeros((len(labels), len(labels)), np.float32)

    def emissions(self, f: Features) -> np.ndarray:
        out = sum(self.weights[slot] for slot in f.per_word)
        for i, j, a, b in f.groups():
            slot, word = f.trigrams(i, j, a, b)
            if len(word):
                first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                out[word[first]] += np.add.reduceat(self.weights[slot], first, axis=0)
        return out

    def marginals(self, emissions: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of every word, and the expected number of each transition, by forward-backward."""
        n, size = emissions.shape
        local = np.exp(np.maximum(emissions - emissions.max(axis=1, keepdims=True), -25)) if n else emissions
        move = np.exp(self.moves)
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if n else np.zeros(0, int)
        length = np.diff(np.concatenate([first, [n]]))
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        longest = int(length[0]) if len(length) else 0
        active = np.searchsorted(-length, -np.arange(longest), side="left")  # texts with more than t words
        forward = np.empty_like(local)
        state = np.ones((len(first), size), np.float32)
        for t in range(longest):
            k = active[t]
            at = first[:k] + t
            state = (state[:k] @ move if t else state[:k]) * local[at]
            state /= state.sum(axis=1, keepdims=True)
            forward[at] = state
        back = np.ones((len(first), size), np.float32)
        moved = np.zeros((size, size))
        for t in range(longest - 1, -1, -1):
            k = active[t]
            at = first[:k] + t
            here = local[at] * back[:k]
            if t:
                pair = forward[at - 1][:, :, None] * move * here[:, None, :]
                moved += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if self.counting else 0
            total = forward[at] * back[:k]
            forward[at] = total / total.sum(axis=1, keepdims=True)
            if t:
                # the forward values of t - 1 are still to come; only those of t were replaced
                back[:k] = here @ move.T
                back[:k] /= back[:k].sum(axis=1, keepdims=True)
        return forward, moved

    counting = False

    def fit(self, texts: list[tuple[str, str]], epochs: int = 6, batch_words: int = 12_000, rate: float = 0.5) -> "Crf":
        """Adaptive gradient ascent on the log-likelihood of code-switched sequences built from labelled texts."""
        rng = np.random.default_rng(5)
        label_of = {label: i for i, label in enumerate(self.labels)}
        chunks = []
        for body, label in texts:
            words = body.split()
            at = 0
            while at < len(words):
                size = int(rng.integers(4, 60))
                chunks.append((" ".join(words[at : at + size]), label_of[label]))
                at += size
        self.counting = True
        seen, seen_moves = np.full(self.weights.shape, 1e-3, np.float32), np.full(self.moves.shape, 1e-3, np.float32)
        for _ in range(epochs):
            order = rng.permutation(len(chunks))
            at = 0
            while at < len(order):
                picked, total = [], 0
                while at < len(order) and total < batch_words:
                    body, label = chunks[order[at]]
                    picked.append((body.encode(), label))
                    total += body.count(" ") + 1
                    at += 1
                self._step(picked, seen, seen_moves, rate)
        self.counting = False
        return self

    def _step(self, picked: list[tuple[bytes, int]], seen: np.ndarray, seen_moves: np.ndarray, rate: float) -> None:
        data = np.frombuffer(b" ".join(body for body, _ in picked), np.uint8)
        stops = np.cumsum([len(body) + 1 for body, _ in picked])
        f = Features(data, np.array([0, len(data)]))
        if not len(f.starts):
            return
        part = np.searchsorted(stops, f.starts, side="right")
        gold = np.array([label for _, label in picked])[part]
        sequence = part // 6  # six chunks make one code-switched sequence
        found, moved = self.marginals(self.emissions(f), sequence)
        error = -found
        error[np.arange(len(gold)), gold] += 1
        gradient = np.zeros(self.weights.shape, np.float32)
        used = [(slot, np.arange(len(gold))) for slot in f.per_word] + [f.trigrams(*g) for g in f.groups()]
        for label in range(len(self.labels)):
            for slot, word in used:
                gradient[:, label] += np.bincount(slot, error[word, label], minlength=_ROWS)
        follows = sequence[1:] == sequence[:-1]
        moves = np.zeros(self.moves.shape)
        np.add.at(moves, (gold[:-1][follows], gold[1:][follows]), 1)
        for weights, g, s in ((self.weights, gradient / len(gold), seen), (self.moves, (moves - moved) / len(gold), seen_moves)):
            s += (g * 100) ** 2
            weights += rate * g * 100 / np.sqrt(s)
        self.weights *= 0.999

    def predict(self, batch: pa.RecordBatch, column: str) -> dict[str, pa.Array]:
        texts = batch.column(batch.schema.get_field_index(column))
        data, offsets = tx.text_bytes(texts)
        f = Features(data, offsets)
        share = np.zeros((batch.num_rows, len(self.labels)))
        if self.labels and len(f.row):
            probability, _ = self.marginals(self.emissions(f), f.row)
            for label in range(len(self.labels)):
                share[:, label] = np.bincount(f.row, probability[:, label], minlength=batch.num_rows)
        words = np.bincount(f.row, minlength=batch.num_rows)
        best = share.argmax(axis=1) if self.labels else words * 0
        known = (words > 0) & bool(self.labels)
        latin = np.bincount(f.row, (data[f.starts] < 0x80) if len(data) else None, minlength=batch.num_rows) > 0
        for r in np.flatnonzero(known & ~latin):
            known[r] = any(c.isalpha() for c in texts[int(r)].as_py())
        score = np.where(known, share.max(axis=1, initial=0) / np.maximum(words, 1), 0).clip(0, 1)
        return {
            "lang_pred": pa.array([self.labels[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
            "score": pa.array(score),
        }


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = SAMPLE_ROWS) -> Crf:
    """Fit on at most about ``per_language`` labelled training texts per language (``SAMPLE_CHARS`` at most of each).

    Languages and their counts come from all labelled training texts, whatever their length.
    """
    usable = docs.select(id_col, text_col, lang_col).where(
        (tx.crc_remainder(F.col(id_col), HOLD_OUT) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    )
    sample, counts = tx.bounded_sample(usable, id_col, lang_col, per_language)
    texts = sorted((r[0], r[1]) for r in sample.select(tx.spread(text_col, SAMPLE_CHARS, SAMPLE_PIECES), lang_col).collect())
    return Crf(sorted(counts)).fit(texts)


def identify(docs: DataFrame, model: Crf, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` (columns ``keep``, default all) with lang_pred and score (the language's share of the words, 0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** 16 weights per language, whatever the data
    return tx.annotate(docs, lambda b: shared.value.predict(b, text_col), FIELDS, docs.columns if keep is None else keep, [text_col])
