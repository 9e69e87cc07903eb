"""Personal data: base patterns plus a skip-chain conditional random field over a document's candidates.

Candidates are the base matches and other strings that look a little like them (digit groups, anything with an @). The
field has a node for each, labelled email, ip, card, phone or none. Neighbours share chain potentials; equal or similar
candidates (same digits, or the same last nine of a phone number; same address up to case or a cut-off domain), however far apart, share skip potentials. Base
matches are observed; loopy message passing decides the others, so "1 559 555 3817" becomes a phone number in a document
that also has "+1 (559) 555-3817", and stays unlabelled elsewhere.

Defined cases: null and empty texts have no spans; repeated rows get equal results; very long texts are scanned in
linear time; columns named like results are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arterial.llm import text as tx

KINDS = ("email", "ip", "card", "phone")
FIELDS = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
SAMPLE_ROWS = 3000  # documents with candidates that the weights are fitted on
SAMPLE_CHARS, SAMPLE_PIECES = 20_000, 10
PHONE_TAIL = 9  # digits that a number has in common with and without its country or trunk prefix
# what a candidate's own looks say against a label, in natural log-odds: more than its neighbours can say for it, and less
# than an equal candidate can
UNMATCHED = (2.5, 3.5)
AGREE = 50  # pairs of equal candidates with equal labels that are taken as seen before any are counted

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only begin where a digit run begins, so each run is tried once
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOOSE = re.compile(r"\(?[0-9][ ().0-9-]+[0-9]")
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            free = match.end()
        at = text.find("@", max(at + 1, free))
    return found


def _ip_ok(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in value.split("."))


def _card_ok(value: str) -> bool:
    digits = _DIGITS.sub("", value)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(value: str) -> bool:
    return 8 <= len(_DIGITS.sub("", value)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base matches, by kind and start."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    for kind, pattern, test in ((1, _IP, _ip_ok), (2, _CARD, _card_ok), (3, _PHONE, _phone_ok)):
        if kind != 3 or "+" in text:
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if test(m.group())]
    return out


class Candidates:
    """Nodes of one document: base matches, then other digit groups and @-strings that no base match touches."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        taken = sorted((s, e) for _, s, e in base)
        loose = []
        for m in _LOOSE.finditer(text):
            if 7 <= len(_DIGITS.sub("", m.group())) <= 19:
                loose.append((m.start(), m.end()))
        at = text.find("@")
        while at >= 0:
            start, end = at, at + 1
            while start > 0 and text[start - 1] in _LOCAL:
                start -= 1
            while end < len(text) and text[end] in _LOCAL:
                end += 1
            loose.append((start, end))
            at = text.find("@", end)
        nodes = [(s, e, k) for k, s, e in base]
        i = 0
        for s, e in sorted(loose):
            while i < len(taken) and taken[i][1] <= s:
                i += 1
            if i == len(taken) or taken[i][0] >= e:
                nodes.append((s, e, -1))
        nodes.sort()
        self.nodes = nodes
        self.labels = np.array([k for _, _, k in nodes], int)
        self.values = [text[s:e] for s, e, _ in nodes]
        self.features = np.array([self._features(v) for v in self.values], float).reshape(len(nodes), 10)

    @staticmethod
    def _features(value: str) -> list[float]:
        digits = _DIGITS.sub("", value)
        n = len(digits)
        dots = value.count(".")
        return [
            1.0, "@" in value, "@" in value and "." in value.rpartition("@")[2], value.startswith("+"), dots == 3 and n <= 12,
            16 <= n <= 19, 16 <= n <= 19 and luhn(digits), 8 <= n <= 15, n < 8, bool(re.search(r"[()]", value)),
        ]

    def keys(self):
        for value in self.values:
            if "@" in value:
                yield value.split("@")[0].lower() + "@"
            else:
                digits = _DIGITS.sub("", value)
                yield digits[-PHONE_TAIL:] if len(digits) <= 15 and not _QUAD.fullmatch(value) else digits

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(chain, skip) edges. Equal keys are linked each to the one before and to the first, never all to all."""
        chain = [(i, i + 1) for i in range(len(self.nodes) - 1) if self.nodes[i + 1][0] - self.nodes[i][1] <= 40]
        skip, last, first = [], {}, {}
        for i, key in enumerate(self.keys()):
            if key in last:
                skip.append((last[key], i))
                if first[key] != last[key]:
                    skip.append((first[key], i))
            else:
                first[key] = i
            last[key] = i
        return np.array(chain, int).reshape(-1, 2), np.array(skip, int).reshape(-1, 2)


class SkipChainCrf:
    size = len(KINDS) + 1  # the last label is "none"

    def __init__(self):
        self.node = np.zeros((10, self.size))
        self.chain = np.zeros((self.size, self.size))
        self.skip = np.zeros((self.size, self.size))

    def fit(self, documents: list[Candidates], epochs: int = 150) -> "SkipChainCrf":
        """Piecewise training: node weights by logistic regression; pair potentials as log-odds of joint labels.

        The labels are the base matches; candidates without one count as none.
        """
        none = self.size - 1
        x = np.concatenate([d.features for d in documents if len(d.nodes)] or [np.zeros((0, 10))])
        gold = [np.where(d.labels < 0, none, d.labels) for d in documents]
        y = np.concatenate([g for g in gold if len(g)] or [np.zeros(0, int)])
        for _ in range(epochs if len(y) else 0):
            p = x @ self.node
            p = np.exp(p - p.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            self.node -= 0.5 * (x.T @ p / len(y) + 1e-4 * self.node)
        share = (np.bincount(y, minlength=self.size) + 1) / (len(y) + self.size)
        joint, agree, differ = np.ones((self.size, self.size)), AGREE, 1
        for d, g in zip(documents, gold):
            chain, skip = d.edges()
            np.add.at(joint, (g[chain[:, 0]], g[chain[:, 1]]), 1)
            # similar candidates where one has no base match say nothing: that is what the field is to decide
            both = (g[skip[:, 0]] != none) & (g[skip[:, 1]] != none)
            same = g[skip[:, 0]] == g[skip[:, 1]]
            agree, differ = agree + int((both & same).sum()), differ + int((both & ~same).sum())
        self.chain = np.log(joint / joint.sum() / np.outer(share, share)).clip(-1, 1)
        self.skip = np.eye(self.size) * np.clip(np.log(agree / differ), 0, 6)
        return self

    def infer(self, d: Candidates, sweeps: int = 12) -> np.ndarray:
        """Label probabilities of every candidate by damped loopy sum-product; base matches are observed."""
        potential = d.features @ self.node
        against = np.clip(potential[:, -1:] - potential, *UNMATCHED)
        against[:, -1] = 0
        potential = np.exp(-against)
        seen = d.labels >= 0
        potential[seen] = np.eye(self.size)[d.labels[seen]] + 1e-9
        chain, skip = d.edges()
        pairs = np.concatenate([chain, skip])
        if not len(pairs):
            return potential / potential.sum(axis=1, keepdims=True)
        tables = np.concatenate([np.repeat(np.exp(self.chain)[None], len(chain), 0), np.repeat(np.exp(self.skip)[None], len(skip), 0)])
        source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        back = np.roll(np.arange(2 * len(pairs)), len(pairs))
        messages = np.zeros((2 * len(pairs), self.size))
        for _ in range(sweeps):
            belief = np.log(potential)
            np.add.at(belief, target, messages)
            cavity = belief[source] - messages[back]
            cavity = np.exp(cavity - cavity.max(axis=1, keepdims=True))
            new = np.log(np.einsum("ei,eij->ej", cavity, tables))
            messages = 0.5 * messages + 0.5 * (new - new.max(axis=1, keepdims=True))
        belief = np.log(potential)
        np.add.at(belief, target, messages)
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """(base spans, all spans), each by kind and start."""
        if not text:
            return [], []
        base = base_spans(text)
        if not base:  # without an observed entity nothing can be consistent with it
            return base, base
        found = Candidates(text, base)
        if (found.labels >= 0).all():
            return base, base
        label = self.infer(found).argmax(axis=1)
        added = [(int(k), s, e) for (s, e, seen), k in zip(found.nodes, label) if seen < 0 and k < len(KINDS)]
        return base, sorted([*base, *added])


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Replace spans by ``<KIND>``; spans that overlap become one, named after the first."""
    out, at = [], 0
    for s, e, k in sorted((s, -e, k) for k, s, e in spans):
        e = -e
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
            at = e
        else:
            at = max(at, e)
    return "".join([*out, text[at:]])


def _annotated(batch: pa.RecordBatch, column: str, model: SkipChainCrf, masked: str | None) -> dict[str, pa.Array]:
    rows: dict[str, list] = defaultdict(list)
    for value in batch.column(batch.schema.get_field_index(column)):
        text = value.as_py()
        base, spans = model.spans(text or "")
        for k, kind in enumerate(KINDS):
            rows[f"n_{kind}"].append(sum(b[0] == k for b in base))
        rows["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
        rows["spans"].append(listed(spans))
        rows["n_added"].append(len(spans) - len(base))
        if masked:
            rows[masked].append(text if text is None else redact(text, spans))
    kinds = {"base_sha256": pa.string(), "spans": pa.string(), masked: pa.string()}
    return {name: pa.array(values, kinds.get(name, pa.int64())) for name, values in rows.items()}


def fit_pii(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rows: int = SAMPLE_ROWS) -> SkipChainCrf:
    """Fit on about ``rows`` documents that hold a digit or an @, chosen by their id (``SAMPLE_CHARS`` of a long one, in pieces)."""
    usable = docs.select(id_col, text_col).where(F.col(text_col).rlike("[0-9@]"))
    sample, _ = tx.bounded_sample(usable.withColumn("one", F.lit(1)), id_col, "one", rows)
    texts = sorted(r[0] for r in sample.select(tx.spread(text_col, SAMPLE_CHARS, SAMPLE_PIECES)).collect())
    return SkipChainCrf().fit([Candidates(t, base_spans(t)) for t in texts])


def find_pii(
    docs: DataFrame, model: SkipChainCrf, keep: list[str] | None = None, text_col: str = "text", masked_col: str | None = None
) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with counts and digest of the base spans, all spans, the number of added
    ones and, if ``masked_col`` is given, the text with all spans replaced."""
    fields = FIELDS + (f", `{masked_col}` string" if masked_col else "")
    return tx.annotate(
        docs, lambda b: _annotated(b, text_col, model, masked_col), fields, docs.columns if keep is None else keep, [text_col]
    )
