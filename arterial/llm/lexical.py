"""Ranked lexical search: best-first document intervals over range-maximum sparse tables.

The index holds blocks of documents; a block has its terms and, per term, a posting list (documents in order of their
ids, with occurrences). A search computes the impact of every posting of the terms it asks for and lays a sparse table
over each list, so that the largest impact between any two documents takes two lookups. An item starts with one
interval, the whole block. The sum of its terms' range maxima bounds every score in an interval. The intervals with the
highest bounds are split at the document of their largest impact; that document is scored exactly, and what remains on
both sides becomes an interval with a bound of its own. Intervals whose bound is below the item's k-th score are done.
Many intervals of many items are split at once, as array operations. A task carries the k-th scores from block to block
and gives k documents an item at most; Spark merges those.

Scores are integers: sum over the item's terms (repeats included) of w * ((10^9 tf) div (1000 tf + 8 m)), with
w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 25 + (75 n N) div L.

Defined cases: null and empty texts and texts without terms are in no block and count nowhere; an item without terms
has no rows; equal scores go by ascending id, null ids last; a repeated document or item is a row of its own; a very
long text is a block of its own; empty tables give no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arterial.llm import text as tx
from arterial.llm.arrays import pack, ragged, unpack
from arterial.session import pin

BLOCK_BYTES = 4 << 20  # text of a block
ITEM_BYTES = 8 << 20  # text of the items that are searched in one pass over the index
WIDTH = 8  # intervals of an item that are split at once
CELLS = 1 << 21  # (interval, term) pairs that are worked on at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def term_array(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(lower-cased terms of all texts in order, the text of each)."""
    starts, ends, row = tx.word_positions(data, offsets, tx.ALPHANUMERIC)
    letters = _LOWER[data[tx.ALPHANUMERIC[data]]]
    borders = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(letters)])
    return terms, row


# -- index -------------------------------------------------------------------------------------------------------


def index_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block: document ids in order, their lengths in terms, and the block's terms with their posting lists."""
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()
    schema = f"n_docs bigint, n_terms bigint, ids array<{kind}>, sizes binary, terms array<string>, borders binary, places binary, counts binary"

    def block(part: pa.RecordBatch) -> pa.RecordBatch | None:
        terms, row = term_array(*tx.text_bytes(part.column(1)))
        if not len(terms):
            return None
        size = np.bincount(row, minlength=part.num_rows)
        order = pc.sort_indices(part.column(0)).to_numpy()
        order = order[size[order] > 0]
        place = np.zeros(part.num_rows, np.int64)
        place[order] = np.arange(len(order))
        coded = terms.dictionary_encode()
        postings, n = np.unique(coded.indices.to_numpy().astype(np.int64) * len(order) + place[row], return_counts=True)
        borders = np.searchsorted(postings, np.arange(len(coded.dictionary) + 1) * len(order))
        as_list = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        columns = [
            pa.array([len(order)], pa.int64()), pa.array([len(terms)], pa.int64()), as_list(part.column(0).take(pa.array(order))),
            pa.array([pack(size[order])]), as_list(coded.dictionary.cast(pa.string())), pa.array([pack(borders)]),
            pa.array([pack(postings % len(order))]), pa.array([pack(n)]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["n_docs", "n_terms", "ids", "sizes", "terms", "borders", "places", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, ["_text"], BLOCK_BYTES):
                made = block(part)
                if made is not None:
                    yield made

    return source.mapInArrow(run, schema)


# -- items -------------------------------------------------------------------------------------------------------


class Items:
    """Items of one pass: their terms as places in a common vocabulary, with how often each term is repeated."""

    def __init__(self, texts: list[str | None]):
        place: dict[str, int] = {}
        self.terms: list[np.ndarray] = []
        self.repeats: list[np.ndarray] = []
        for text in texts:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            counted = Counter(term_array(raw, np.array([0, len(raw)]))[0].to_pylist())
            self.terms.append(np.array([place.setdefault(t, len(place)) for t in counted], np.int64))
            self.repeats.append(np.array(list(counted.values()), np.int64))
        self.vocabulary = pa.array(list(place), pa.string())

    def groups(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(items, terms, repeats) as matrices of items with about as many terms; -1 and 0 fill up the rows."""
        lengths = np.array([len(t) for t in self.terms], np.int64)
        order = np.flatnonzero(lengths)[np.argsort(lengths[lengths > 0], kind="stable")]
        start = 0
        while start < len(order):
            most, stop = 2 * int(lengths[order[start]]) + 8, start + 1
            while stop < len(order) and lengths[order[stop]] <= most and (stop - start) * int(lengths[order[stop]]) * WIDTH < CELLS:
                stop += 1
            chosen = order[start:stop]
            terms = np.full((len(chosen), int(lengths[chosen[-1]])), -1, np.int64)
            repeats = np.zeros_like(terms)
            for i, item in enumerate(chosen):
                terms[i, : lengths[item]], repeats[i, : lengths[item]] = self.terms[item], self.repeats[item]
            yield chosen, terms, repeats
            start = stop


class Weights:
    """Collection statistics: what turns occurrences into impacts."""

    def __init__(self, documents: int, terms: int, holding: dict[int, int], vocabulary: int):
        self.documents, self.terms = documents, terms
        self.weight = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(t, 0) + 1))) for t in range(vocabulary)], np.int64
        )

    def length(self, sizes: np.ndarray) -> np.ndarray:
        return np.array([25 + 75 * n * self.documents // self.terms for n in sizes.tolist()], np.int64)


# -- search ------------------------------------------------------------------------------------------------------


class Lists:
    """The posting lists of a block for the terms of the items, with impacts and range-maximum sparse tables."""

    def __init__(self, row: dict[str, pa.Scalar], vocabulary: pa.Array, weights: Weights):
        sizes, borders = unpack(row["sizes"].as_buffer()), unpack(row["borders"].as_buffer())
        found = pc.index_in(row["terms"].values, value_set=vocabulary)
        mine = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        term = pc.fill_null(found, -1).to_numpy()[mine].astype(np.int64)
        mine, term = mine[np.argsort(term)], np.sort(term)
        length = borders[mine + 1] - borders[mine]
        at = ragged(borders[mine], length)
        self.n_docs = len(sizes)
        self.place = unpack(row["places"].as_buffer())[at]
        count = unpack(row["counts"].as_buffer())[at]
        self.key = np.repeat(term, length) * self.n_docs + self.place
        self.impact = np.repeat(weights.weight[term], length) * (
            (1_000_000_000 * count) // (1000 * count + 8 * weights.length(sizes)[self.place])
        )
        self.first, self.last = np.zeros(len(vocabulary) + 1, np.int64), np.zeros(len(vocabulary) + 1, np.int64)
        self.first[term], self.last[term] = np.cumsum(length) - length, np.cumsum(length)
        # level k holds the place of the largest impact among 2 ** k neighbours; lists lie one after another
        longest = int(length.max()) if len(length) else 1
        self.levels = np.zeros((longest.bit_length(), len(at)), np.int32)
        self.levels[0] = np.arange(len(at))
        for k in range(1, len(self.levels)):
            half = 1 << (k - 1)
            left, right = self.levels[k - 1, : len(at) - half], self.levels[k - 1, half:]
            self.levels[k, : len(at) - half] = np.where(self.impact[right] > self.impact[left], right, left)
        self.log = np.zeros(longest + 1, np.int64)
        for k in range(1, len(self.levels)):
            self.log[1 << k :] = k

    def largest(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Place of the largest impact from ``first`` to before ``last``, both within one list."""
        k = self.log[last - first]
        left = self.levels[k, np.minimum(first, len(self.place) - 1)]
        right = self.levels[k, np.maximum(last - (1 << k), 0)]
        return np.where(self.impact[right] > self.impact[left], right, left)


class Best:
    """The k highest scores of each item so far."""

    def __init__(self, items: int, k: int):
        self.scores = np.zeros((items, k), np.int64)  # ascending

    def least(self, item: np.ndarray) -> np.ndarray:
        """The score that is needed to be among the k: the k-th, and 1 at least."""
        return np.maximum(self.scores[item, 0], 1)

    def add(self, item: np.ndarray, score: np.ndarray) -> None:
        k = self.scores.shape[1]
        order = np.lexsort((-score, item))
        item, score = item[order], score[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        new = np.zeros_like(self.scores)
        top = rank < k
        new[item[top], rank[top]] = score[top]
        some = np.unique(item)
        self.scores[some] = np.sort(np.concatenate([self.scores[some], new[some]], axis=1), axis=1)[:, -k:]


def search_block(lists: Lists, group: tuple[np.ndarray, np.ndarray, np.ndarray], best: Best) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, document place, score) of documents that may be among the k best of an item; all that are, are there."""
    members, terms, repeats = group
    width = terms.shape[1]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def bounded(item, x, y, first, last):
        """Intervals from document ``x`` to before ``y`` that can still hold one of the k best, with bound and split."""
        largest = lists.largest(first, last)
        value = np.where(last > first, lists.impact[largest] * repeats[item], 0)
        bound = value.sum(axis=1)
        top = value.argmax(axis=1)
        split = lists.place[largest[np.arange(len(item)), top]]
        stay = bound >= best.least(members[item])
        return [a[stay] for a in (item, x, y, first, last, bound, split)]

    everything = np.arange(len(members))
    whole = np.zeros(len(members), np.int64)
    waiting = bounded(everything, whole, whole + lists.n_docs, lists.first[terms], lists.last[terms])
    most = max(1, CELLS // width)
    while len(waiting[0]):
        item, bound = waiting[0], waiting[5]
        order = np.lexsort((-bound, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        now, later = order[rank < WIDTH], order[rank >= WIDTH]
        now, later = now[:most], np.concatenate([later, now[most:]])
        item, x, y, first, last, _, split = (a[now] for a in waiting)
        waiting = [a[later] for a in waiting]
        wanted = terms[item] * lists.n_docs + split[:, None]
        at = np.minimum(np.maximum(np.searchsorted(lists.key, wanted), first), last)
        hit = (at < last) & (lists.key[np.minimum(at, len(lists.key) - 1)] == wanted)
        score = np.where(hit, lists.impact[np.minimum(at, len(lists.key) - 1)] * repeats[item], 0).sum(axis=1)
        good = score >= best.least(members[item])
        if good.any():
            found.append((members[item[good]], split[good], score[good]))
            best.add(members[item[good]], score[good])
        parts = [
            bounded(item[some], x_[some], y_[some], a[some], b[some])
            for x_, y_, a, b in ((x, split, first, at), (split + 1, y, at + hit, last))
            if (some := x_ < y_).any()
        ]
        stay = waiting[5] >= best.least(members[waiting[0]])
        waiting = [np.concatenate([a[stay], *(p[i] for p in parts)]) for i, a in enumerate(waiting)]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    item, place, score = (np.concatenate(c) for c in zip(*found))
    stay = score >= best.least(item)
    return item[stay], place[stay], score[stay]


def _top(index: DataFrame, items: Items, weights: Weights, k: int) -> DataFrame:
    """(item, id, score): the k best documents of every item among those of each task."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((items, weights))
    kind = index.schema["ids"].dataType.elementType
    plain = index.select("ids", "sizes", "terms", "borders", "places", "counts")
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("id", kind), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        best = Best(len(items.terms), k)
        groups = list(items.groups())
        kept: dict[int, list[tuple]] = {}
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for i in range(batch.num_rows):
                row = {name: batch.column(c)[i] for c, name in enumerate(batch.schema.names)}
                lists = Lists(row, items.vocabulary, weights)
                if not len(lists.place):
                    continue
                for group in groups:
                    item, place, score = search_block(lists, group, best)
                    order = np.lexsort((place, -score, item))
                    rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
                    order = order[rank < k]  # places are in order of the ids
                    ids = row["ids"].values.take(pa.array(place[order])).to_pylist()
                    for q, s, d in zip(item[order].tolist(), score[order].tolist(), ids):
                        kept.setdefault(q, []).append((-s, d is None, d))
                for q, rows in kept.items():
                    if len(rows) > k:
                        kept[q] = sorted(rows, key=lambda r: r if r[2] is not None else r[:2])[:k]
        rows = [(q, d, -s) for q, some in kept.items() for s, _, d in some]
        if rows:
            q, d, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(d, id_type), pa.array(s, pa.int64())], names=["item", "id", "score"])

    return plain.mapInArrow(run, schema)


def _holding(index: DataFrame, items: Items) -> dict[int, int]:
    """Documents that hold each term of the items; one number per term of a pass reaches the driver."""
    vocabulary = items.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                found = pc.index_in(batch.column(0)[i].values, value_set=vocabulary)
                mine = found.is_valid().to_numpy(zero_copy_only=False)
                total[pc.fill_null(found, 0).to_numpy()[mine]] += np.diff(unpack(batch.column(1)[i].as_buffer()))[mine]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["term", "n"])

    counted = index.select("terms", "borders").mapInArrow(run, "term int, n bigint")
    return {r[0]: r[1] for r in counted.groupBy("term").agg(F.sum("n")).collect()}


def search(
    index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", doc_col: str = "doc_id",
) -> DataFrame:
    """The ``k`` best documents of every item: ``id_col``, rank, ``doc_col`` and score.

    ``index`` is a stored result of :func:`index_documents`. Items pass in groups of about ``ITEM_BYTES`` of text, each with
    one pass over the index for its terms' statistics and one for the search, so what is broadcast is bounded.
    """
    plain = items.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    documents, terms, size = (x or 0 for x in index.agg(F.sum("n_docs"), F.sum("n_terms")).first() + plain.agg(F.sum(F.octet_length("_text"))).first())
    passes = max(1, math.ceil(size / ITEM_BYTES))
    if passes > 1:
        plain = pin(plain.withColumn("_pass", F.floor(F.rand(11) * passes)))
    ranked = []
    best_first = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    for number in range(passes):
        rows = (plain.where(F.col("_pass") == number) if passes > 1 else plain).select("_id", "_text").collect()
        asked = Items([r[1] for r in rows])
        weights = Weights(documents, terms, _holding(index, asked) if len(asked.vocabulary) else {}, len(asked.vocabulary))
        names = items.sparkSession.createDataFrame(
            [(i, r[0]) for i, r in enumerate(rows)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("_id", plain.schema["_id"].dataType)])
        )
        found = _top(index, asked, weights, k).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
        ranked.append(found.join(names, "item").select(F.col("_id").alias(id_col), "rank", F.col("id").alias(doc_col), "score"))
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more)
    return out
