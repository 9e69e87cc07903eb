"""Exact top-k by inner product: an impact-ordered index, processed score at a time.

A vector is a list of postings, one per component. The index holds blocks of vectors; in a block every component has the
vectors in order of their values, cut into segments by quantised value. For a query, a segment's impact is the most it can
add to a score above the least that component gives. Segments of all components are processed together by descending
impact: each adds its impact to its members' accumulators. What is not processed yet bounds every score from above:
accumulator, plus the next impact of each component, less the part of that sum which stands for components a vector has
behind it already. Whenever the bounds prove that only few vectors can still be among the k best, processing stops and
those few are scored exactly. The best members found on the way are scored exactly too, which raises the bar.

A query is first answered within its own block; the k-th score it finds there is its bar in all others. Queries in blocks
meet the index by an equi-join on shards of the index, so neither side passes the driver or is broadcast by force.

Defined cases: vectors that are null or hold null or non-finite components take no part; vectors of different sizes are
compared over the components that both have, an empty one scores 0; components beyond 2 ** 25 after scaling count as
that; a repeated row is a row of its own, found by others and asking on its own; equal scores go by ascending id, null
ids last; an empty table gives no rows; columns other than id and vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arterial.llm.arrays import integer_vectors, pack, ragged, unpack
from arterial.session import pin

BLOCK_COMPONENTS = 1 << 20  # of a block of the index, about
LEVELS = 32  # quantised impacts of a component
STEPS = 16  # times the bounds are looked at while a block is processed
SHARD_BLOCKS = 4  # blocks of the index that meet a block of queries in one task

_INDEX = "block bigint, n int, size int, ids array<{0}>, asking binary, matrix binary, places binary, borders binary"


def index_vectors(df: DataFrame, asks: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """One row per block of vectors of one size: ids in order, rows that ask (``asks``), components as floor(scale * x),
    and for each component the vectors by ascending value with the borders of the segments."""
    source = df.select(F.col(id_col).alias("_id"), F.coalesce(asks, F.lit(False)).alias("_asks"), F.col(vector_col).alias("_v"))
    kind = source.schema["_id"].dataType.simpleString()

    def block(number: int, size: int, ids: pa.Array, asking: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
        order = pc.sort_indices(ids).to_numpy()
        matrix, ids = matrix[order], ids.take(pa.array(order))
        places = np.argsort(matrix, axis=0, kind="stable").T
        borders = np.zeros((size, LEVELS + 1), np.int64)
        for d in range(size):
            values = matrix[places[d], d]
            low, high = int(values[0]), int(values[-1])
            edges = [low + (high - low + 1) * i // LEVELS for i in range(LEVELS + 1)]
            borders[d] = np.searchsorted(values, edges)
        columns = [
            pa.array([number], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([size], pa.int32()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            *(pa.array([pack(a)]) for a in (np.flatnonzero(asking[order]), matrix, places, borders)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "n", "size", "ids", "asking", "matrix", "places", "borders"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list[tuple]] = {}
        held = 0  # components of all sizes together, so that many sizes do not fill the memory

        def made(size: int) -> pa.RecordBatch:
            nonlocal number, held
            ids, asking, values = zip(*waiting.pop(size))
            held -= sum(v.size + len(v) for v in values)
            number += 1
            return block(number, size, pa.concat_arrays(ids), np.concatenate(asking), np.concatenate(values))

        for batch in batches:
            rows, sizes, values = integer_vectors(batch.column(2), scale)
            asking = batch.column(1).to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == size)
                most = max(1, BLOCK_COMPONENTS // (size + 1))
                for part in (mine[i : i + most] for i in range(0, len(mine), most)):
                    matrix = values[starts[part][:, None] + np.arange(size)]
                    if size in waiting and sum(len(w[1]) for w in waiting[size]) + len(part) > most:
                        yield made(size)
                    waiting.setdefault(size, []).append((batch.column(0).take(pa.array(rows[part])), asking[rows[part]], matrix))
                    held += matrix.size + len(part)
                while held > 2 * BLOCK_COMPONENTS:
                    yield made(max(waiting, key=lambda s: sum(w[2].size + len(w[2]) for w in waiting[s])))
        for size in list(waiting):
            yield made(size)

    return source.mapInArrow(run, _INDEX.format(kind))


class Block:
    """A block of the index, ready to be searched."""

    def __init__(self, row: dict[str, pa.Scalar]):
        self.n, self.size = row["n"].as_py(), row["size"].as_py()
        self.matrix = unpack(row["matrix"].as_buffer()).reshape(self.n, self.size)
        self.places = unpack(row["places"].as_buffer())  # of all components, one after another
        borders = unpack(row["borders"].as_buffer()).reshape(self.size, LEVELS + 1)
        self.component, self.level = np.nonzero(np.diff(borders, axis=1))  # segments that hold anything
        start = borders[self.component, self.level]
        self.length = borders[self.component, self.level + 1] - start
        self.start = start + self.component * self.n
        self.low = self.matrix[self.places[self.start], self.component]
        self.high = self.matrix[self.places[self.start + self.length - 1], self.component]
        self.least, self.most = (self.matrix.min(axis=0), self.matrix.max(axis=0)) if self.size else (np.zeros(0, np.int64),) * 2

    def exact(self, query: np.ndarray, some: np.ndarray) -> np.ndarray:
        return self.matrix[some, : len(query)] @ query

    def best(self, query: np.ndarray, k: int, bar: int | None, own: int | None = None) -> tuple[np.ndarray, np.ndarray, int | None]:
        """(places, scores, bar): the k best vectors with ``bar`` or more, ``own`` left out, in order; and the bar reached."""
        query = query[: self.size]
        possible = np.arange(self.n)
        if own is not None:
            possible = np.delete(possible, own)
        mine = self.component < len(query)
        weight = query[self.component[mine]]
        floor = np.minimum(query * self.least[: len(query)], query * self.most[: len(query)])
        impact = np.maximum(weight * self.low[mine], weight * self.high[mine]) - floor[self.component[mine]]
        order = np.argsort(-impact, kind="stable")
        order = order[impact[order] > 0]
        impact = impact[order].astype(float)
        start, length, component = (a[mine][order] for a in (self.start, self.length, self.component))
        # the impact that comes next in each component, by how many of its segments are processed
        by_component = np.lexsort((np.arange(len(order)), component))
        segments = np.bincount(component, minlength=len(query))
        first = np.cumsum(segments) - segments
        ahead = np.append(impact[by_component], 0.0)
        done = np.zeros(len(query), np.int64)
        score, passed = np.zeros(self.n), np.zeros(self.n, np.int64)
        work = np.cumsum(length)
        stops = np.unique(np.searchsorted(work, np.arange(1, STEPS + 1) * (work[-1] / STEPS)) + 1) if len(work) else []
        a = 0
        few = max(4 * k, self.n // 8)
        base = int(floor.sum())
        for b in stops:
            if len(possible) <= few and bar is not None:
                break
            members = self.places[ragged(start[a:b], length[a:b])]
            score += np.bincount(members, weights=np.repeat(impact[a:b], length[a:b]), minlength=self.n)
            passed += np.bincount(members, minlength=self.n)
            done += np.bincount(component[a:b], minlength=len(query))
            a = b
            over = done == segments
            coming = np.where(over, 0.0, ahead[np.minimum(first + done, len(order))])
            running = (done > 0) & ~over
            least = coming[running].min() if running.any() else 0.0
            # a vector has at least passed - |over| of the running components behind it, which all have least or more to come
            bound = score + coming.sum() - np.maximum(passed - over.sum(), 0) * least
            bound = bound[possible] * (1 + 1e-12)  # above any rounding
            if len(possible) >= k:
                top = possible[np.argpartition(-bound, k - 1)[:k]]
                reached = int(self.exact(query, top).min())
                bar = reached if bar is None else max(bar, reached)
            if bar is not None:
                possible = possible[bound >= bar - base]
        exact = self.exact(query, possible)
        if bar is not None:
            possible, exact = possible[exact >= bar], exact[exact >= bar]
        order = np.lexsort((possible, -exact))[:k]
        if len(order) == k:
            bar = int(exact[order[-1]])
        return possible[order], exact[order], bar


def _hits(home: list, place: list, ids: list, scores: list, kind: pa.DataType) -> pa.RecordBatch:
    """Rows of lists: (home, place, id, score)."""
    return pa.RecordBatch.from_arrays(
        [np.concatenate([[], *home]).astype(np.int64), np.concatenate([[], *place]).astype(np.int32),
         pa.concat_arrays(ids) if ids else pa.array([], kind), np.concatenate([[], *scores]).astype(np.int64)],
        names=["home", "place", "id", "score"],
    )


def top_k(
    df: DataFrame, asks: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024,
) -> DataFrame:
    """query_id, rank, ``id_col`` and score of the ``k`` vectors with the highest inner products, for every row that asks."""
    index = pin(index_vectors(df, asks, id_col, vector_col, scale))
    kind = index.schema["ids"].dataType.elementType.simpleString()
    hits = f"home bigint, place int, id {kind}, score bigint"

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(c)[i] for c, name in enumerate(batch.schema.names)}
                asking = unpack(row["asking"].as_buffer())
                if not len(asking):
                    continue
                block, ids = Block(row), row["ids"].values
                bars, found, scores = [], [], []
                for place in asking.tolist():
                    near, score, bar = block.best(block.matrix[place], k, None, place)
                    bars.append(bar if len(near) == k else None)
                    found.append(near)
                    scores.append(score)
                lengths = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                as_list = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                columns = [
                    pa.array([row["block"].as_py()], pa.int64()), as_list(pa.array(asking, pa.int32())), as_list(ids.take(pa.array(asking))),
                    pa.array([pack(block.matrix[asking])]), as_list(pa.array(bars, pa.int64())),
                    as_list(pa.ListArray.from_arrays(lengths, ids.take(pa.array(np.concatenate(found))))),
                    as_list(pa.ListArray.from_arrays(lengths, pa.array(np.concatenate(scores), pa.int64()))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["home", "places", "ids", "vectors", "bars", "near", "scores"])

    asked = pin(index.mapInArrow(
        at_home, f"home bigint, places array<int>, ids array<{kind}>, vectors binary, bars array<bigint>, near array<array<{kind}>>, scores array<array<bigint>>"
    ))

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[int, Block] = {}
        for batch in batches:
            home, place, ids, scores = [], [], [], []
            id_kind = batch.schema.field("ids").type.value_type
            for i in range(batch.num_rows):
                row = {name: batch.column(c)[i] for c, name in enumerate(batch.schema.names)}
                number = row["block"].as_py()
                if number not in ready:
                    while len(ready) >= SHARD_BLOCKS:
                        ready.pop(next(iter(ready)))
                    ready[number] = Block(row)
                places = row["home_places"].values
                queries = unpack(row["home_vectors"].as_buffer())
                queries = queries.reshape(len(places), len(queries) // len(places))
                for at, query, bar in zip(places.to_pylist(), queries, row["home_bars"].values.to_pylist()):
                    near, score, _ = ready[number].best(query, k, bar)
                    home.append(np.full(len(near), row["home"].as_py()))
                    place.append(np.full(len(near), at))
                    ids.append(row["ids"].values.take(pa.array(near)))
                    scores.append(score)
            yield _hits(home, place, ids, scores, id_kind)

    shards = max(1, math.ceil(index.count() / SHARD_BLOCKS))
    shard = lambda block: F.pmod(F.xxhash64(block), F.lit(shards))
    queries = asked.select(
        "home", F.col("places").alias("home_places"), F.col("vectors").alias("home_vectors"), F.col("bars").alias("home_bars"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
    )
    pairs = queries.join(index.drop("asking").withColumn("shard", shard("block")), "shard").where("home <> block").drop("shard")
    own = asked.select("home", F.explode(F.arrays_zip("places", "near", "scores")).alias("q")).select(
        "home", F.col("q.places").alias("place"), F.explode(F.arrays_zip("q.near", "q.scores")).alias("h")
    ).select("home", "place", F.col("h.near").alias("id"), F.col("h.scores").alias("score"))
    best_first = Window.partitionBy("home", "place").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = own.unionByName(pairs.mapInArrow(elsewhere, hits)).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    names = asked.select("home", F.explode(F.arrays_zip("places", "ids")).alias("q")).select(
        "home", F.col("q.places").alias("place"), F.col("q.ids").alias("query_id")
    )
    return ranked.join(names, ["home", "place"]).select("query_id", "rank", F.col("id").alias(id_col), "score")
