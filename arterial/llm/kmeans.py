"""Centroid clustering: Lloyd's rounds with vectors and centroids sharded by dimension.

Vectors are stored as groups of rows, each group cut into column blocks. A round's tasks take a column block of a group
and the slice of the centroids that covers those columns, and compute exact partial distances. They are added up by group,
one block after another, and the smallest sum gives each vector its cluster. Assignments go back to the column blocks,
whose sums per cluster make the new slice: a block's columns never leave their shard, and no task or driver needs whole
centroids. All numbers are integers, so results do not depend on the order of additions.

Defined cases: vectors that are null, of another size, or hold null or non-finite components are left out; components
beyond 2 ** 25 after scaling count as that; repeated rows are vectors of their own; rows without id are clustered but start
no centroid unless nothing else can; equal starting keys go by the vectors; equal distances go to the smaller number; a
centroid without vectors stays; with fewer vectors than ``k`` there are fewer centroids; an empty table gives no rows;
columns other than id and vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arterial.llm.arrays import MAX_COMPONENT, integer_vectors, pack, unpack
from arterial.session import pin

GROUP_ROWS = 1024
COLUMNS = 16  # of a column block
GROUPS_PER_SALT = 256  # column blocks that share one copy of a slice, where slices are too large to be broadcast


def shard_vectors(df: DataFrame, size: int, id_col: str, vector_col: str, scale: int, columns: int) -> DataFrame:
    """(group, block, n, matrix, ids): a row per group of vectors and column block; block 0 carries the ids."""
    source = df.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v"))
    kind = source.schema["_id"].dataType.simpleString()
    borders = list(range(0, size, columns)) + [size]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() << 32
        for batch in batches:
            rows, _, values = integer_vectors(batch.column(1), scale, size)
            matrix = values.reshape(-1, size)
            for start in range(0, len(rows), GROUP_ROWS):
                part = matrix[start : start + GROUP_ROWS]
                ids = batch.column(0).take(pa.array(rows[start : start + GROUP_ROWS]))
                blocks = len(borders) - 1
                lists = pa.ListArray.from_arrays(pa.array([0] + [len(ids)] * blocks, pa.int32()), ids)
                data = [pack(part[:, a:b]) for a, b in zip(borders[:-1], borders[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group] * blocks, pa.int64()), pa.array(range(blocks), pa.int32()), pa.array([len(part)] * blocks, pa.int32()),
                     pa.array(data, pa.binary()), lists],
                    names=["group", "block", "n", "matrix", "ids"],
                )
                group += 1

    return source.mapInArrow(run, f"group bigint, block int, n int, matrix binary, ids array<{kind}>")


def first_centroids(df: DataFrame, k: int, size: int, id_col: str, vector_col: str, scale: int, columns: int, seed: str) -> DataFrame:
    """(block, cluster, slice) of the ``k`` usable vectors with the smallest hash of seed and id."""
    v = F.col("_v")
    usable = v.isNotNull() & (F.size(v) == size) & F.forall(
        v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False))
    )
    source = df.select(F.col(id_col).cast("string").alias("_id"), F.col(vector_col).alias("_v")).where(usable)
    start = F.sha2(F.concat(F.lit(seed), F.col("_id")), 256).alias("start")
    limit = float(MAX_COMPONENT)
    whole = F.transform(
        v, lambda x: F.greatest(F.lit(-limit), F.least(F.lit(limit), F.floor(x.cast("double") * scale).cast("double"))).cast("long")
    )
    chosen = source.select(start, "_v").orderBy(F.col("start").asc_nulls_last(), "_v").limit(k)
    # k rows: a window over all of them is small whatever the data
    numbered = chosen.select((F.row_number().over(Window.orderBy(F.col("start").asc_nulls_last(), "_v")) - 1).alias("cluster"), whole.alias("whole"))
    return numbered.select(
        "cluster", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(size - 1), F.lit(columns)), lambda i: F.slice("whole", i + 1, F.lit(columns)))).alias("block", "slice")
    )


def _squares(matrix: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    away = matrix - centroid
    return np.einsum("ij,ij->i", away, away)


def assign(shards: DataFrame, centroids: DataFrame, salts: int) -> DataFrame:
    """(group, clusters, distances): each vector's nearest centroid and its squared distance."""
    slices = centroids.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("cluster", "slice"))).alias("slices"))
    slices = slices.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    blocks = shards.select("group", "block", "n", "matrix", F.pmod(F.xxhash64("group"), F.lit(salts)).cast("int").alias("salt"))
    met = blocks.join(slices, ["block", "salt"]).select("group", "n", "matrix", F.col("slices.slice").alias("slices"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for n, matrix, slices in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                matrix = unpack(matrix.as_buffer()).reshape(n, -1)
                made.append(pack(np.stack([_squares(matrix, np.array(c, np.int64)) for c in slices], axis=1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["group", "n", "partial"])

    def nearest(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, total = None, None
        for batch in blocks:
            for n, part in zip(batch.column(1).to_pylist(), batch.column(2)):
                part = unpack(part.as_buffer()).reshape(n, -1)
                total = part.copy() if total is None else np.add(total, part, out=total)
                group = batch.column(0)[0]
        clusters = total.argmin(axis=1)  # the first of equals, which is the smaller number
        yield pa.RecordBatch.from_arrays(
            [pa.array([group.as_py()], pa.int64()), pa.array([pack(clusters)]), pa.array([pack(total[np.arange(len(total)), clusters])])],
            names=["group", "clusters", "distances"],
        )

    added = met.mapInArrow(partial, "group bigint, n int, partial binary")
    return added.groupBy("group").applyInArrow(nearest, "group bigint, clusters binary, distances binary")


def update(shards: DataFrame, assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """The centroids moved to the floor of their vectors' mean, slice by slice; those without vectors stay."""
    met = shards.select("group", "block", "n", "matrix").join(assigned.select("group", "clusters"), "group")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i] for j, c in enumerate(names)}
                matrix = unpack(row["matrix"].as_buffer()).reshape(row["n"].as_py(), -1)
                clusters = unpack(row["clusters"].as_buffer())
                order = np.argsort(clusters, kind="stable")
                some, at, n = np.unique(clusters[order], return_index=True, return_counts=True)
                for c, count, added in zip(some.tolist(), n.tolist(), np.add.reduceat(matrix[order], at, axis=0)):
                    before = held.get((row["block"].as_py(), c), (0, 0))
                    held[row["block"].as_py(), c] = before[0] + count, before[1] + added
        if held:
            keys, values = zip(*held.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in keys], pa.int32()), pa.array([c for _, c in keys], pa.int32()), pa.array([n for n, _ in values], pa.int64()),
                 pa.array([s.tolist() for _, s in values], pa.list_(pa.int64()))],
                names=["block", "cluster", "n", "sums"],
            )

    added = met.mapInArrow(sums, "block int, cluster int, n bigint, sums array<bigint>")
    means = (
        added.select("block", "cluster", "n", F.posexplode("sums").alias("at", "s"))
        .groupBy("block", "cluster", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        .groupBy("block", "cluster").agg(F.sort_array(F.collect_list(F.struct("at", F.expr("(s - pmod(s, n)) div n").alias("mean")))).alias("moved"))
    )
    return centroids.join(means, ["block", "cluster"], "left").select(
        "block", "cluster", F.coalesce(F.col("moved.mean"), F.col("slice")).alias("slice")
    )


def cluster_vectors(
    df: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 64, columns: int = COLUMNS, seed: str = "1:",
) -> DataFrame:
    """``id_col``, cluster, distance, cluster_inertia, inertia, centroid_sha256 and centroid of every usable vector."""
    shards = pin(shard_vectors(df, size, id_col, vector_col, scale, columns))
    salts = max(1, math.ceil(shards.count() / GROUPS_PER_SALT))
    centroids = pin(first_centroids(df, k, size, id_col, vector_col, scale, columns, seed))
    for _ in range(rounds):
        centroids = pin(update(shards, pin(assign(shards, centroids, salts)), centroids))
    assigned = pin(assign(shards, centroids, salts))
    kind = shards.schema["ids"].dataType.elementType.simpleString()

    def inertia(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            for clusters, distances in zip(batch.column(0), batch.column(1)):
                clusters, distances = unpack(clusters.as_buffer()), unpack(distances.as_buffer())
                for c in np.unique(clusters).tolist():
                    total[c] = total.get(c, 0) + int(distances[clusters == c].sum())
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array(total.values(), pa.int64())], names=["cluster", "d"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values
                clusters, distances = unpack(batch.column(1)[i].as_buffer()), unpack(batch.column(2)[i].as_buffer())
                yield pa.RecordBatch.from_arrays([ids, pa.array(clusters, pa.int32()), pa.array(distances)], names=["_id", "cluster", "distance"])

    per_cluster = assigned.select("clusters", "distances").mapInArrow(inertia, "cluster int, d bigint")
    per_cluster = per_cluster.groupBy("cluster").agg(F.sum("d").alias("cluster_inertia"))
    whole = centroids.groupBy("cluster").agg(F.flatten(F.sort_array(F.collect_list(F.struct("block", "slice"))).getField("slice")).alias("centroid"))
    everything = Window.partitionBy(F.lit(0))  # one row per cluster
    about = per_cluster.join(whole, "cluster").select(
        "cluster", "cluster_inertia", F.sum("cluster_inertia").over(everything).alias("inertia"),
        F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256).alias("centroid_sha256"), "centroid",
    )
    found = shards.where("block = 0").select("group", "ids").join(assigned, "group").select("ids", "clusters", "distances")
    found = found.mapInArrow(rows, f"_id {kind}, cluster int, distance bigint")
    # k rows of one centroid each
    return found.join(F.broadcast(about), "cluster").select(
        F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )
