"""Supervised windows and chronological splits (WIN-10 to WIN-12)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from arterial.operators.ordering import ROWS_PER_TASK, OrderedRows
from arterial.session import pin


def with_sequences(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    length: int = 60,
    by: Sequence[str] | str | None = "sensor_id",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | str = (),
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """WIN-10: ``x`` = the ``length`` rows before each row (oldest first), ``y`` = the row's target.

    Rows with fewer predecessors are dropped, so a key with n rows gives n - length samples.
    """
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    keys = [by] if isinstance(by, str) else list(by or [])
    vector = F.array(*[F.col(c).cast("double") for c in features])
    order = list(dict.fromkeys([ts, *ties]))
    kept = list(dict.fromkeys([*keys, *order]))
    slim = df.select(*kept, vector.alias("_v"), F.col(target).cast("double").alias("y"))

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumn("x", F.collect_list("_v").over(w.rowsBetween(-length, -1)))

    out = OrderedRows(slim, keys, order, rows_per_task).rows(build, behind=length).result()
    return out.filter(F.size("x") == length).drop("_v")


def sequence_blocks(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    length: int = 60,
    block: int = 1024,
    by: Sequence[str] | str | None = "sensor_id",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | str = (),
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """WIN-10 for storage: blocks of ``block`` rows of a key with the ``length`` rows before them.

    ``(keys, block, first, rows)``; a row is stored once, and once more where it leads into the next block, so a table of
    blocks has (block + length) / block times the rows, not ``length`` times. :func:`samples` makes the samples on read.
    """
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    keys = [by] if isinstance(by, str) else list(by or [])
    order = list(dict.fromkeys([ts, *ties]))
    vector = F.array(*[F.col(c).cast("double") for c in features])
    slim = df.select(*dict.fromkeys([*keys, *order]), vector.alias("v"), F.col(target).cast("double").alias("y"))
    numbered = OrderedRows(slim, keys, order, rows_per_task).index("_rn").result()
    place = F.col("_rn") - 1
    own = F.floor(place / block).cast("long")
    into = F.sequence(own, F.floor((place + length) / block).cast("long"))
    row = F.struct("_rn", *[F.col(c).alias(c) for c in order if c not in keys], "v", "y")
    spread = numbered.withColumn("block", F.explode(into))
    blocks = spread.groupBy(*keys, "block").agg(F.sort_array(F.collect_list(row)).alias("rows"))  # block + length rows at most
    # the last row of a key may lead into a block without rows of its own
    return blocks.filter(F.element_at("rows", -1)["_rn"] > F.col("block") * block)


def samples(blocks: DataFrame, length: int, block: int) -> DataFrame:
    """The samples of stored blocks: keys, order columns, ``y`` and ``x``, the ``length`` rows before, as in with_sequences."""
    keys = [c for c in blocks.columns if c not in ("block", "rows")]
    names = [f.name for f in blocks.schema["rows"].dataType.elementType if f.name not in ("_rn", "v")]
    each = blocks.select(*keys, "block", "rows", F.posexplode("rows").alias("_at", "_row"))
    own = each.filter((F.col("_row._rn") > F.col("block") * block) & (F.col("_at") >= length))
    before = F.transform(F.slice("rows", F.col("_at") - length + 1, F.lit(length)), lambda r: r["v"])
    return own.select(*keys, *[F.col("_row")[n].alias(n) for n in names], before.alias("x"))


def block_sequences(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    length: int = 60,
    by: Sequence[str] | str | None = "sensor_id",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | str = (),
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """WIN-11: consecutive blocks of ``length`` rows with the first target of each; no short block."""
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    keys = [by] if isinstance(by, str) else list(by or [])
    numbered = OrderedRows(df, keys, [ts, *ties], rows_per_task).index("_rn").result()
    vector = F.array(*[F.col(c).cast("double") for c in features])
    row = F.struct("_rn", vector.alias("v"), F.col(target).cast("double").alias("y"))
    block = F.floor((F.col("_rn") - 1) / length).alias("block")
    blocks = numbered.groupBy(*keys, block).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    return blocks.filter(F.size("_rows") == length).select(
        *keys, "block", F.transform("_rows", lambda r: r["v"]).alias("x"), F.col("_rows")[0]["y"].alias("y")
    )


def at_or_after(cut: Sequence[tuple[str, object]]) -> Column:
    """Lexicographic comparison of the order columns with fixed values."""
    (name, value), rest = cut[0], cut[1:]
    c = F.col(name)
    if not rest:  # missing values come first
        return F.lit(True) if value is None else F.coalesce(c >= F.lit(value), F.lit(False))
    return (c > F.lit(value)) | ((c == F.lit(value)) & at_or_after(rest))


def chronological_split(
    df: DataFrame,
    fraction: float = 0.2,
    ts: str = "timestamp",
    tiebreak: str = "event_id",
    name: str = "split",
) -> DataFrame:
    """WIN-12: 'train' for the first rows in time, 'validation' for the last ceil(fraction * n).

    The border row is found by its rank, time first and ``tiebreak`` (any orderable column, missing values first) within
    equal times; only those two columns are sorted. Rows that are equal in both fall on the same side.
    """
    total = df.filter(F.col(ts).isNotNull()).count()
    first = total - math.ceil(fraction * total)
    if total == 0 or first >= total:
        return df.withColumn(name, F.lit("train"))
    border = rows_at(df, [first], ts, tiebreak)[first]
    later = at_or_after([("_micros", border[0]), (tiebreak, border[1])])
    return (
        df.withColumn("_micros", F.unix_micros(ts))
        .withColumn(name, F.when(later, F.lit("validation")).otherwise(F.lit("train")))
        .drop("_micros")
    )


def rows_at(df: DataFrame, ranks: Sequence[int], ts: str, tiebreak: str) -> dict[int, tuple[int, object]]:
    """(microseconds, tiebreak) of the rows with 0-based ``ranks`` in (ts, tiebreak) order; missing tiebreaks come first.

    The two columns are range-sorted and written once. A row's id counts up within its partition, and partitions are in
    order, so counts per partition tell where a rank is.
    """
    times = df.select(F.unix_micros(ts).alias("t"), F.col(tiebreak).alias("k")).filter(F.col("t").isNotNull())
    placed = pin(times.orderBy("t", "k").select("t", "k", F.monotonically_increasing_id().alias("i")))
    part = F.shiftright("i", 33)
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("i").alias("first")).orderBy("part").collect()
    wanted, before = {}, 0
    for row in parts:
        wanted.update({row["first"] + rank - before: rank for rank in ranks if before <= rank < before + row["n"]})
        before += row["n"]
    found = placed.filter(F.col("i").isin(list(wanted))).collect() if wanted else []
    return {wanted[row["i"]]: (row["t"], row["k"]) for row in found}


def split_by_key(
    df: DataFrame,
    fraction: float = 0.2,
    by: Sequence[str] | str = "sensor_id",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | str = (),
    name: str = "split",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """WIN-12 within each key."""
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    numbered = OrderedRows(df, by, [ts, *ties], rows_per_task).index("_rn", total="_n").result()
    train = F.col("_rn") <= F.col("_n") - F.ceil(F.col("_n") * fraction)
    return numbered.withColumn(
        name, F.when(train, F.lit("train")).otherwise(F.lit("validation"))
    ).drop("_rn", "_n")
