"""Regular time grids and gap filling (RSM-1, RSM-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arterial.operators.clean import numeric_columns
from arterial.operators.ordering import ROWS_PER_TASK, OrderedRows

FILLS = ("interpolate", "forward_fill", "backward_fill", "drop")
# Grid points one array may hold before it is exploded.
_POINTS = 10_000


def _extents(df: DataFrame, freq: str, by: list[str], ts: str) -> tuple[DataFrame, Column]:
    """First and last bucket of each key, from its raw times (two columns, combined before the shuffle), and the bucket width
    in microseconds."""
    width = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {freq}"))
    start = lambda c: F.timestamp_micros(F.unix_micros(c) - F.pmod(F.unix_micros(c), width))
    return df.groupBy(*by).agg(start(F.min(ts)).alias("_first"), start(F.max(ts)).alias("_last")), width


def grid_size(
    df: DataFrame, freq: str = "1 minute", by: Sequence[str] | str | None = "vehicle_id", ts: str = "timestamp"
) -> DataFrame:
    """``by`` and ``_rows``: how many rows :func:`resample` gives per key, without making the grid."""
    by = [by] if isinstance(by, str) else list(by or [])
    ends, width = _extents(df, freq, by, ts)
    points = F.floor((F.unix_micros("_last") - F.unix_micros("_first")) / width) + 1
    return ends.select(*by, F.coalesce(points, F.lit(0)).alias("_rows"))


def resample(
    df: DataFrame,
    freq: str = "1 minute",
    by: Sequence[str] | str | None = "vehicle_id",
    ts: str = "timestamp",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """RSM-1: mean per bucket, labelled by its start; empty buckets are rows with nulls.

    ``freq`` is an interval of a day or less such as '1 minute' or '30 seconds'.
    """
    by = [by] if isinstance(by, str) else list(by or [])
    columns = numeric_columns(df, exclude=by) if columns is None else list(columns)
    bucket = F.window(ts, freq)["start"]
    means = df.groupBy(*by, bucket.alias(ts)).agg(*[F.avg(c).alias(c) for c in columns])
    step = F.expr(f"interval {freq}")
    ends, _ = _extents(df, freq, by, ts)
    # blocks first, points second, so that a long history is never one array
    block = F.expr(f"interval {freq} * {_POINTS}")
    blocks = ends.select(*by, "_last", F.explode(F.sequence("_first", "_last", block)).alias("_start"))
    # The points of one key are made by many tasks. Blocks are small but their points are not, so the number of tasks is
    # given: left open, adaptive execution puts all blocks into one.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks.repartition(tasks, *by, "_start")
    last = F.least(F.col("_last"), F.col("_start") + block - step)
    grid = blocks.select(*by, F.explode(F.sequence("_start", last, step)).alias(ts))
    # one grouping of grid and means: a missing key is a key here, which an equi-join would not meet
    empty = [F.lit(None).cast(means.schema[c].dataType).alias(c) for c in columns]
    both = grid.select(*by, ts, *empty).unionByName(means.select(*by, ts, *columns))
    return both.groupBy(*by, ts).agg(*[F.max(c).alias(c) for c in columns])


def fill_gaps(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "interpolate",
    by: Sequence[str] | str | None = "vehicle_id",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | str = (),
    rows_per_task: int | None = ROWS_PER_TASK,
    counts: DataFrame | None = None,
) -> DataFrame:
    """RSM-2: fill missing values along time.

    Interpolation is linear in time; before the first value rows stay missing, after the last one
    it is repeated. ``counts`` are known row counts per key, such as :func:`grid_size` of a resampled table, which
    otherwise would be made once more to be counted.
    """
    if method not in FILLS:
        raise ValueError(f"unknown method {method!r}, expected one of {FILLS}")
    columns = list(columns)
    if method == "drop":
        return df.dropna(subset=columns)
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    ordered = OrderedRows(df, by, [ts, *ties], rows_per_task, counts)
    if method != "interpolate":
        backward = method == "backward_fill"
        return ordered.carry({c: F.col(c) for c in columns}, backward).result()
    # time and value apart: numbers combine before a shuffle without a sort, structs do not
    known = {}
    for c in columns:
        there = F.col(c).isNotNull()
        known |= {"t_" + c: F.when(there, F.unix_micros(ts)), "v_" + c: F.when(there, F.col(c).cast("double"))}
    ordered = ordered.carry_both({"_p" + n: k for n, k in known.items()}, {"_n" + n: k for n, k in known.items()})
    filled = {}
    for c in columns:
        t0, v0, t1, v1 = (F.col(p + c) for p in ("_pt_", "_pv_", "_nt_", "_nv_"))
        share = F.try_divide((F.unix_micros(ts) - t0).cast("double"), (t1 - t0).cast("double"))
        filled[c] = F.coalesce(F.col(c).cast("double"), v0 + (v1 - v0) * share, v0)
    helpers = [p + c for c in columns for p in ("_pt_", "_pv_", "_nt_", "_nv_")]
    return ordered.result().withColumns(filled).drop(*helpers)
