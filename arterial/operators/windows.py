"""Time-window aggregates, shared by batch and streaming (AGG-1, AGG-2, STM-1 to STM-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_aggregate(
    df: DataFrame,
    window: str = "5 minutes",
    slide: str | None = "1 minute",
    watermark: str | None = "10 minutes",
    ts: str = "timestamp",
    key: str = "sensor_id",
) -> DataFrame:
    """AGG-1: averages, totals and counts per window and location.

    ``slide=None`` gives tumbling windows. The watermark only matters on streams. Partial
    aggregation runs before the shuffle, so a busy sensor costs one row per window and task. Sliding windows of tables are
    made of panes as long as the slide, so readings are not copied once per window.
    """
    if slide and not df.isStreaming and _micros(df, window) % _micros(df, slide) == 0:
        return _from_panes(df, window, slide, ts, key)
    if watermark and df.isStreaming:
        df = df.withWatermark(ts, watermark)
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (
        df.groupBy(span.alias("window"), F.col(key).alias("location_id"))
        .agg(
            F.avg("speed").alias("avg_speed"),
            F.sum("vehicle_count").alias("total_vehicles"),
            F.avg("occupancy").alias("avg_occupancy"),
            F.count("*").alias("record_count"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "location_id", "avg_speed", "total_vehicles", "avg_occupancy", "record_count",
        )
    )


def _micros(df: DataFrame, interval: str) -> int:
    length = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {interval}"))
    return df.sparkSession.range(1).select(length).first()[0]


def _from_panes(df: DataFrame, window: str, slide: str, ts: str, key: str) -> DataFrame:
    """Sliding aggregates as sums over panes: totals and counts per pane first, then each pane joins its windows."""
    panes = df.groupBy(F.window(ts, slide)["start"].alias("_pane"), F.col(key).alias("location_id")).agg(
        F.sum(F.col("speed").cast("double")).alias("_speed"), F.count("speed").alias("_speeds"), F.sum("vehicle_count").alias("_vehicles"),
        F.sum(F.col("occupancy").cast("double")).alias("_occupancy"), F.count("occupancy").alias("_occupancies"), F.count("*").alias("_records"),
    )
    first = F.col("_pane") - F.expr(f"interval {window}") + F.expr(f"interval {slide}")
    starts = F.explode(F.sequence(first, F.col("_pane"), F.expr(f"interval {slide}"))).alias("window_start")
    spread = panes.select("*", starts).groupBy("window_start", "location_id")
    return spread.agg(
        F.try_divide(F.sum("_speed"), F.sum("_speeds")).alias("avg_speed"),
        F.sum("_vehicles").alias("total_vehicles"),
        F.try_divide(F.sum("_occupancy"), F.sum("_occupancies")).alias("avg_occupancy"),
        F.sum("_records").alias("record_count"),
    ).select(
        "window_start", (F.col("window_start") + F.expr(f"interval {window}")).alias("window_end"),
        "location_id", "avg_speed", "total_vehicles", "avg_occupancy", "record_count",
    )


def mean_by_hour(df: DataFrame, value: str = "speed", ts: str = "timestamp") -> DataFrame:
    """AGG-2: mean of a column for each hour of the day."""
    return df.groupBy(F.hour(ts).alias("hour")).agg(F.avg(value).alias("mean_" + value))


def rollup_aggregate(df: DataFrame, levels: Sequence[str], ts: str = "timestamp") -> DataFrame:
    """AGG-1 at several levels at once: averages, totals and counts for ``levels`` and every shorter prefix of them.

    ``hour`` among the levels is the hour of ``ts``. Levels rolled up are null; ``grouping_id`` tells them from missing
    values (a bit per level, the last level lowest, set where it is rolled up). Rows are aggregated once at the finest level;
    only those sums are copied per level.
    """
    if "hour" in levels and "hour" not in df.columns:
        df = df.withColumn("hour", F.date_trunc("hour", ts))
    fine = df.groupBy(*levels).agg(
        F.sum(F.col("speed").cast("double")).alias("_speed"), F.count("speed").alias("_speeds"), F.sum("vehicle_count").alias("_vehicles"),
        F.sum(F.col("occupancy").cast("double")).alias("_occupancy"), F.count("occupancy").alias("_occupancies"), F.count("*").alias("_records"),
    )
    return fine.rollup(*levels).agg(
        F.grouping_id().alias("grouping_id"),
        F.try_divide(F.sum("_speed"), F.sum("_speeds")).alias("avg_speed"),
        F.sum("_vehicles").alias("total_vehicles"),
        F.try_divide(F.sum("_occupancy"), F.sum("_occupancies")).alias("avg_occupancy"),
        F.sum("_records").alias("record_count"),
    )
