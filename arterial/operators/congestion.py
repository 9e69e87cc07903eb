"""Congestion flags, forecasts and hotspots (CNG-1/2, AGG-6, TOP-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arterial.functions import traffic
from arterial.functions.temporal import flag
from arterial.operators.joins import lookup_join


def detect_congestion(
    df: DataFrame,
    speed_threshold: float = 0.5,
    occupancy_threshold: float = 80.0,
    density_threshold: float = 50.0,
) -> DataFrame:
    """CNG-1: ``congested_by_*`` flags, ``is_congested`` if any is set, ``congestion_severity``.

    One projection; runs on streams. Existing ``congested_by_*`` columns take part.
    """
    names = set(df.columns)
    columns: dict[str, Column] = {}
    ratio = F.col("speed_ratio") if "speed_ratio" in names else None
    if "speed" in names:
        if "speed_limit" in names:
            ratio = traffic.speed_ratio(F.col("speed"), F.col("speed_limit"))
        else:
            ratio = F.col("speed") / traffic.DEFAULT_SPEED_LIMIT
        columns["speed_ratio"] = ratio
        columns["congested_by_speed"] = flag(ratio < speed_threshold)
    if "occupancy" in names:
        columns["congested_by_occupancy"] = flag(F.col("occupancy") > occupancy_threshold)
    if "density" in names:
        columns["congested_by_density"] = flag(F.col("density") > density_threshold)
    given = [F.col(c) for c in df.columns if c.startswith("congested_by_") and c not in columns]
    flags = [*[c for n, c in columns.items() if n.startswith("congested_by_")], *given]
    anywhere = F.lit(False)
    for f in flags:
        anywhere = anywhere | F.coalesce(f.cast("int") != 0, F.lit(False))
    columns["is_congested"] = flag(anywhere)
    columns["congestion_severity"] = traffic.severity_left(ratio) if ratio is not None else F.lit("none")
    return df.withColumns(columns)


def predicted_congestion(
    current: DataFrame,
    predictions: DataFrame,
    speed_threshold: float = 0.5,
    rows_per_task: int | None = None,
) -> DataFrame:
    """CNG-2/JON-1: join ``predictions(location_id, predicted_speed)`` to current rows and rate them.

    One prediction per location; the ratio is taken without epsilon and a missing limit counts
    as 50.
    """
    limit = F.lit(traffic.DEFAULT_SPEED_LIMIT)
    if "speed_limit" in current.columns:
        limit = F.coalesce(F.col("speed_limit").cast("double"), limit)
    predicted = predictions.select("location_id", "predicted_speed")
    joined = lookup_join(current, predicted, "location_id", "inner", rows_per_task)
    ratio = F.try_divide(F.col("predicted_speed"), limit)
    return joined.select(
        "location_id",
        F.col("predicted_speed").cast("double").alias("predicted_speed"),
        limit.alias("speed_limit"),
        ratio.alias("speed_ratio"),
        F.coalesce(ratio < speed_threshold, F.lit(False)).alias("is_congested"),
        traffic.severity_left(ratio).alias("severity"),
    )


def congestion_summary(df: DataFrame, severity: str = "congestion_severity") -> DataFrame:
    """AGG-6: total, congested and severe locations, counted over the whole table."""
    congested = F.col("is_congested").cast("int") == 1
    return df.agg(
        F.count("*").alias("total_locations"),
        F.count_if(congested).alias("congested_count"),
        F.count_if(F.col(severity) == "severe").alias("severe_count"),
    )


def hotspots(df: DataFrame, n: int = 10) -> DataFrame:
    """TOP-1: the ``n`` worst congested rows: severity, then the lower speed ratio, then the id."""
    if "is_congested" not in df.columns:
        df = detect_congestion(df)
    names = set(df.columns)

    def given(name: str, default: float) -> Column:
        return F.col(name).cast("double") if name in names else F.lit(default)

    severity = F.col("congestion_severity") if "congestion_severity" in names else F.lit("unknown")
    location = F.col("location_id") if "location_id" in names else F.col("sensor_id")
    ratio = F.col("speed_ratio") if "speed_ratio" in names else F.lit(None).cast("double")
    rows = df.filter(F.col("is_congested") == 1).select(
        location.alias("location_id"),
        given("latitude", 0.0).alias("latitude"),
        given("longitude", 0.0).alias("longitude"),
        severity.alias("severity"),
        given("speed", 0.0).alias("speed"),
        given("speed_limit", traffic.DEFAULT_SPEED_LIMIT).alias("speed_limit"),
        given("occupancy", 0.0).alias("occupancy"),
        ratio.alias("_ratio"),
    )
    ties = ["_ratio", "location_id", "latitude", "longitude", "speed", "speed_limit", "occupancy"]
    worst = rows.orderBy(traffic.severity_rank(F.col("severity")).desc(), *ties)
    return worst.limit(n).drop("_ratio")
