"""Seeded readings for tests and demonstrations (SRC-17)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arterial.operators.clean import moment


def _poisson(mean: float, seed: int) -> Column:
    """Inverse-transform sample: the number of cumulative probabilities below a uniform draw.

    The steps end where what is left of the distribution is below the resolution of the draw.
    """
    upto = int(mean + 12 * mean**0.5 + 30)
    probability, cumulative = 2.718281828459045 ** -mean, []
    total = 0.0
    for k in range(upto):
        total += probability
        cumulative.append(total)
        probability *= mean / (k + 1)
    draw = F.rand(seed)
    steps = F.array(*[F.lit(c) for c in cumulative])
    return F.aggregate(steps, F.struct(F.lit(0).alias("n"), draw.alias("u")),
                       lambda s, c: F.struct((s["n"] + (c < s["u"]).cast("int")).alias("n"), s["u"].alias("u")),
                       lambda s: s["n"])


def _clipped_normal(mean: float, std: float, low: float, high: float, seed: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), mean + std * F.randn(seed)))


def _choice(weights: dict[str, float], seed: int) -> Column:
    """Weighted choice from one uniform draw held in a struct, so that it is drawn once per row."""
    total, bounds = 0.0, []
    for name, weight in weights.items():
        total += weight
        bounds.append((name, total))
    options = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(n).alias("n")) for n, b in bounds])
    draw = F.array(F.rand(seed))
    picked = F.transform(draw, lambda u: F.coalesce(F.filter(options, lambda o: u < o["b"])[0]["n"], F.lit(bounds[-1][0])))
    return picked[0]


def _times(spark: SparkSession, start: datetime, end: datetime, step: str, ids: Sequence[str], name: str) -> DataFrame:
    moments = spark.range(1).select(
        F.explode(F.sequence(moment(start), moment(end), F.expr(f"interval {step}"))).alias("timestamp")
    )
    return moments.withColumn(name, F.explode(F.array(*[F.lit(i) for i in ids])))


def sample_loop_detectors(spark, start: datetime, end: datetime, ids: Sequence[str] = ("LD001",), seed: int = 0) -> DataFrame:
    return _times(spark, start, end, "1 minute", ids, "sensor_id").select(
        "timestamp", "sensor_id",
        _poisson(10, seed).alias("vehicle_count"),
        _clipped_normal(50, 10, 0, 100, seed + 1).alias("average_speed"),
        (F.rand(seed + 2) * 100).alias("occupancy"),
        (F.floor(F.rand(seed + 3) * 4) + 1).cast("int").alias("lane"),
    )


def sample_cameras(spark, start: datetime, end: datetime, ids: Sequence[str] = ("CAM001",), seed: int = 0) -> DataFrame:
    levels = {"low": 1 / 3, "medium": 1 / 3, "high": 1 / 3}
    return _times(spark, start, end, "5 minutes", ids, "camera_id").select(
        "timestamp", "camera_id",
        _poisson(15, seed).alias("vehicle_count"),
        _choice(levels, seed + 1).alias("congestion_level"),
        (40.7 + F.rand(seed + 2) * 0.1).alias("latitude"),
        (-74.0 + F.rand(seed + 3) * 0.1).alias("longitude"),
    )


def sample_radars(spark, start: datetime, end: datetime, ids: Sequence[str] = ("RAD001",), seed: int = 0) -> DataFrame:
    kinds = {"car": 0.8, "truck": 0.15, "motorcycle": 0.05}
    return _times(spark, start, end, "30 seconds", ids, "radar_id").select(
        "timestamp", "radar_id",
        _clipped_normal(55, 12, 0, 120, seed).alias("speed"),
        _choice({d: 0.25 for d in "NSEW"}, seed + 1).alias("direction"),
        _choice(kinds, seed + 2).alias("vehicle_type"),
    )
