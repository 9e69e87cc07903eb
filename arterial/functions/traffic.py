"""Traffic measures, congestion levels and texts (TRF-1 to TRF-6, STR-1 to STR-3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arterial.functions.temporal import flag

# Fixed values.
EPSILON = 1e-6
DEFAULT_SPEED_LIMIT = 50.0
SEVERITIES = ("none", "low", "medium", "high", "severe")
BOUNDS = (("severe", 0.3), ("high", 0.5), ("medium", 0.7), ("low", 1.0))


def density(flow_rate: Column, speed: Column) -> Column:
    """TRF-1: vehicles per km, 0 where unknown."""
    return F.coalesce(F.try_divide(flow_rate, speed + F.lit(EPSILON)), F.lit(0.0))


def speed_ratio(speed: Column, speed_limit: Column) -> Column:
    return speed / (speed_limit + F.lit(EPSILON))


def level_right(ratio: Column) -> Column:
    """TRF-3: bins closed on the right; zero, negative and missing ratios have no level."""
    level = F.when(ratio.isNull() | F.isnan(ratio) | (ratio <= 0), F.lit(None).cast("string"))
    for name, upper in BOUNDS:
        level = level.when(ratio <= upper, F.lit(name))
    return level.otherwise(F.lit("none"))


def severity_left(ratio: Column) -> Column:
    """TRF-4: bins closed on the left; missing ratios are 'none'."""
    severity = F.when(ratio.isNull() | F.isnan(ratio), F.lit("none"))
    for name, upper in BOUNDS:
        severity = severity.when(ratio < upper, F.lit(name))
    return severity.otherwise(F.lit("none"))


def severity_rank(severity: Column) -> Column:
    """STR-1: none 0 ... severe 4, unknown names 0."""
    name = F.lower(severity)
    rank = F.when(name == SEVERITIES[1], 1)
    for value, known in enumerate(SEVERITIES[2:], start=2):
        rank = rank.when(name == known, value)
    return rank.otherwise(0)


def occupancy_normalized(occupancy: Column) -> Column:
    return occupancy / 100.0


def is_high_occupancy(occupancy: Column, threshold: float = 80.0) -> Column:
    return flag(occupancy > threshold)


def travel_time_minutes(km: Column, kmh: Column) -> Column:
    """TRF-6: 0 when the speed is not positive."""
    return F.when(kmh > 0, km / kmh * 60.0).otherwise(F.lit(0.0))


def metric_line(metric: Column, value: Column) -> Column:
    """STR-3: one line of the metrics summary."""
    name = F.upper(metric)
    return F.when(
        F.lower(metric) == "mape", F.format_string("%s: %.2f%%", name, value)
    ).otherwise(F.format_string("%s: %.4f", name, value))
