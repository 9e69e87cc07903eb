"""Feature bundles over readings (PRJ-6, GEO-3, WIN-1 to WIN-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from arterial.functions import traffic
from arterial.functions.geo import CITY_CENTER, distance_from
from arterial.functions.temporal import flag
from arterial.operators.ordering import ROWS_PER_TASK, OrderedRows

ROLLED = ("speed", "vehicle_count", "flow_rate", "occupancy")
LAGS = (1, 2, 3, 5, 10)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference in seconds with microseconds kept."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def spatial_features(
    df: DataFrame, lat: float = CITY_CENTER[0], lon: float = CITY_CENTER[1]
) -> DataFrame:
    """PRJ-6 + GEO-3: default road attributes and distance from the centre."""
    if not {"latitude", "longitude"} <= set(df.columns):
        return df
    defaults = {
        "road_type": F.lit("unknown"), "num_lanes": F.lit(2), "speed_limit": F.lit(traffic.DEFAULT_SPEED_LIMIT)
    }
    df = df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})
    return distance_from(df, lat, lon)


def flow_rate(w: WindowSpec, ts: str = "timestamp") -> Column:
    """WIN-1: vehicles per hour since the previous reading, 0 for the first one."""
    hours = seconds_between(F.col(ts), F.lag(ts).over(w)) / 3600.0 + F.lit(traffic.EPSILON)
    return F.coalesce(F.try_divide(F.col("vehicle_count").cast("double"), hours), F.lit(0.0))


def rolling(w: WindowSpec, columns: Sequence[str], exclude_current: bool = False) -> dict[str, Column]:
    """WIN-2/3: means over 5 and 10 rows and sample deviation over 5 rows.

    ``exclude_current`` shifts the frames one row back, so that a target column does not appear
    among its own features.
    """
    last = -1 if exclude_current else 0
    five = w.rowsBetween(last - 4, last)
    ten = w.rowsBetween(last - 9, last)
    out = {}
    for c in columns:
        value = F.col(c).cast("double")
        out[c + "_rolling_mean_5"] = F.avg(value).over(five)
        out[c + "_rolling_std_5"] = F.stddev_samp(value).over(five)
        out[c + "_rolling_mean_10"] = F.avg(value).over(ten)
    return out


def traffic_features(
    df: DataFrame,
    by: Sequence[str] | str | None = "sensor_id",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | str = (),
    exclude_current: bool = False,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """WIN-4: flow rate, density, congestion, occupancy and rolling features in one shuffle.

    Columns are added where their inputs exist. ``by=None`` orders the whole table.
    """
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    have = set(df.columns)
    derives_flow = {"vehicle_count", ts} <= have

    def row_wise(rows: DataFrame) -> DataFrame:
        names = set(rows.columns)
        columns: dict[str, Column] = {}
        if {"speed", "flow_rate"} <= names:
            columns["density"] = traffic.density(F.col("flow_rate"), F.col("speed"))
        if {"speed", "speed_limit"} <= names:
            ratio = traffic.speed_ratio(F.col("speed"), F.col("speed_limit"))
            columns["speed_ratio"] = ratio
            columns["is_congested"] = flag(ratio < 0.5)
            columns["congestion_level"] = traffic.level_right(ratio)
        if "occupancy" in names:
            columns["occupancy_normalized"] = traffic.occupancy_normalized(F.col("occupancy"))
            columns["is_high_occupancy"] = traffic.is_high_occupancy(F.col("occupancy"))
        return rows.withColumns(columns) if columns else rows

    if ts not in have:
        return row_wise(df)

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        if derives_flow:
            rows = rows.withColumn("flow_rate", flow_rate(w, ts))
        rows = row_wise(rows)
        return rows.withColumns(rolling(w, [c for c in ROLLED if c in rows.columns], exclude_current))

    # ten rows of rolling frame, and one more because flow_rate looks back itself
    ordered = OrderedRows(df, by, [ts, *ties], rows_per_task)
    return ordered.rows(build, behind=11).result()


def lag_features(
    df: DataFrame,
    columns: Sequence[str],
    lags: Sequence[int] = LAGS,
    by: Sequence[str] | str | None = "sensor_id",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | str = (),
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """WIN-5: ``<column>_lag_<k>``."""
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    present = [c for c in columns if c in df.columns]
    if ts not in df.columns or not present or not lags:
        return df

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns({f"{c}_lag_{k}": F.lag(c, k).over(w) for c in present for k in lags})

    return OrderedRows(df, by, [ts, *ties], rows_per_task).rows(build, behind=max(lags)).result()
