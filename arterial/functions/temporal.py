"""Calendar features of a timestamp (DT-1 to DT-9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def day_of_week_sun1(ts: Column) -> Column:
    """Sunday = 1 ... Saturday = 7 (the batch job's convention)."""
    return F.dayofweek(ts)


def is_weekend_sun1(ts: Column) -> Column:
    return flag(F.dayofweek(ts).isin(1, 7))


def _between(c: Column, start: int, end: int) -> Column:
    return (c >= start) & (c < end)


def temporal_columns(ts: Column) -> dict[str, Column]:
    """All calendar features; ``day_of_week`` counts from Monday = 0."""
    hour, weekday, month = F.hour(ts), F.weekday(ts), F.month(ts)
    columns = {
        "hour": hour,
        "day_of_week": weekday,
        "day_of_month": F.dayofmonth(ts),
        "month": month,
        "quarter": F.quarter(ts),
        "year": F.year(ts),
    }
    for name, value, period in (("hour", hour, 24), ("day_of_week", weekday, 7), ("month", month, 12)):
        angle = F.lit(2.0) * F.pi() * value / F.lit(float(period))
        columns[name + "_sin"] = F.sin(angle)
        columns[name + "_cos"] = F.cos(angle)
    morning_rush, evening_rush = _between(hour, 7, 10), _between(hour, 17, 20)
    columns |= {
        "is_weekend": flag(weekday >= 5),
        "is_weekday": flag(weekday < 5),
        "is_morning": flag(_between(hour, 6, 12)),
        "is_afternoon": flag(_between(hour, 12, 18)),
        "is_evening": flag(_between(hour, 18, 22)),
        "is_night": flag((hour >= 22) | (hour < 6)),
        "is_rush_hour_morning": flag(morning_rush),
        "is_rush_hour_evening": flag(evening_rush),
        "is_rush_hour": flag(morning_rush | evening_rush),
    }
    return columns


def temporal_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """DT-8: add the calendar features in one projection; unchanged without the column."""
    if ts not in df.columns:
        return df
    return df.withColumns(temporal_columns(F.col(ts)))


def batch_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """DT-9: typed timestamp, hour, Sunday = 1 weekday and weekend flag."""
    kind = dict(df.dtypes)[ts]
    # text that is no time becomes null instead of failing the job
    stamp = F.try_to_timestamp(F.col(ts)) if kind == "string" else F.col(ts).cast("timestamp")
    return df.withColumns(
        {
            ts: stamp,
            "hour": F.hour(stamp),
            "day_of_week_sun1": day_of_week_sun1(stamp),
            "is_weekend": is_weekend_sun1(stamp),
        }
    )
