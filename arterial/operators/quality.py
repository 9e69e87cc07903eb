"""Validation, outliers and profiling (VAL-1 to VAL-4, OUT-1 to OUT-3, QLT-1 to QLT-4, SET-2)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arterial.functions.temporal import flag
from arterial.operators.clean import moment, numeric_columns, parsed_timestamp
from arterial.operators.features import seconds_between
from arterial.operators.quantiles import exact_quantiles

NUMERIC_COLUMNS = ("speed", "volume", "occupancy", "vehicle_count")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """SET-2: required names the table lacks."""
    return [c for c in required if c not in df.columns]


def _long_form(counts: DataFrame, checks: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per check from one row of counts."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                (F.col(name) == 0).alias("passed"),
                F.col(name).alias("n_bad"),
                F.when(F.col(name) > 0, F.concat(F.col(name).cast("string"), F.lit(" " + text))).alias("message"),
            )
            for name, text in checks
        ]
    )
    return counts.select(F.explode(entries).alias("c")).select("c.*")


def _count_if(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def validate_readings(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """VAL-1: ``(check_name, passed, n_bad, message)``; the data is read once."""
    counts = [flag(F.count("*") == 0).cast("long").alias("empty")]
    checks = [("empty", "table without rows")]
    lacking = missing_columns(df, required)
    counts.append(F.lit(len(lacking)).cast("long").alias("required_columns"))
    checks.append(("required_columns", "required columns missing: " + ", ".join(lacking)))
    has_timestamp = "timestamp" in df.columns
    counts.append(F.lit(0 if has_timestamp else 1).cast("long").alias("timestamp_column"))
    checks.append(("timestamp_column", "timestamp column missing"))
    if has_timestamp:
        stamp = F.col("timestamp")
        counts.append(
            _count_if(stamp.isNotNull() & parsed_timestamp(df, "timestamp").isNull()).alias("timestamp_format")
        )
        checks.append(("timestamp_format", "unreadable timestamps"))
        counts.append(_count_if(stamp.isNull()).alias("timestamp_missing"))
        checks.append(("timestamp_missing", "missing timestamps"))
    for c in NUMERIC_COLUMNS:
        if c in df.columns:
            numeric = isinstance(df.schema[c].dataType, T.NumericType)
            counts.append(F.lit(0 if numeric else 1).cast("long").alias(c + "_numeric"))
            checks.append((c + "_numeric", f"column {c} not numeric"))
    return _long_form(df.agg(*counts), checks)


def is_valid(checks: DataFrame) -> bool:
    return checks.filter(~F.col("passed")).isEmpty()


def _time_checks(
    df: DataFrame, min_ts: datetime | None, max_ts: datetime | None, now: datetime | None
) -> dict[str, Column]:
    stamp = parsed_timestamp(df, "timestamp")
    rules = {}
    if min_ts is not None:
        rules["before_minimum"] = stamp < moment(min_ts)
    if max_ts is not None:
        rules["after_maximum"] = stamp > moment(max_ts)
    rules["in_future"] = stamp > moment(now) + F.expr("interval 1 hour")
    return rules


def _geo_checks(min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> dict[str, Column]:
    lat, lon = F.col("latitude"), F.col("longitude")
    return {
        "latitude_bounds": (lat < min_lat) | (lat > max_lat),
        "longitude_bounds": (lon < min_lon) | (lon > max_lon),
    }


def validate_timestamp_range(
    df: DataFrame,
    min_ts: datetime | None = None,
    max_ts: datetime | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """VAL-2: timestamps before, after, and more than an hour in the future."""
    texts = {
        "before_minimum": f"timestamps before {min_ts}",
        "after_maximum": f"timestamps after {max_ts}",
        "in_future": "timestamps in the future",
    }
    rules = _time_checks(df, min_ts, max_ts, now)
    counts = df.agg(*[_count_if(rule).alias(name) for name, rule in rules.items()])
    return _long_form(counts, [(name, texts[name]) for name in rules])


def validate_geographic_bounds(
    df: DataFrame,
    min_lat: float = -90.0,
    max_lat: float = 90.0,
    min_lon: float = -180.0,
    max_lon: float = 180.0,
) -> DataFrame:
    """VAL-3: coordinates outside the bounds; tables without coordinates are valid."""
    texts = {"latitude_bounds": "latitudes out of bounds", "longitude_bounds": "longitudes out of bounds"}
    if not {"latitude", "longitude"} <= set(df.columns):
        zero = df.sparkSession.range(1).select(*[F.lit(0).cast("long").alias(n) for n in texts])
        return _long_form(zero, list(texts.items()))
    rules = _geo_checks(min_lat, max_lat, min_lon, max_lon)
    counts = df.agg(*[_count_if(rule).alias(name) for name, rule in rules.items()])
    return _long_form(counts, list(texts.items()))


def quarantine(
    df: DataFrame,
    min_ts: datetime | None = None,
    max_ts: datetime | None = None,
    now: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """VAL-4: (good, bad) rows by the row rules of VAL-1 to VAL-3; bad rows list their ``errors``."""
    rules: dict[str, Column] = {}
    if "timestamp" in df.columns:
        rules["timestamp_missing"] = parsed_timestamp(df, "timestamp").isNull()
        rules |= _time_checks(df, min_ts, max_ts, now)
    if {"latitude", "longitude"} <= set(df.columns):
        rules |= _geo_checks(-90.0, 90.0, -180.0, 180.0)
    if not rules:
        return df, df.filter(F.lit(False)).withColumn("errors", F.array().cast("array<string>"))
    errors = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    checked = df.withColumn("errors", errors)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


# -- outliers ------------------------------------------------------------------------------------


def outlier_limits(
    df: DataFrame, columns: Sequence[str], method: str = "iqr", threshold: float = 3.0
) -> dict[str, tuple[float | None, float | None]]:
    """Inclusive limits of ordinary values: two numbers per column.

    iqr: Q1 - 1.5 IQR and Q3 + 1.5 IQR with exact quartiles; zscore: mean -/+ threshold * deviation.
    A limit is None where it is undefined.
    """
    columns = [c for c in columns if c in df.columns]
    if method == "iqr":
        limits = {}
        for c, (q1, q3) in exact_quantiles(df, columns, (0.25, 0.75)).items():
            limits[c] = (None, None) if q1 is None else (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        return limits
    if method != "zscore":
        raise ValueError(f"unknown outlier method {method!r}")
    if not columns:
        return {}
    row = df.agg(
        *[F.avg(c).alias("m_" + c) for c in columns], *[F.stddev_samp(c).alias("s_" + c) for c in columns]
    ).first()
    limits = {}
    for c in columns:
        mean, std = row["m_" + c], row["s_" + c]
        limits[c] = (mean - threshold * std, mean + threshold * std) if std else (None, None)
    return limits


# Size of the quantile sketches and the rank error it gives, as a share of the rows: published for this kind of sketch, for
# one quantile at 99 % confidence. 2.296 / k ** 0.9723.
SKETCH_K = 1000
SKETCH_ERROR = 2.296 / SKETCH_K**0.9723


def daily_sketches(df: DataFrame, columns: Sequence[str], ts: str = "timestamp") -> DataFrame:
    """``(day, name, n, sketch)``: a mergeable quantile sketch of every column and day, a few KB each.

    Store it by day and add the sketches of new days; nothing has to be read again for limits over any range of days.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])).alias("p")
    values = df.select(F.to_date(ts).alias("day"), pairs).select("day", "p.*").where("value is not null and not isnan(value)")
    return values.groupBy("day", "name").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("value", SKETCH_K).alias("sketch"))


def merged_quantiles(sketches: DataFrame, ranks: Sequence[float] = (0.25, 0.75), start: date | None = None, end: date | None = None) -> DataFrame:
    """``(name, n, quantiles)`` of the days from ``start`` to ``end``, each quantile within ``SKETCH_ERROR`` of its rank."""
    if start is not None:
        sketches = sketches.where(F.col("day") >= F.lit(start))
    if end is not None:
        sketches = sketches.where(F.col("day") <= F.lit(end))
    merged = sketches.groupBy("name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"))
    found = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(r))) for r in ranks])
    return merged.select("name", "n", found.alias("quantiles"))


def sketched_limits(sketches: DataFrame, start: date | None = None, end: date | None = None) -> dict[str, tuple[float, float]]:
    """OUT-1's limits from merged sketches instead of exact quartiles: two numbers per column."""
    rows = merged_quantiles(sketches, (0.25, 0.75), start, end).collect()
    return {r["name"]: (r["quantiles"][0] - 1.5 * (d := r["quantiles"][1] - r["quantiles"][0]), r["quantiles"][1] + 1.5 * d) for r in rows}


def detect_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "iqr", threshold: float = 3.0,
    limits: dict[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """OUT-1/2: ``is_outlier`` where any column lies outside its limits; missing values never do.

    ``limits`` known already (of :func:`sketched_limits`, say) save the pass that finds them.
    """
    columns = numeric_columns(df) if columns is None else columns
    outside = F.lit(False)
    for c, (low, high) in (outlier_limits(df, columns, method, threshold) if limits is None else limits).items():
        if low is not None:
            value = F.col(c).cast("double")
            outside = outside | F.coalesce((value < low) | (value > high), F.lit(False))
    return df.withColumn("is_outlier", outside)


def remove_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "iqr", threshold: float = 3.0
) -> DataFrame:
    """OUT-3."""
    return detect_outliers(df, columns, method, threshold).filter(~F.col("is_outlier")).drop("is_outlier")


# -- profile -------------------------------------------------------------------------------------


def _is_missing(df: DataFrame, name: str) -> Column:
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(name)
    return missing


def missing_report(df: DataFrame) -> DataFrame:
    """QLT-1: ``(column_name, missing, percentage)`` of the columns that have gaps."""
    counts = df.agg(
        F.count("*").alias("_total"),
        *[_count_if(_is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing"))
            for i, c in enumerate(df.columns)
        ]
    )
    rows = counts.select("_total", F.explode(entries).alias("e")).select("_total", "e.*")
    share = (F.col("missing") / F.col("_total") * 100).alias("percentage")
    return rows.filter(F.col("missing") > 0).select("column_name", "missing", share)


def type_report(df: DataFrame) -> DataFrame:
    """QLT-2: ``(column_name, data_type, total_records, total_columns)``."""
    entries = F.array(
        *[F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("data_type")) for n, t in df.dtypes]
    )
    return (
        df.agg(F.count("*").alias("total_records"))
        .select(F.explode(entries).alias("e"), "total_records")
        .select("e.*", "total_records", F.lit(len(df.columns)).alias("total_columns"))
    )


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """QLT-3: ``(column_name, mean, std, min, max, median)`` of numeric columns."""
    columns = numeric_columns(df) if columns is None else list(columns)
    medians = {c: q[0] for c, q in exact_quantiles(df, columns, (0.5,)).items()}
    aggregates = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        aggregates.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                F.lit(medians[c]).cast("double").alias("median"),
            ).alias(f"_c{i}")
        )
    if not aggregates:
        raise ValueError("no numeric columns to profile")
    row = df.agg(*aggregates)
    return row.select(F.explode(F.array(*row.columns)).alias("p")).select("p.*")


def timestamp_extent(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """QLT-4: ``(earliest, latest, span_hours)``."""
    extent = df.agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"))
    span = seconds_between(F.col("latest"), F.col("earliest")) / 3600.0
    return extent.withColumn("span_hours", span)
