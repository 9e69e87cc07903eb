"""Column naming, type coercion and cleaning (PRJ-1 to PRJ-7, TYP-1/2, CLN-1 to CLN-3)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arterial.schemas import TRAFFIC_READING

# Accepted column names, in order of preference.
ALIASES = {
    "latitude": ("latitude", "lat"),
    "longitude": ("longitude", "lon", "lng"),
    "timestamp": ("timestamp", "time", "datetime", "date_time"),
}
CITY_TIMESTAMPS = ("timestamp", "datetime", "created_date", "date")
TRAVEL_TIMESTAMPS = ("datetime", "timestamp")
TRAVEL_NUMBERS = ("travel_time", "distance", "speed")
CITY_NUMBERS = ("speed", "volume", "occupancy", "latitude", "longitude")
# Devices use their own names for the same thing.
SENSOR_NAMES = {"average_speed": "speed", "camera_id": "sensor_id", "radar_id": "sensor_id"}


def rename_aliases(df: DataFrame) -> DataFrame:
    """PRJ-1: one column per logical name; several aliases are coalesced in order of preference."""
    for target, names in ALIASES.items():
        present = [n for n in names if n in df.columns]
        if not present or present == [target]:
            continue
        if len(present) == 1:
            df = df.withColumnRenamed(present[0], target)
        else:
            merged = F.coalesce(*[F.col(n).cast("string") for n in present]).alias(target)
            df = df.select(*[c for c in df.columns if c not in present], merged)
    return df


def canonical_names(df: DataFrame) -> DataFrame:
    """``average_speed`` to ``speed``; ``camera_id`` and ``radar_id`` to ``sensor_id``."""
    return df.withColumnsRenamed(
        {old: new for old, new in SENSOR_NAMES.items() if old in df.columns and new not in df.columns}
    )


def pick_timestamp(df: DataFrame, candidates: Sequence[str] = CITY_TIMESTAMPS) -> DataFrame:
    """PRJ-2/3 + TYP-2: ``timestamp`` from a row's first candidate with a value; unreadable values are null."""
    present = [name for name in candidates if name in df.columns]
    if not present:
        return df
    if len(present) == 1:
        return df.withColumn("timestamp", parsed_timestamp(df, present[0]))
    first = F.lit(None).cast("timestamp")
    for name in reversed(present):
        first = F.when(F.col(name).isNotNull(), parsed_timestamp(df, name)).otherwise(first)
    return df.withColumn("timestamp", first)


def moment(value: datetime | Column | None) -> Column:
    """A point in time, the current one by default. Naive datetimes are in the session's time zone."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value.isoformat(sep=" ")).cast("timestamp")


def parsed_timestamp(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.col(name)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    return F.try_to_timestamp(F.col(name).cast("string"))


def ensure_timestamp(df: DataFrame) -> DataFrame:
    """PRJ-4: a table without ``timestamp`` gets the current (processing) time."""
    if "timestamp" in df.columns:
        return df.withColumn("timestamp", parsed_timestamp(df, "timestamp"))
    return df.withColumn("timestamp", F.current_timestamp())


def to_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """TYP-1: doubles; values that are no number, and NaN, become null."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    numbers = {c: F.col(c).try_cast("double") for c in present}
    return df.withColumns({c: F.when(~F.isnan(n), n) for c, n in numbers.items()})


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make NaN missing, as the aggregates and comparisons of this package expect."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in floats})


def clean_travel_times(df: DataFrame) -> DataFrame:
    """CLN-1. Row order is left to whoever writes the result."""
    cleaned = to_numbers(pick_timestamp(df, TRAVEL_TIMESTAMPS), TRAVEL_NUMBERS)
    return cleaned.dropna(subset=["timestamp"])


def clean_city_sensors(df: DataFrame) -> DataFrame:
    """CLN-2. Row order is left to whoever writes the result."""
    cleaned = to_numbers(pick_timestamp(df, CITY_TIMESTAMPS), CITY_NUMBERS)
    return cleaned.dropna(subset=["timestamp"])


def clean_trajectory(df: DataFrame) -> DataFrame:
    """PRJ-1 + PRJ-4 + TYP-1/2 for trajectory tables."""
    df = rename_aliases(df)
    if "timestamp" in df.columns:
        df = df.withColumn("timestamp", parsed_timestamp(df, "timestamp"))
    else:
        df = ensure_timestamp(df)
    return to_numbers(df, ["latitude", "longitude"])


def parse_payload(
    df: DataFrame, schema: T.StructType = TRAFFIC_READING, keep_corrupt: bool = False
) -> DataFrame:
    """PRJ-5/JSON-1: typed columns from a JSON ``value`` column; other tables pass unchanged.

    With ``keep_corrupt`` unreadable payloads stay as rows whose ``_corrupt`` holds the text.
    """
    if "value" not in df.columns:
        return df
    wanted = T.StructType([*schema.fields])
    if keep_corrupt:
        wanted = wanted.add("_corrupt", T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json(F.col("value").cast("string"), wanted, options)
    return df.select(parsed.alias("data")).select("data.*")


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the unreadable payload texts."""
    good = parsed.filter(F.col("_corrupt").isNull()).drop("_corrupt")
    return good, parsed.filter(F.col("_corrupt").isNotNull()).select("_corrupt")


def in_time_order(df: DataFrame, ts: str = "timestamp", tiebreak: Sequence[str] = ()) -> DataFrame:
    """SRT-1: for output; a range-partitioned sort. Operators order their rows themselves."""
    return df.orderBy(ts, *tiebreak)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def feature_columns(df: DataFrame, target: str = "speed", exclude: Sequence[str] = ()) -> list[str]:
    """PRJ-7: numeric columns but the target and the outlier flag."""
    return numeric_columns(df, exclude=[target, "timestamp", "is_outlier", *exclude])


def fill_missing(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    """CLN-3: null, NaN and infinite values become ``value``."""

    def finite(name: str):
        c = F.col(name).cast("double")
        usable = c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
        return F.when(usable, c).otherwise(F.lit(value))

    return df.withColumns({c: finite(c) for c in columns})
