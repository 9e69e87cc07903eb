"""Feature scaling with stored statistics (AGG-3, NRM-1 to NRM-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arterial.operators.clean import numeric_columns
from arterial.operators.quantiles import exact_quantiles

METHODS = ("min_max", "standard", "robust")
# Calendar numbers stay as they are.
NOT_SCALED = ("hour", "day_of_week", "month", "year", "day_of_month", "quarter")
STATS_SCHEMA = "feature STRING, method STRING, center DOUBLE, scale DOUBLE"


def default_columns(df: DataFrame) -> list[str]:
    """NRM-5."""
    return numeric_columns(df, exclude=NOT_SCALED)


def fit_normalizer(df: DataFrame, columns: Sequence[str] | None = None, method: str = "min_max") -> DataFrame:
    """AGG-3: one row ``(feature, method, center, scale)`` per column.

    min_max: minimum and range; standard: mean and sample deviation; robust: median and
    interquartile range.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, expected one of {METHODS}")
    columns = default_columns(df) if columns is None else [c for c in columns if c in df.columns]
    spark = df.sparkSession
    if method == "robust":
        quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
        rows = [
            (c, method, q[1], None if q[0] is None else q[2] - q[0]) for c, q in quartiles.items()
        ]
        return spark.createDataFrame(rows, STATS_SCHEMA)
    if not columns:
        return spark.createDataFrame([], STATS_SCHEMA)
    entries = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        if method == "min_max":
            center, scale = F.min(value), F.max(value) - F.min(value)
        else:
            center, scale = F.avg(value), F.stddev_samp(value)
        entries.append(
            F.struct(
                F.lit(c).alias("feature"), F.lit(method).alias("method"),
                center.alias("center"), scale.alias("scale"),
            ).alias(f"_s{i}")
        )
    row = df.agg(*entries)
    return row.select(F.explode(F.array(*row.columns)).alias("s")).select("s.*")


def apply_normalizer(df: DataFrame, stats: DataFrame, constant: str = "zero") -> DataFrame:
    """NRM-1 to NRM-4, NRM-6: scale the columns ``stats`` knows; works on streams as well.

    Columns without spread become 0.0, or stay as they are with ``constant="keep"`` (what the
    transform-only path of a stored scaler does).
    """
    if constant not in ("zero", "keep"):
        raise ValueError(f"constant must be 'zero' or 'keep', not {constant!r}")
    scaled = {}
    for row in stats.collect():  # one row per column of the table
        name, center, scale = row["feature"], row["center"], row["scale"]
        if name not in df.columns:
            continue
        value = F.col(name).cast("double")
        if scale is not None and scale > 0:
            scaled[name] = (value - F.lit(center)) / F.lit(scale)
        elif constant == "zero":
            scaled[name] = F.lit(0.0)
    return df.withColumns(scaled) if scaled else df


def normalize(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "min_max"
) -> tuple[DataFrame, DataFrame]:
    """Fit and scale: (scaled rows, statistics)."""
    stats = fit_normalizer(df, columns, method)
    stats = df.sparkSession.createDataFrame(stats.collect(), STATS_SCHEMA)
    return apply_normalizer(df, stats), stats
