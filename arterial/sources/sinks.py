"""Batch sinks (SNK-6, SNK-7)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arterial.functions.temporal import batch_features


def write_batch(df: DataFrame | pd.DataFrame, path: str | None, ts: str = "timestamp") -> DataFrame:
    """SNK-6 with DT-9: add the batch features, overwrite ``path`` partitioned by day, return them.

    A pandas frame is taken in as a table first; without a path nothing is written. Rows of a day meet
    in as many tasks as the day needs: AQE splits large partitions of a rebalance.
    """
    if isinstance(df, pd.DataFrame):
        df = SparkSession.active().createDataFrame(df)
    processed = batch_features(df, ts)
    if path is None:
        return processed
    dated = processed.withColumn("date", F.to_date(ts))
    dated.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(path)
    return processed


def write_landed(df: DataFrame, path: str, city: str, ts: str = "timestamp") -> None:
    """SNK-7: land a fetch, partitioned by city and day.

    A fetch holds whole days: its days replace what was landed for them before, so fetching a range twice does no harm.
    """
    landed = df.withColumns({"city": F.lit(city), "date": F.to_date(ts)})
    writer = landed.hint("rebalance", "city", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("city", "date").parquet(path)
