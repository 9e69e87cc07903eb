"""Error metrics and their history (AGG-4, AGG-5, STR-3)."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arterial.functions.traffic import metric_line

METRICS = ("mae", "rmse", "mape", "r2", "mse")
HISTORY_SCHEMA = "run_id STRING, seq BIGINT, metric STRING, value DOUBLE"


def metric_expressions(y_true: str = "y_true", y_pred: str = "y_pred") -> dict[str, Column]:
    y, p = F.col(y_true).cast("double"), F.col(y_pred).cast("double")
    error = y - p
    both = error.isNotNull()
    squared = F.sum(error * error)
    spread = F.var_pop(F.when(both, y)) * F.count(error)
    mape = F.avg(F.when(y != 0, F.abs(error / F.when(y != 0, y)))) * 100
    # constant targets: 1 for exact predictions, else 0
    flat = F.when(squared == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "mape": F.when(F.count(error) > 0, F.coalesce(mape, F.lit(float("inf")))),
        "r2": F.when(spread > 0, 1 - squared / spread).when(F.count(error) > 0, flat),
        "mse": F.avg(error * error),
    }


def error_metrics(
    df: DataFrame,
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    by: Sequence[str] | str = (),
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """AGG-4: one row (per group) with a column per metric; one pass, combined before the shuffle."""
    by = [by] if isinstance(by, str) else list(by)
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}")
    expressions = metric_expressions(y_true, y_pred)
    return df.groupBy(*by).agg(*[expressions[m].alias(m) for m in metrics])


def metric_rows(metrics: DataFrame, run_id: str | Column, seq: int | Column) -> DataFrame:
    """AGG-5: metrics as history rows ``(run_id, seq, metric, value)`` to append to a table."""
    names = [c for c in metrics.columns if c in METRICS]
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    number = seq if isinstance(seq, Column) else F.lit(seq)
    rows = metrics.select(
        run.alias("run_id"), number.cast("long").alias("seq"), F.explode(entries).alias("e")
    )
    return rows.select("run_id", "seq", "e.*")


def average_metrics(history: DataFrame) -> DataFrame:
    return history.groupBy("run_id", "metric").agg(F.avg("value").alias("value"))


def latest_metrics(history: DataFrame) -> DataFrame:
    return history.groupBy("run_id", "metric").agg(F.max_by("value", "seq").alias("value"))


def metrics_summary(averages: DataFrame) -> DataFrame:
    """STR-3: one text per run, a line per metric in the fixed metric order."""
    order = F.array_position(F.array(*[F.lit(m) for m in METRICS]), F.col("metric"))
    lines = averages.groupBy("run_id").agg(
        F.sort_array(F.collect_list(F.struct(order.alias("o"), metric_line(F.col("metric"), F.col("value")).alias("l")))).alias("lines")
    )
    text = F.array_join(F.transform("lines", lambda e: e["l"]), "\n")
    return lines.select("run_id", F.concat(F.lit("Metrics Summary:\n" + "-" * 50 + "\n"), text).alias("summary"))


class MetricStore:
    """AGG-5 as a table: append-only history below ``path``, in runs.

    An attempt is named by its caller. Its first append claims the next number of the run by creating a file that must not
    exist yet; a repeated append of the same name finds its claim and overwrites its own rows, so retries neither double rows
    nor change the order. ``reset`` starts a new run and deletes nothing. Stores whose create is atomic, such as HDFS, keep
    attempts of several drivers apart; on other disks one driver should write.
    """

    _claiming = threading.Lock()

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.files = self._fs.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._fs.Path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self.files.listStatus(at)) if self.files.exists(at) else []

    def _claim(self, name: str, text: str) -> bool:
        """Create a file that says ``text``; False if there is one of that name."""
        at = self._fs.Path(f"{self.path}/{name}")
        try:
            out = self.files.create(at, False)
        except Py4JJavaError:
            if self.files.exists(at):
                return False
            raise
        out.writeUTF(text)
        out.close()
        return True

    def _said(self, name: str) -> str | None:
        """What a file says; None while its writer, another attempt, is still at it."""
        stream = self.files.open(self._fs.Path(f"{self.path}/{name}"))
        try:
            return stream.readUTF()
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "EOFException":
                return None
            raise
        finally:
            stream.close()

    @property
    def run(self) -> int:
        """The current run; 0 is the first."""
        return len(self._names("_runs"))

    def reset(self) -> int:
        """Start a new run."""
        number = self.run
        while not self._claim(f"_runs/{number:010d}", ""):
            number += 1
        return number + 1

    def append(self, metrics: DataFrame, attempt: str) -> int:
        """Add the metrics (:func:`error_metrics`) of one update; returns its number within the run."""
        run = self.run
        folder = f"_claims/run={run}"
        with self._claiming:  # local disks create files in two steps
            names = self._names(folder)
            number = next((int(n) for n in names if self._said(f"{folder}/{n}") == attempt), None)
            if number is None:
                number = len(names)
                while not self._claim(f"{folder}/{number:010d}", attempt):
                    number += 1
        rows = metric_rows(metrics, f"run-{run}", number)
        rows.write.mode("overwrite").parquet(f"{self.path}/run={run}/seq_number={number}")
        return number

    def history(self, run: int | None = None) -> DataFrame:
        """``(run_id, seq, metric, value)`` of the current run, or of an earlier one."""
        at = f"{self.path}/run={self.run if run is None else run}"
        if not self.files.exists(self._fs.Path(at)):
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(at)

    def average(self, run: int | None = None) -> DataFrame:
        return average_metrics(self.history(run))

    def latest(self, run: int | None = None) -> DataFrame:
        return latest_metrics(self.history(run))
