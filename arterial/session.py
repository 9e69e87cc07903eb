"""Session set-up and the shared folder for checkpoints and intermediate tables (STM-10)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# SQL settings every operator relies on; all can be changed on a running session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # withWatermark accepts TIMESTAMP only, so parquet timestamps must not be read as NTZ
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Can only be set when a session starts. Call sites are recorded for every column expression otherwise,
# which slows the building of wide plans.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(
    app_name: str = "arterial", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Get or create a session. Whoever created it stops it; operators never do."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**START_SETTINGS, **SQL_SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster it would not be visible
    to the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    root = tempfile.mkdtemp(prefix="arterial-checkpoint-")
    spark.sparkContext.setCheckpointDir(root)
    return root


# Paths this process has handed out and not yet released.
_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; :func:`release` deletes what was written there."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete all pinned tables and scratch folders of this process but the first ``keep``.

    Call it when the results that read them have been written or collected.
    """
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while len(_made) > keep:
        path = files.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Release at the end what operators pin inside the block."""
    before = len(_made)
    try:
        yield
    finally:
        release(spark, before)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and fixes its rows.

    A parquet table rather than a checkpointed RDD, so that later steps read only the columns they
    need and Spark knows its true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "pinned")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
