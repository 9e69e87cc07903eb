"""Streaming sinks (SNK-1 to SNK-5) and update tables."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from arterial.operators.quality import quarantine
from arterial.session import checkpoint_root

# Defaults of each sink.
KAFKA = {"bootstrap_servers": "localhost:9092", "topic": "processed_traffic"}
PARQUET_PATH = "data/processed/streaming"
TABLE_NAME = "traffic_stream"


def kafka_records(df: DataFrame, key: str = "location_id") -> DataFrame:
    """SNK-2/JSON-1: ``key`` and the row as JSON ``value``, times with all their digits."""
    value = F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def stable_checkpoint(spark: SparkSession, kind: str, target: str) -> str:
    """The checkpoint folder of a sink below the shared root: the same for every start, so a restart goes on where the
    last run ended and no batch number is used twice."""
    name = re.sub("[^A-Za-z0-9._-]+", "_", target).strip("_")[-80:]
    code = hashlib.sha256(target.encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark).rstrip('/')}/streams/{kind}-{name}-{code}"


def _triggered(writer: DataStreamWriter, trigger: dict | None) -> DataStreamWriter:
    """STM-7: ``{"processingTime": "10 seconds"}`` or ``{"availableNow": True}``."""
    return writer.trigger(**trigger) if trigger else writer


def write_sink(
    df: DataFrame,
    kind: str = "console",
    options: dict | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query into a console, kafka, parquet or memory sink.

    Files can only be appended to; the other sinks get updated rows. Each sink has a checkpoint folder of its own
    (SNK-5), by default one derived from its path, topic or table, which a restart finds again. The console keeps
    nothing and a memory table ends with its session, so theirs are derived from the session too. The rows of a memory
    table lie beside its checkpoint and not in the driver, which could not hold them (:func:`_session_table`).
    """
    options = options or {}
    if kind not in ("console", "kafka", "parquet", "memory"):
        raise ValueError(f"unsupported sink type {kind!r}")
    if checkpoint is None:
        target = {
            "parquet": options.get("path", PARQUET_PATH),
            "kafka": f"{options.get('bootstrap_servers', KAFKA['bootstrap_servers'])}/{options.get('topic', KAFKA['topic'])}",
            "memory": f"{df.sparkSession.sparkContext.applicationId}/{options.get('table_name', TABLE_NAME)}",
            "console": f"{df.sparkSession.sparkContext.applicationId}/{options.get('name', uuid.uuid4().hex)}",
        }[kind]
        checkpoint = stable_checkpoint(df.sparkSession, kind, target)
    if kind == "kafka":
        df = kafka_records(df, options.get("key", "location_id"))
    mode = options.get("mode", "append" if kind == "parquet" else "update")
    if kind == "memory":
        return _session_table(df, options.get("table_name", TABLE_NAME), checkpoint, mode, trigger)
    writer = df.writeStream.outputMode(mode).format(kind).option("checkpointLocation", checkpoint)
    if kind == "kafka":
        writer = writer.option("kafka.bootstrap.servers", options.get("bootstrap_servers", KAFKA["bootstrap_servers"]))
        writer = writer.option("topic", options.get("topic", KAFKA["topic"]))
    elif kind == "parquet":
        writer = writer.option("path", options.get("path", PARQUET_PATH))
    return _triggered(writer, trigger).start()


def _session_table(df: DataFrame, name: str, checkpoint: str, mode: str, trigger: dict | None) -> StreamingQuery:
    """SNK-4: the rows of each batch as files beside the checkpoint, and a view of the session over them.

    The view is renewed after each batch; a repeated batch overwrites its own files. In complete mode it shows the last
    batch only.
    """
    spark, rows = df.sparkSession, f"{checkpoint.rstrip('/')}-rows"

    def show(folder: str) -> None:
        files = spark.read.schema(df.schema).option("recursiveFileLookup", "true")
        files.parquet(folder).createOrReplaceTempView(name)

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{rows}/{number}")
        show(f"{rows}/{number}" if mode == "complete" else rows)

    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{rows}/start")
    show(f"{rows}/start" if mode == "complete" else rows)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).queryName(name).foreachBatch(save)
    return _triggered(writer, trigger).start()


def write_updates(
    df: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None, mode: str = "update",
    keys: Sequence[str] = (), compact_every: int | None = None,
) -> StreamingQuery:
    """Update semantics on parquet: every micro-batch overwrites its own folder, so a repeated batch
    does no harm; :func:`read_updates` keeps the last version of each row.

    With ``compact_every``, every so many batches are merged into the base by their ``keys`` (:func:`compact_updates`).
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if compact_every and number and number % compact_every == 0:
            compact_updates(batch.sparkSession, path, keys)

    checkpoint = checkpoint or stable_checkpoint(df.sparkSession, "updates", path)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    return _triggered(writer, trigger).start()


class UpdateTable:
    """The folders of an update table: ``batch=N`` for each batch, ``_base/version=V`` with all batches up to some number
    merged, and ``_manifest/V`` which says up to which.

    A version counts once its manifest is there, and a manifest appears whole, by a rename. Readers take the newest
    manifest, its base, and the batches after it. What the manifest before needs is kept until the next version, so readers
    that started with it are not disturbed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.files = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._fs.Path(f"{self.path}/{name}" if name else self.path)

    def _numbers(self, folder: str, prefix: str = "") -> list[int]:
        at = self._at(folder)
        names = [s.getPath().getName() for s in self.files.listStatus(at)] if self.files.exists(at) else []
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit())

    def manifest(self) -> tuple[int, int]:
        """(version, last batch in its base) of the newest version; (0, -1) without one."""
        versions = self._numbers("_manifest")
        if not versions:
            return 0, -1
        with_text = self.files.open(self._at(f"_manifest/{versions[-1]}"))
        try:
            return versions[-1], int(with_text.readUTF())
        finally:
            with_text.close()

    def batches(self, after: int) -> list[int]:
        return [n for n in self._numbers("", "batch=") if n > after]

    def rows(self, version: int, batches: list[int]) -> DataFrame:
        """Base rows and batch rows, each with the ``batch`` it is from."""
        parts = []
        if batches:
            names = [f"{self.path}/batch={n}" for n in batches]
            parts.append(self.spark.read.option("basePath", self.path).parquet(*names).withColumn("batch", F.col("batch").cast("long")))
        if version:
            parts.append(self.spark.read.parquet(f"{self.path}/_base/version={version}"))
        if not parts:
            return self.spark.read.parquet(self.path).withColumn("batch", F.col("batch").cast("long"))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)

    def publish(self, version: int, through: int) -> None:
        waiting = self._at(f"_manifest/.{version}-{uuid.uuid4().hex}")
        out = self.files.create(waiting, True)
        out.writeUTF(str(through))
        out.close()
        if not self.files.rename(waiting, self._at(f"_manifest/{version}")):
            self.files.delete(waiting, False)
            raise RuntimeError(f"version {version} of {self.path} was published by somebody else")

    def drop(self, version: int, through: int) -> None:
        """Delete what only versions before ``version`` read: their bases, and batches up to ``through``."""
        for old in self._numbers("_base", "version="):
            if old < version:
                self.files.delete(self._at(f"_base/version={old}"), True)
        for number in self._numbers("", "batch="):
            if number <= through:
                self.files.delete(self._at(f"batch={number}"), True)


def compact_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> int:
    """Merge the batches of an update table into a new version of its base; returns that version.

    The last batch stays out, as a stream that is restarted may write it once more. Streams may write and readers read
    meanwhile; run one compaction at a time.
    """
    table = UpdateTable(spark, path)
    version, through = table.manifest()
    batches = table.batches(through)[:-1]
    if not batches:
        return version
    latest = _latest(table.rows(version, batches), keys)
    latest.write.mode("overwrite").parquet(f"{table.path}/_base/version={version + 1}")
    table.publish(version + 1, batches[-1])
    table.drop(version, through)
    return version + 1


def _latest(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in versions.columns if c not in keys and c != "batch"]
    latest = versions.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"), F.max("batch").alias("batch"))
    return latest.select(*keys, "_v.*", "batch")


def read_updates(spark, path: str, keys: Sequence[str]) -> DataFrame:
    """The latest version of each row that :func:`write_updates` wrote: the base and the batches since."""
    table = UpdateTable(spark, path)
    version, through = table.manifest()
    versions = table.rows(version, table.batches(through))
    values = [c for c in versions.columns if c not in keys and c != "batch"]
    latest = versions.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return latest.select(*keys, "_v.*")


def write_validated(
    df: DataFrame, good: str, bad: str, checkpoint: str | None = None, trigger: dict | None = None, **rules
) -> StreamingQuery:
    """VAL-4 on a stream: one query that appends valid rows to ``good`` and the others, with their ``errors``, to ``bad``.

    Both folders get a part per batch number, so a batch that is repeated after a failure overwrites what it wrote, in one
    folder or in both. ``rules`` are those of :func:`arterial.operators.quality.quarantine`.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            valid, others = quarantine(batch, **rules)
            valid.write.mode("overwrite").parquet(f"{good}/batch={number}")
            others.write.mode("overwrite").parquet(f"{bad}/batch={number}")
        finally:
            batch.unpersist()

    checkpoint = checkpoint or stable_checkpoint(df.sparkSession, "validated", f"{good} {bad}")
    return _triggered(df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save), trigger).start()
