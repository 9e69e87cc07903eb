"""File sources: sensors, travel times, trajectories and landed feeds (SRC-5 to SRC-16)."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from datetime import date, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arterial import schemas
from arterial.operators.clean import (
    canonical_names, clean_trajectory, clean_travel_times, moment, parsed_timestamp, rename_aliases, to_numbers,
)
from arterial.session import pin

# File name prefix, schema and id column of each device type.
SENSOR_FILES = {
    "loop_detector": (schemas.LOOP_DETECTOR, "sensor_id"),
    "camera": (schemas.CAMERA, "camera_id"),
    "radar": (schemas.RADAR, "radar_id"),
}


def time_range(
    df: DataFrame, start: datetime | Column | None, end: datetime | Column | None, ts: str = "timestamp"
) -> DataFrame:
    """FLT-1: rows with start <= ts <= end; a missing bound is open."""
    if start is not None:
        df = df.filter(F.col(ts) >= moment(start))
    if end is not None:
        df = df.filter(F.col(ts) <= moment(end))
    return df


def recent(df: DataFrame, hours: float, ts: str = "created_date", now: datetime | None = None) -> DataFrame:
    """FLT-2: rows no older than ``hours``."""
    return df.filter(F.col(ts) >= moment(now) - F.expr(f"interval {int(hours * 3600)} seconds"))


# Files whose heads may be broadcast: a path and a number each, some tens of MB.
BROADCAST_FILES = 100_000


HEAD_BYTES = 64 << 10  # read at once when looking for the end of a first line


def _first_line(uri: str) -> str | None:
    """The first line with text of a file; None if its store cannot be opened from here."""
    try:
        system, path = fs.FileSystem.from_uri(uri)
        with system.open_input_stream(path) as stream:
            read = b""
            while chunk := stream.read(HEAD_BYTES):
                read += chunk
                whole = read[: read.rfind(b"\n") + 1] if len(chunk) == HEAD_BYTES else read
                for line in whole.splitlines():
                    if line.strip(b"\xef\xbb\xbf \t\r"):
                        return line.decode("utf-8", "replace")
            return next((x.decode("utf-8", "replace") for x in read.splitlines() if x.strip()), "")
    except (pa.ArrowException, OSError):
        return None


def file_heads(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(file, head)``: the first line with text of every file that has one.

    Spark lists the files, tasks open them and read no more than that line. Files in a store that only Spark's readers can
    open are scanned for it instead. The names stay a table.
    """
    listing = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [_first_line(uri) for uri in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(heads, pa.string())], names=["file", "head"])

    heads = pin(listing.mapInArrow(run, "file string, head string"))
    unread = heads.where("head is null").select("file")
    if not unread.isEmpty():
        lines = spark.read.text(paths).select(
            F.col("_metadata.file_path").alias("file"), "value", F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        # the first line of a file has the lowest row id of its first block
        scanned = lines.where("block = 0 and trim(value) <> ''").join(unread, "file", "left_semi").groupBy("file").agg(F.min_by("value", "row").alias("head"))
        heads = heads.where("head is not null").unionByName(pin(scanned))
    return heads.where("head <> ''")


def read_by_name(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV files with a header each, read by column name whatever the order.

    Columns of ``schema`` that a file lacks are null, as are values that do not fit their type; all other columns are
    kept as text, as are partition columns of the folders. The rows are one scan. Where headers differ, a row learns its
    file's header from the table of :func:`file_heads`; only the distinct headers reach the driver.
    """
    heads = file_heads(spark, paths)
    lines = sorted(r["head"] for r in heads.select("head").distinct().collect())
    if not lines:
        return spark.createDataFrame([], schema)
    parsed = [[name.strip() for name in next(csv.reader([line.lstrip("\ufeff")]))] for line in lines]
    distinct = sorted({tuple(head) for head in parsed})
    fields = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(max(map(len, distinct)))])
    raw = spark.read.schema(fields).option("header", True).csv(paths)
    folders = [c for c in raw.columns if c not in fields.names]
    if len(distinct) > 1:
        # files of one header are many, headers are few
        kinds = spark.createDataFrame([(line, distinct.index(tuple(head))) for line, head in zip(lines, parsed)], "head string, _head int")
        of_file = heads.join(F.broadcast(kinds), "head").select(F.col("file").alias("_file"), "_head")
        if heads.count() <= BROADCAST_FILES:
            of_file = F.broadcast(of_file)
        raw = raw.withColumn("_file", F.col("_metadata.file_path")).join(of_file, "_file")
    names = dict.fromkeys(name for head in distinct for name in head if name)

    def value(name: str) -> Column | None:
        """The column of that name, by the header of the row's file; of several in one header the first."""
        places = {k: F.col(f"_c{head.index(name)}") for k, head in enumerate(distinct) if name in head}
        if len(distinct) == 1:
            return places.get(0)
        chosen = F.lit(None).cast("string")
        for place in {str(p): p for p in places.values()}.values():
            chosen = F.when(F.col("_head").isin([k for k, p in places.items() if str(p) == str(place)]), place).otherwise(chosen)
        return chosen

    known = [_typed(value(f.name) if f.name in names else None, f).alias(f.name) for f in schema]
    others = [value(name).alias(name) for name in names if name not in schema.names and name not in folders]
    return raw.select(*known, *others, *[c for c in folders if c not in schema.names])


def _typed(column: Column | None, field: T.StructField) -> Column:
    if column is None:
        return F.lit(None).cast(field.dataType)
    if isinstance(field.dataType, T.TimestampType):
        return F.try_to_timestamp(column)
    return column.try_cast(field.dataType)


def read_sensor_files(
    spark: SparkSession,
    path: str,
    sensor_type: str,
    sensor_id: str | None = None,
    start_time: datetime | None = None,
    end_time: datetime | None = None,
) -> DataFrame:
    """CSV files (or folders of part files) ``<sensor_type>[_<id>]*.csv`` in ``path``, by default of
    the last hour.

    The name only narrows the listing; the id column decides.
    """
    schema, id_column = SENSOR_FILES[sensor_type]
    pattern = f"{sensor_type}_{sensor_id}*.csv" if sensor_id else f"{sensor_type}*.csv"
    df = read_by_name(spark, f"{path}/{pattern}", schema)
    last_hour = moment(None) - F.expr("interval 1 hour")
    df = time_range(df, last_hour if start_time is None else start_time, moment(end_time))
    return df.filter(F.col(id_column) == sensor_id) if sensor_id else df


def read_loop_detector(spark, path, sensor_id=None, start_time=None, end_time=None) -> DataFrame:
    """SRC-5."""
    return read_sensor_files(spark, path, "loop_detector", sensor_id, start_time, end_time)


def read_camera(spark, path, camera_id=None, start_time=None, end_time=None) -> DataFrame:
    """SRC-6."""
    return read_sensor_files(spark, path, "camera", camera_id, start_time, end_time)


def read_radar(spark, path, radar_id=None, start_time=None, end_time=None) -> DataFrame:
    """SRC-7."""
    return read_sensor_files(spark, path, "radar", radar_id, start_time, end_time)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-1: rows of all tables; columns a table lacks are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_all_sensors(
    spark: SparkSession,
    path: str,
    start_time: datetime | None = None,
    end_time: datetime | None = None,
    sensor_types: Sequence[str] = tuple(SENSOR_FILES),
) -> DataFrame:
    """SRC-8: every enabled type in one table with canonical names and ``sensor_type``."""
    return union_all(
        [
            canonical_names(read_sensor_files(spark, path, t, None, start_time, end_time)).withColumn("sensor_type", F.lit(t))
            for t in sensor_types
        ]
    )


def read_travel_times(
    spark: SparkSession, path: str, city: str, days: int | None = None, schema: T.StructType = schemas.TRAVEL_TIME_RAW
) -> DataFrame:
    """SRC-9/TOP-3: the exports ``<city>_*.csv``, or the last ``days`` of them by name.

    The name list has one entry per file and is found before the rows are read.
    """
    if days is None:
        return read_by_name(spark, f"{path}/{city}_*.csv", schema)
    listing = spark.read.format("binaryFile").load(f"{path}/{city}_*.csv").select("path")
    export = F.regexp_extract("path", f"/({city}_[^/]*[.]csv)(/[^/]*)?$", 1).alias("name")
    last = listing.select(export).distinct().orderBy(F.col("name").desc()).limit(days)
    names = [f"{path}/{row['name']}" for row in last.collect()]
    return read_by_name(spark, names, schema)


def read_gpx(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: track points of GPX files; points without a time get the current time."""
    raw = spark.read.format("xml").option("rowTag", "trkpt").schema(schemas.GPX_POINT).load(path)
    stamp = F.coalesce(F.try_to_timestamp("time"), F.when(F.col("time").isNull(), F.current_timestamp()))
    return raw.select(
        stamp.alias("timestamp"), F.col("_lat").alias("latitude"), F.col("_lon").alias("longitude"),
        F.col("ele").alias("elevation"),
    )


def read_trajectory(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: trajectory CSV with any of the accepted column names, by name in every file."""
    return clean_trajectory(read_by_name(spark, path, T.StructType()))


def read_landed(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | str | None = None) -> DataFrame:
    """Records a fetcher left as json, csv or parquet; give a schema to save the inference pass.

    Fields are found by name in every format. CSV files without a schema give text.
    """
    if fmt == "csv":
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema or T.StructType()
        found = read_by_name(spark, path, wanted)
        folders = [c for c in spark.read.schema("_c0 string").csv(path).columns if c != "_c0"] if schema is not None else []
        return found.select(*wanted.names, *[c for c in folders if c not in wanted.names]) if schema is not None else found
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_city_sensors(spark, path, fmt="json", limit: int | None = None, schema=schemas.CITY_SENSOR_RAW) -> DataFrame:
    """SRC-12/TOP-2: landed city sensor records, all of them unless a ``limit`` is asked for."""
    df = read_landed(spark, path, fmt, schema)
    return df if limit is None else df.limit(limit)


def read_incidents(
    spark, path, fmt="json", hours: float = 24, now: datetime | None = None, schema=None
) -> DataFrame:
    """SRC-13: landed incidents of the last ``hours``."""
    df = read_landed(spark, path, fmt, schema)
    return recent(df.withColumn("created_date", parsed_timestamp(df, "created_date")), hours, "created_date", now)


def read_road_network(spark, path, fmt="json", limit: int | None = None, schema=None) -> tuple[DataFrame, DataFrame]:
    """SRC-14: ``nodes`` and ``edges`` of landed segment records.

    A record is a segment: from_id, from_lat, from_lon, to_id, to_lat, to_lon, weight.
    """
    records = read_landed(spark, path, fmt, schema)
    records = records if limit is None else records.limit(limit)
    # a missing or unreadable weight stays null here: a segment of unknown length is no way (shortest_paths)
    records = to_numbers(records, ["from_lat", "from_lon", "to_lat", "to_lon", "weight"])
    ends = [
        records.select(F.col(e + "_id").alias("id"), F.col(e + "_lat").alias("latitude"), F.col(e + "_lon").alias("longitude"))
        for e in ("from", "to")
    ]
    place = F.min(F.struct("latitude", "longitude")).alias("p")
    nodes = ends[0].unionByName(ends[1]).groupBy("id").agg(place).select("id", "p.latitude", "p.longitude")
    edges = records.select(F.col("from_id").alias("src"), F.col("to_id").alias("dst"), "weight")
    return nodes, edges


def read_travel_time_range(spark, path: str, city: str, start: date, end: date, fmt: str = "parquet", schema=None) -> DataFrame:
    """SRC-15: landed records of a city and date range; only those partitions are listed."""
    df = read_landed(spark, path, fmt, schema)
    return df.filter((F.col("city") == city) & F.col("date").between(F.lit(start), F.lit(end)))


def is_stale(df: DataFrame, ts: str = "timestamp", max_age_hours: float = 24, now: datetime | None = None) -> bool:
    """SRC-16: no rows, no time column, or nothing newer than ``max_age_hours``."""
    if ts not in df.columns:
        return True
    age = (F.unix_micros(moment(now)) - F.max(F.unix_micros(parsed_timestamp(df, ts)))) / 3.6e9
    row = df.agg(age.alias("age")).first()
    return row["age"] is None or row["age"] > max_age_hours


def latest_data(
    local: DataFrame, landed: DataFrame | None, max_age_hours: float = 24, now: datetime | None = None
) -> DataFrame:
    """SRC-16: the local table while it is fresh, else the landed one if it has rows; cleaned."""
    stamped = rename_for_age(local)
    if is_stale(stamped, "timestamp", max_age_hours, now) and landed is not None and not landed.isEmpty():
        return clean_travel_times(landed)
    return clean_travel_times(local)


def rename_for_age(df: DataFrame) -> DataFrame:
    return df if "timestamp" in df.columns else rename_aliases(df)

