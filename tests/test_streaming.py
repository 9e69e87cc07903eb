"""Streams against the batch plans, late rows, restarts and sinks; no sockets, no broker."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from arterial.operators.windows import window_aggregate
from arterial.streaming import queries, sinks, sources
from compare import difference, spark_rows

T0 = datetime(2024, 1, 1)
NOW = {"availableNow": True}
KEYS = ["window_start", "window_end", "location_id"]
SCHEMA = "sensor_id STRING, timestamp TIMESTAMP, speed DOUBLE, vehicle_count INT, occupancy DOUBLE"


def same(left, right):
    right = right.select(*left.columns)
    message = difference(spark_rows(left), spark_rows(right))
    assert message is None, message


def rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("avg_speed", "avg_occupancy")})


@pytest.fixture()
def folder(spark, readings, tmp_path):
    """Readings as three files in time order."""
    path = str(tmp_path / "in")
    slim = readings.select("sensor_id", "timestamp", "speed", "vehicle_count", "occupancy")
    for low, high in ((0, 10), (10, 20), (20, 40)):
        slim.filter(F.dayofmonth("timestamp").between(low + 1, high)).coalesce(1).write.mode("append").parquet(path)
    return path


def stream_of(spark, path, **options):
    return sources.create_source(spark, "file", {"format": "parquet", "schema": SCHEMA, "path": path, "max_files_per_trigger": 1, **options})


def test_updates_equal_batch_and_survive_restart(spark, folder, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda: sinks.write_updates(queries.process_stream(stream_of(spark, folder)), out, checkpoint, NOW).awaitTermination()
    run()
    batch = window_aggregate(spark.read.schema(SCHEMA).parquet(folder))
    same(rounded(batch), rounded(sinks.read_updates(spark, out, KEYS)))
    before = spark.read.parquet(out).count()
    run()  # nothing new
    assert spark.read.parquet(out).count() == before
    more = spark.createDataFrame([("S1", datetime(2024, 1, 31), 10.0, 1, 1.0)], SCHEMA)
    late = spark.createDataFrame([("S1", datetime(2024, 1, 2), 99.0, 1, 1.0)], SCHEMA)
    more.coalesce(1).write.mode("append").parquet(folder)
    run()
    late.coalesce(1).write.mode("append").parquet(folder)
    run()  # far behind the watermark: dropped
    result = sinks.read_updates(spark, out, KEYS)
    assert result.filter("window_start >= '2024-01-30 23:55:00'").count() >= 5
    assert result.filter("avg_speed = 99").isEmpty()


def test_append_to_parquet_holds_open_windows_back(spark, folder, tmp_path):
    path = str(tmp_path / "out")
    stream = queries.process_stream(stream_of(spark, folder), "1 hour", None)
    sinks.write_sink(stream, "parquet", {"path": path}, str(tmp_path / "cp"), NOW).awaitTermination()
    batch = window_aggregate(spark.read.schema(SCHEMA).parquet(folder), "1 hour", None)
    done = batch.filter(F.col("window_end") <= F.lit(spark.read.parquet(folder).agg(F.max("timestamp")).first()[0]) - F.expr("interval 10 minutes"))
    same(rounded(done), rounded(spark.read.parquet(path)))


def test_memory_and_console_sinks(spark, folder):
    stream = queries.process_stream(stream_of(spark, folder), "1 hour", None)
    sinks.write_sink(stream, "memory", {"table_name": "windows"}, trigger=NOW).awaitTermination()
    assert spark.table("windows").count() > 0
    sinks.write_sink(stream, "console", trigger=NOW).awaitTermination()
    with pytest.raises(ValueError):
        sinks.write_sink(stream, "carrier pigeon")


def test_a_memory_table_is_not_held_by_the_driver(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "id BIGINT, speed DOUBLE"
    for part in range(2):
        spark.createDataFrame([(part, 1.5), (10 + part, None)], schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)  # the second start goes on where the first ended
        sinks.write_sink(stream, "memory", {"table_name": "held", "mode": "append"}, str(tmp_path / "cp"), NOW).awaitTermination()
    assert sorted(r["id"] for r in spark.table("held").collect()) == [0, 1, 10, 11]
    assert spark.table("held").columns == ["id", "speed"] and spark.table("held").inputFiles()
    counts = spark.readStream.schema(schema).parquet(source).groupBy("speed").count()
    sinks.write_sink(counts, "memory", {"table_name": "whole", "mode": "complete"}, trigger=NOW).awaitTermination()
    assert {tuple(r) for r in spark.table("whole").collect()} == {(1.5, 2), (None, 2)}


def test_csv_and_unknown_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sensor_id,timestamp,latitude,longitude,speed,vehicle_count,occupancy,flow_rate\nS1,2024-01-01 00:00:00,40,-74,12.5,3,1,2\n")
    stream = sources.create_source(spark, "file", {"path": str(tmp_path)})
    assert stream.isStreaming and "flow_rate" in stream.columns
    sinks.write_sink(stream, "memory", {"table_name": "csv_rows", "mode": "append"}, trigger=NOW).awaitTermination()
    assert spark.table("csv_rows").first()["speed"] == 12.5
    for kind, options in (("pigeon", None), ("file", {"format": "orc"})):
        with pytest.raises(ValueError):
            sources.create_source(spark, kind, options)


def test_reader_defaults(spark):
    """Kafka and socket readers are configured but not started."""
    assert sources.stream_reader(spark, "kafka") is not None
    assert sources.stream_reader(spark, "socket", {"port": 1}) is not None
    assert sources.KAFKA == {"bootstrap_servers": "localhost:9092", "topic": "traffic_data"}


def test_kafka_records(spark):
    row = sinks.kafka_records(spark.createDataFrame([("L1", 2.5)], "location_id STRING, avg_speed DOUBLE")).first()
    assert tuple(row) == ("L1", '{"location_id":"L1","avg_speed":2.5}')


def test_alert_feed_equals_batch(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    sinks.write_updates(queries.alert_feed(stream_of(spark, folder), "1 hour", None), out, str(tmp_path / "cp"), NOW).awaitTermination()
    batch = queries.alert_feed(spark.read.schema(SCHEMA).parquet(folder), "1 hour", None)
    assert batch.count() > 0
    same(batch, sinks.read_updates(spark, out, ["location_id", "window_end"]))


def test_live_stops_do_not_depend_on_arrival(spark, tmp_path):
    rng = random.Random(2)
    rows = [(v, T0 + timedelta(minutes=3 * i, seconds=rng.randrange(60)), 2.0 if (i // 4) % 2 else 40.0) for v in ("a", "b") for i in range(40)]
    rows.append(("c", T0 + timedelta(hours=30), 50.0))  # moves the watermark past everything
    schema = "vehicle_id STRING, timestamp TIMESTAMP, speed_kmh DOUBLE"
    results = []
    for order in ("time", "shuffled"):
        source = str(tmp_path / order)
        body, last = list(rows[:-1]), rows[-1:]
        if order == "shuffled":
            rng.shuffle(body)
            parts = [body, last]
        else:
            body.sort(key=lambda r: r[1])
            parts = [body[:30], body[30:], last]
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = sources.create_source(spark, "file", {"format": "parquet", "schema": schema, "path": source, "max_files_per_trigger": 1})
        out = str(tmp_path / (order + "-out"))
        sinks.write_sink(queries.live_stops(stream), "parquet", {"path": out}, str(tmp_path / (order + "-cp")), NOW).awaitTermination()
        results.append(spark.read.parquet(out))
    assert results[0].count() == 10 and results[0].filter("fixes = 4").count() == 10
    same(*results)


def test_slow_runs():
    run = lambda open_run, us, slow: queries.slow_runs(open_run, np.array(us), np.array(slow), 10)
    assert run(None, [0, 5, 9, 30, 31], [True, True, False, True, True]) == ([(0, 5, 2)], (30, 31, 2))
    assert run((0, 5, 2), [12, 13], [True, False]) == ([(0, 12, 3)], None)
    assert run((0, 5, 2), [40], [True]) == ([(0, 5, 2)], (40, 40, 1))
    assert run((0, 5, 2), [], []) == ([], (0, 5, 2))


def test_vehicles_share_the_state_of_their_group(spark, tmp_path):
    """300 vehicles, some fixes without a vehicle: calls to the state grow with the groups, not with vehicles or fixes."""
    names = [f"v{i}" for i in range(300)] + [None]
    rows = [(v, T0 + timedelta(minutes=i), 2.0 if i in (1, 2, 3, 6) else 40.0) for v in names for i in range(9)]
    random.Random(5).shuffle(rows)
    schema, source, out = "vehicle_id STRING, timestamp TIMESTAMP, speed_kmh DOUBLE", str(tmp_path / "in"), str(tmp_path / "out")
    for part in (rows[:900], rows[900:], [("late", T0 + timedelta(hours=9), 40.0)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = sinks.write_sink(queries.live_stops(stream, groups=8), "parquet", {"path": out}, str(tmp_path / "cp"), NOW)
    query.awaitTermination()
    timers = [int(p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"]) for p in query.recentProgress]
    assert 0 < max(timers) <= 8
    stops = spark.read.parquet(out)
    found = stops.groupBy("vehicle_id").agg(F.sort_array(F.collect_list("fixes")).alias("fixes")).collect()
    assert {r["vehicle_id"]: r["fixes"] for r in found} == {v: [1, 3] for v in names}


def test_waiting_fixes_come_back_from_several_rows():
    class Memory(list):
        get, appendList = list.copy, list.extend

        def put(self, rows):
            self[:] = rows

    class Handle:
        def __init__(self):
            self.state, self.timers = Memory(), set()
            self.deleteTimer, self.registerTimer, self.listTimers = self.timers.remove, self.timers.add, lambda: list(self.timers)

        def getListState(self, *_):
            return self.state

    handle, stops = Handle(), queries.StopProcessor(5.0, 60.0, 100.0)
    stops.CHUNK, stops.ROWS_PER_CALL = 3, 2
    stops.init(handle)
    minute = np.arange(10) * 60_000_000
    news = {v: (minute[::-1].copy(), (minute >= 60_000_000 * k)[::-1].copy()) for k, v in ((2, "a"), (4, "b"))}
    assert not list(stops._advance(news, 0)) and len(handle.state) == 6 and handle.timers == {60_000}
    assert not list(stops._advance({}, 300_000)) and handle.timers == {360_000}
    done = list(stops._advance({}, 10_000_000))[0]
    assert done[["vehicle_id", "fixes", "stop_duration"]].values.tolist() == [["a", 8, 420.0], ["b", 6, 300.0]]
    assert not handle.state and not handle.timers
