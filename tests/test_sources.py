"""File sources, sinks and seeded readings."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from arterial import schemas
from arterial.sources import files, sinks, synthetic

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 1, 2)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    for name in ("LD1", "LD12"):
        synthetic.sample_loop_detectors(spark, T0, T1, [name]).write.option("header", True).csv(f"{path}/loop_detector_{name}.csv")
    synthetic.sample_cameras(spark, T0, T1).write.option("header", True).csv(f"{path}/camera_CAM001.csv")
    synthetic.sample_radars(spark, T0, T1).write.option("header", True).csv(f"{path}/radar_RAD001.csv")
    return path


def test_ids_that_start_alike_stay_apart(spark, folder):
    one = files.read_loop_detector(spark, folder, "LD1", T0, T1)
    assert one.select("sensor_id").distinct().count() == 1 and one.count() == 121
    assert files.read_loop_detector(spark, folder, None, T0, T0 + timedelta(minutes=10)).count() == 22
    assert files.read_loop_detector(spark, folder).count() == 0  # nothing in the last hour
    assert one.schema == schemas.LOOP_DETECTOR


def test_all_sensors(spark, folder):
    every = files.read_all_sensors(spark, folder, T0, T1)
    counts = {r["sensor_type"]: r["count"] for r in every.groupBy("sensor_type").count().collect()}
    assert counts == {"loop_detector": 242, "camera": 25, "radar": 241}
    assert {"speed", "sensor_id"} <= set(every.columns) and "average_speed" not in every.columns
    assert files.read_all_sensors(spark, folder, T0, T1, ["radar"]).count() == 241


def test_missing_files_are_an_error(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_radar(spark, folder, "NONE", T0, T1)


def test_seeded_readings(spark):
    make = lambda seed: synthetic.sample_loop_detectors(spark, T0, T0 + timedelta(days=3), ["a", "b"], seed)
    assert make(1).exceptAll(make(1)).isEmpty() and not make(1).exceptAll(make(2)).isEmpty()
    row = make(1).agg(F.avg("vehicle_count"), F.min("average_speed"), F.max("average_speed"), F.max("occupancy"), F.countDistinct("lane")).first()
    assert abs(row[0] - 10) < 0.3 and row[1] >= 0 and row[2] <= 100 and row[3] <= 100 and row[4] == 4
    radar = synthetic.sample_radars(spark, T0, T0 + timedelta(days=3)).groupBy("vehicle_type").count().collect()
    share = {r["vehicle_type"]: r["count"] / 8641 for r in radar}
    assert abs(share["car"] - 0.8) < 0.03 and abs(share["motorcycle"] - 0.05) < 0.02


def test_travel_files_by_name(spark, tmp_path):
    for i, name in enumerate(["nyc_20240101_x.csv", "nyc_20240102_x.csv", "nyc_20240103_x.csv", "la_20250101.csv"]):
        (tmp_path / name).write_text(f"datetime,travel_time,distance,speed\n2024-01-0{i + 1} 00:00:00,{i},1,x\n")
    rows = files.read_travel_times(spark, str(tmp_path), "nyc", days=2).collect()
    assert sorted(r["travel_time"] for r in rows) == ["1", "2"]


def test_gpx(spark, tmp_path):
    (tmp_path / "a.gpx").write_text(
        '<gpx xmlns="http://www.topografix.com/GPX/1/1"><trk><trkseg>'
        '<trkpt lat="40.5" lon="-74.25"><ele>12.5</ele><time>2024-01-01T00:00:00Z</time></trkpt>'
        '<trkpt lat="40.6" lon="-74.5"></trkpt></trkseg></trk></gpx>'
    )
    first, second = files.read_gpx(spark, str(tmp_path)).orderBy("latitude").collect()
    assert tuple(first) == (T0, 40.5, -74.25, 12.5)
    assert second["elevation"] is None and second["timestamp"] is not None


def test_trajectory_aliases(spark, tmp_path):
    (tmp_path / "t.csv").write_text("time,lat,lng,note\n2024-01-01 00:00:00,40.5,bad,x\n")
    row = files.read_trajectory(spark, str(tmp_path)).first()
    assert (row["timestamp"], row["latitude"], row["longitude"]) == (T0, 40.5, None)


def test_landed_feeds(spark, tmp_path):
    rows = spark.createDataFrame([(f"2024-01-0{d} 12:00:00", str(d), "40.7") for d in range(1, 6)], "created_date STRING, speed STRING, latitude STRING")
    for fmt in ("json", "csv"):
        path = str(tmp_path / fmt)
        (rows.write.option("header", True) if fmt == "csv" else rows.write).format(fmt).save(path)
        assert files.read_city_sensors(spark, path, fmt, limit=3, schema=rows.schema).count() == 3
        recent = files.read_incidents(spark, path, fmt, hours=48, now=datetime(2024, 1, 5, 12), schema=rows.schema)
        assert recent.count() == 3
    path = str(tmp_path / "landing")
    stamped = rows.select(F.to_timestamp("created_date").alias("timestamp"), "speed")
    sinks.write_landed(stamped, path, "nyc")
    sinks.write_landed(stamped, path, "la")
    read = files.read_travel_time_range(spark, path, "nyc", date(2024, 1, 2), date(2024, 1, 3))
    assert read.count() == 2
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan


def test_latest_data(spark):
    old = spark.createDataFrame([("2024-01-01 00:00:00", "1")], "datetime STRING, travel_time STRING")
    new = spark.createDataFrame([("2024-01-09 00:00:00", "2")], "datetime STRING, travel_time STRING")
    pick = lambda now, feed: files.latest_data(old, feed, now=now).first()["travel_time"]
    assert pick(datetime(2024, 1, 1, 23), new) == 1.0
    assert pick(datetime(2024, 1, 9), new) == 2.0
    assert pick(datetime(2024, 1, 9), None) == 1.0 and pick(datetime(2024, 1, 9), new.limit(0)) == 1.0
    assert files.is_stale(old.limit(0), "datetime") and files.is_stale(old, "timestamp")


def test_batch_sink_overwrites(spark, tmp_path):
    path = str(tmp_path / "batch")
    rows = spark.createDataFrame([(T0, 1), (T0 + timedelta(days=1), 2)], "timestamp TIMESTAMP, x INT")
    for _ in range(2):
        sinks.write_batch(rows, path)
    assert spark.read.parquet(path).count() == 2


def test_batch_features_of_a_pandas_frame(spark):
    import pandas as pd

    row = sinks.write_batch(pd.DataFrame({"timestamp": ["2024-01-07 18:00:00"], "x": [1]}), None).first()
    assert (row["hour"], row["day_of_week_sun1"], row["is_weekend"]) == (18, 1, 1)


def test_tables_without_time_get_one(spark):
    from arterial.operators.clean import ensure_timestamp

    row = ensure_timestamp(spark.range(1)).select((F.current_timestamp() - F.col("timestamp")).cast("long").alias("age")).first()
    assert 0 <= row["age"] < 600
