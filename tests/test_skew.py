"""Hot keys: split, chunked and salted plans give the same rows as the plain ones."""

import math
import random

import pytest
from pyspark.sql import functions as F

from arterial.operators import features, joins, quantiles, resample, sequences, trajectory
from arterial.operators.ordering import OrderedRows, hot_keys
from compare import difference, rows_of, spark_rows


def same(left, right, columns=None):
    columns = columns or sorted(left.columns)
    message = difference(spark_rows(left.select(*columns)), spark_rows(right.select(*columns)))
    assert message is None, message


@pytest.fixture(scope="module")
def hot(readings):
    """One sensor holds more than a third of the rows."""
    return readings.withColumn(
        "sensor_id", F.when(F.col("event_id") % 5 < 2, F.lit("HOT")).otherwise(F.col("sensor_id"))
    ).cache()


def test_hot_keys_are_found(hot):
    assert [r["sensor_id"] for r in hot_keys(hot, ["sensor_id"], 200).collect()] == ["HOT"]
    assert hot_keys(hot, ["sensor_id"], 10_000) is None


@pytest.mark.parametrize(("by", "size"), [("sensor_id", 40), (None, 150)])
def test_traffic_features(hot, by, size):
    plain = features.traffic_features(hot, by, tiebreak="event_id", rows_per_task=None)
    split = features.traffic_features(hot, by, tiebreak="event_id", rows_per_task=size)
    columns = ["event_id", "flow_rate", "density", "speed_rolling_mean_10", "occupancy_rolling_std_5", "flow_rate_rolling_mean_10"]
    digits = [F.round(c, 4).alias(c) for c in columns]
    same(plain.select(*digits), split.select(*digits))


# chunks of about ten rows, so that the ten rows a frame looks back span several of them
@pytest.mark.parametrize("size", [20])
def test_lags_longer_than_chunks(hot, size):
    run = lambda n: features.lag_features(hot, ["speed"], (1, 5, 10), tiebreak="event_id", rows_per_task=n)
    same(run(None), run(size), ["event_id", "speed_lag_1", "speed_lag_5", "speed_lag_10"])


@pytest.mark.parametrize(("duration", "align"), [("time", "leg"), ("rows", "reference")])
def test_stops(gps, duration, align):
    hot = gps.withColumn("vehicle_id", F.when(F.col("event_id") % 2 == 0, F.lit("HOT")).otherwise(F.col("vehicle_id")))
    run = lambda n: trajectory.detect_stops(hot, tiebreak="event_id", duration=duration, align=align, rows_per_task=n)
    same(run(None), run(60), ["event_id", "is_stopped", "stop_duration", "is_significant_stop"])


def test_acceleration(gps):
    run = lambda n: trajectory.gps_acceleration(gps, None, tiebreak="event_id", rows_per_task=n)
    same(run(None), run(150), ["event_id", "distance_meters", "speed_kmh", "acceleration"])


def test_sequences_and_blocks(hot):
    run = lambda f, n: f(hot, ["speed"], "speed", 7, tiebreak="event_id", rows_per_task=n)
    plain, split = (run(sequences.with_sequences, n).withColumn("x", F.to_json("x")) for n in (None, 60))
    same(plain, split)
    plain, split = (run(sequences.block_sequences, n).withColumn("x", F.to_json("x")) for n in (None, 60))
    same(plain, split)


def test_split_by_key_and_fill(hot):
    run = lambda n: sequences.split_by_key(hot, tiebreak="event_id", rows_per_task=n)
    same(run(None), run(30), ["event_id", "split"])
    unique = hot.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") * 1000 + F.col("event_id")))
    for method in ("interpolate", "forward_fill", "backward_fill"):
        run = lambda n: resample.fill_gaps(unique, ["occupancy"], method, "sensor_id", rows_per_task=n)
        same(run(None).withColumn("occupancy", F.round("occupancy", 6)), run(30).withColumn("occupancy", F.round("occupancy", 6)), ["event_id", "occupancy"])


@pytest.mark.parametrize("by", ["sensor_id", None])
def test_grid_sizes_are_the_counts_of_the_grid(hot, by):
    keys = [by] if by else []
    some = hot.withColumn("sensor_id", F.when(F.col("sensor_id") != "S1", F.col("sensor_id")))
    hourly = resample.resample(some, "1 hour", by, columns=["speed"])
    points = resample.grid_size(some, "1 hour", by)
    same(hourly.groupBy(*keys).agg(F.count("*").alias("_rows")), points)
    run = lambda n, c=None: resample.fill_gaps(hourly, ["speed"], "interpolate", by, rows_per_task=n, counts=c)
    same(run(None).withColumn("speed", F.round("speed", 6)), run(100, points).withColumn("speed", F.round("speed", 6)))
    empty = some.limit(0)
    assert resample.fill_gaps(resample.resample(empty, by=by, columns=["speed"]), ["speed"], by=by, counts=resample.grid_size(empty, by=by)).isEmpty()


def test_null_keys_are_a_group(hot):
    gone = hot.withColumn("sensor_id", F.when(F.col("sensor_id") != "HOT", F.col("sensor_id")))
    run = lambda n: OrderedRows(gone, "sensor_id", ["timestamp", "event_id"], n).index("i", total="n").result()
    same(run(None), run(30), ["event_id", "i", "n"])


def test_asof_join(hot):
    weather = hot.filter("event_id % 4 = 0").select("event_id", "sensor_id", "timestamp", F.col("speed").alias("wind"))
    for by in ("sensor_id", None):
        left = hot.select("event_id", "sensor_id", "timestamp")
        run = lambda n: joins.asof_join(left, weather if by else weather.drop("sensor_id"), by, tiebreak="event_id", rows_per_task=n)
        same(run(None), run(40), ["event_id", "wind", "timestamp_right"])


def test_lookup_join(hot):
    sensors = hot.groupBy("sensor_id").agg(F.max("speed").alias("top"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        few = sensors.filter("sensor_id > 'I' or sensor_id = 'HOT'")
        same(joins.lookup_join(hot, few, "sensor_id", how, None), joins.lookup_join(hot, few, "sensor_id", how, 100))


def test_salted_join(hot):
    right = hot.filter("event_id % 10 = 0").select("sensor_id", F.col("event_id").alias("other"))
    left = hot.select("sensor_id", "event_id")
    same(left.join(right, "sensor_id"), joins.salted_join(left, right, "sensor_id", ["event_id"], 50))


@pytest.mark.parametrize("kind", ["spread", "ties"])
def test_order_statistics_by_narrowing(spark, kind):
    rng = random.Random(5)
    values = [rng.gauss(0, 1) if kind == "spread" or rng.random() < 0.6 else 0.25 for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").repartition(4)
    ordered = sorted(values)
    ranks = [0, 1, 5000, 9999, 10_000, 19_999]
    assert quantiles.order_statistics(df, "v", ranks, max_values=300) == {r: ordered[r] for r in ranks}
    (got,) = quantiles.exact_quantiles(df, ["v"], (0.25,), max_values=300)["v"]
    position = 0.25 * 19_999
    low = math.floor(position)
    assert got == pytest.approx(ordered[low] + (ordered[low + 1] - ordered[low]) * (position - low))


def test_split_at_rank_without_sorting(hot):
    tied = hot.withColumn("timestamp", F.date_trunc("day", "timestamp"))
    by_text = tied.withColumn("event_id", F.when(F.col("event_id") % 50 > 0, F.format_string("%09d", "event_id")))
    for df in (tied, by_text):
        rows = sorted((r.timestamp, r.event_id is not None, r.event_id) for r in df.filter("timestamp is not null").select("timestamp", "event_id").collect())
        first = rows[len(rows) - math.ceil(0.2 * len(rows))]
        got = sequences.chronological_split(df).filter("timestamp is not null").collect()
        assert {r.split for r in got} == {"train", "validation"}
        assert all((r.split == "validation") == ((r.timestamp, r.event_id is not None, r.event_id) >= first) for r in got)


@pytest.mark.parametrize("by", [None, "sensor_id"])
def test_values_pass_over_many_chunks_in_groups(spark, by, monkeypatch):
    """Chunks fewer rows long than the frames, several levels of groups, empty chunks between others."""
    from arterial.operators import ordering

    monkeypatch.setattr(ordering, "FAN_OUT", 3)
    monkeypatch.setattr(ordering, "WHOLE_TABLE_ROWS", 4)
    rows = [("A" if i % 3 else "B", i, i % 5 == 0) for i in range(90)] + [(None, 200 + i, True) for i in range(9)]
    frame = spark.createDataFrame(rows, "sensor_id string, t int, mark boolean")

    def values(limit):
        ordered = ordering.OrderedRows(frame, by, "t", limit).index("n", total="all")
        ordered = ordered.carry({"before": F.when(F.col("mark"), F.col("t"))})
        ordered = ordered.carry({"after": F.when(F.col("mark"), F.col("t"))}, backward=True)
        ordered = ordered.rows(lambda d, w: d.withColumns({"lag": F.lag("t", 7).over(w), "lead": F.lead("t", 6).over(w)}), behind=7, ahead=6)
        return ordered

    few = values(4)
    assert few.chunked is not None
    same(few.result(), values(None).result())
    plan = ordering.OrderedRows(frame, by, "t", 4).index("n").carry({"c": F.col("t")}).result()._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan  # no window, and no task, holds all chunks


def test_chunks_share_the_tasks_that_cut_them(spark):
    """Small chunks of many rows: tasks grow with the rows, not with the chunks, and chunks keep their size."""
    frame = spark.range(40_000).select("id", (F.col("id") % 2).alias("k"))
    for by in (None, "k"):
        ordered = OrderedRows(frame, by, "id", 40)
        keys = [by] if by else []
        sizes = ordered.chunked.groupBy(*keys, "_chunk").count()
        assert sizes.agg(F.max("count")).first()[0] <= 40 and sizes.count() >= 1000
        assert len(ordered.chunked.inputFiles()) <= spark.sparkContext.defaultParallelism
        numbered = ordered.index("i", total="n").result()
        assert numbered.count() == 40_000
        expected = F.col("id") + 1 if by is None else F.floor(F.col("id") / 2) + 1
        assert numbered.filter((F.col("i") != expected) | (F.col("n") != (40_000 if by is None else 20_000))).isEmpty()


def test_salted_readings_meet_sums_of_days(spark, monkeypatch):
    from arterial.plans import catalogue

    rows, join = [], joins.salted_join

    def watched(left, right, on, *more):
        rows.append(right.groupBy(on).count().agg(F.max("count")).first()[0])
        return join(left, right, on, *more)

    monkeypatch.setattr(catalogue.joins, "salted_join", watched)
    assert catalogue.far_salted(spark, "/root/testdata/sf0.001").count() > 1
    assert rows[0] <= 2


def test_points_of_a_grid_are_made_by_many_tasks(spark):
    """Few small blocks, each of many points, stay spread under adaptive execution."""
    ends = spark.range(64).select(F.col("id").cast("string").alias("sensor_id"), F.explode(F.array(F.lit(0), F.lit(3_000))).alias("hour"))
    ends = ends.select("sensor_id", F.timestamp_seconds(F.col("hour") * 3600).alias("timestamp"), F.lit(1.0).alias("speed"))
    out = resample.resample(ends, "1 hour", "sensor_id", columns=["speed"])
    assert out.count() == 64 * 3_001
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()


def test_rows_of_trees_are_dealt_to_more_tasks(spark, monkeypatch):
    from arterial.operators import forecast

    df = spark.range(1000).coalesce(2).selectExpr("id", "cast(id % 10 as double) as x", "cast(id % 10 > 4 as double) as speed")
    parts = forecast.dealt(df, 100).rdd.glom().map(len).collect()
    assert sum(parts) == 1000 and len(parts) == 10 and max(parts) <= 110
    assert forecast.dealt(df, 500).rdd.getNumPartitions() == 2
    seen = []
    monkeypatch.setattr(forecast.GBTRegressor, "_fit", lambda self, rows: seen.append(rows.rdd.getNumPartitions()))
    monkeypatch.setattr(forecast, "TREE_ROWS", 100)
    forecast.train(df, ["x"], kind="gbt")
    assert seen == [10]
