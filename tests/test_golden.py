"""Small cases worked out by hand."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from arterial.functions import haversine, level_right, severity_left
from arterial.functions.temporal import batch_features, temporal_features
from arterial.operators import (
    alerts, clean, congestion, features, forecast, joins, metrics, network, normalize, quality, resample, sequences,
    signals, spatial, trajectory, windows,
)

T0 = datetime(2024, 1, 1)


def minutes(*values):
    return [T0 + timedelta(minutes=v) for v in values]


@pytest.fixture(scope="module")
def points(spark):
    rows = [("LOC001", 40.7128, -74.0060, 30.0, 50.0, 85.0), ("LOC002", 40.7130, -74.0058, 25.0, 50.0, 90.0),
            ("LOC003", 40.7125, -74.0062, 35.0, 50.0, 70.0)]
    return spark.createDataFrame(rows, "location_id STRING, latitude DOUBLE, longitude DOUBLE, speed DOUBLE, speed_limit DOUBLE, occupancy DOUBLE")


def test_congestion_and_hotspots(points):
    flags = congestion.detect_congestion(points)
    rows = {r["location_id"]: r for r in flags.collect()}
    assert rows["LOC001"]["speed_ratio"] == pytest.approx(0.599999988)
    assert [rows[k]["congestion_severity"] for k in sorted(rows)] == ["medium", "high", "medium"]
    assert [rows[k]["is_congested"] for k in sorted(rows)] == [1, 1, 0]
    assert [r["location_id"] for r in congestion.hotspots(flags).collect()] == ["LOC002", "LOC001"]
    assert [r["location_id"] for r in congestion.hotspots(points, 1).collect()] == ["LOC002"]
    assert tuple(congestion.congestion_summary(flags).first()) == (3, 2, 0)


def test_congestion_without_limits_or_speed(spark):
    df = spark.createDataFrame([("a", 20.0, 1), ("b", None, 0)], "location_id STRING, speed DOUBLE, congested_by_camera INT")
    rows = {r["location_id"]: r for r in congestion.detect_congestion(df).collect()}
    assert (rows["a"]["speed_ratio"], rows["a"]["is_congested"]) == (0.4, 1)
    assert (rows["b"]["is_congested"], rows["b"]["congestion_severity"]) == (0, "none")
    bare = congestion.detect_congestion(spark.createDataFrame([("x",)], "location_id STRING"))
    assert (bare.first()["is_congested"], bare.first()["congestion_severity"]) == (0, "none")


def test_predicted_congestion_defaults_the_limit(spark):
    current = spark.createDataFrame([("a", None), ("b", 100.0)], "location_id STRING, speed_limit DOUBLE")
    predicted = spark.createDataFrame([("a", 20.0), ("b", 100.0)], "location_id STRING, predicted_speed DOUBLE")
    rows = {r["location_id"]: r for r in congestion.predicted_congestion(current, predicted).collect()}
    assert (rows["a"]["speed_limit"], rows["a"]["severity"], rows["a"]["is_congested"]) == (50.0, "high", True)
    assert (rows["b"]["severity"], rows["b"]["is_congested"]) == ("none", False)


def test_level_edges(spark):
    values = [-0.1, 0.0, 0.3, 0.5, 0.7, 1.0, 1.1, None, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, r DOUBLE").orderBy("i")
    rows = df.select(level_right(F.col("r")).alias("right"), severity_left(F.col("r")).alias("left")).collect()
    assert [r["right"] for r in rows] == [None, None, "severe", "high", "medium", "low", "none", None, None]
    assert [r["left"] for r in rows] == ["severe", "severe", "high", "medium", "low", "none", "none", "none", "none"]


def test_weekday_conventions(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 7, 18),)], "timestamp TIMESTAMP")
    row = temporal_features(df).first()
    assert (row["day_of_week"], row["is_weekend"], row["is_evening"], row["is_rush_hour"]) == (6, 1, 1, 1)
    row = batch_features(df).first()
    assert (row["day_of_week_sun1"], row["is_weekend"], row["hour"]) == (1, 1, 18)
    assert temporal_features(df.drop("timestamp").withColumn("x", F.lit(1))).columns == ["x"]


def test_signal_timing(spark):
    flows = spark.createDataFrame(
        [("I1", "north", 100.0), ("I1", "south", 120.0), ("I1", "east", 80.0), ("I1", "west", 90.0), ("I2", "north", 0.0)],
        "intersection_id STRING, approach STRING, flow DOUBLE",
    )
    rows = {r["intersection_id"]: r for r in signals.signal_timing(flows).collect()}
    first = rows["I1"]
    assert {k: tuple(v) for k, v in first["timing"].items()} == {
        "north": (23, 3, 74), "south": (27, 3, 70), "east": (18, 3, 79), "west": (20, 3, 77)}
    assert (first["cycle_time"], first["recommendation"]) == (100, "implement")
    idle = rows["I2"]
    assert (idle["cycle_time"], idle["recommendation"], len(idle["timing"])) == (90, "maintain", 4)
    assert set(map(tuple, idle["timing"].values())) == {(30, 3, 57)}
    timed = signals.signal_timing(flows.withColumn("has_timing", F.lit(True))).filter("intersection_id = 'I1'").first()
    assert timed["recommendation"] == "optimize"
    for r in rows.values():
        if r["recommendation"] != "maintain":
            assert sum(v["green"] for v in r["timing"].values()) + 3 * len(r["timing"]) == r["cycle_time"]


def test_greens_that_are_whole_seconds(spark):
    """A share of 13 in 90 of 90 seconds is 13, though 90 * (13 / 90) is less."""
    rows = [(n, a, float(f)) for n in range(1, 90) for a, f in (("north", n), ("south", 90 - n))]
    timings = signals.signal_timing(spark.createDataFrame(rows, "intersection_id INT, approach STRING, flow DOUBLE"))
    found = {r["intersection_id"]: r["timing"]["north"]["green"] for r in timings.collect()}
    assert found == {n: max(10, n) for n in range(1, 90)}


def test_delay_reduction(spark):
    row = signals.delay_reduction(spark.createDataFrame([(90, 100)], "current_cycle_time INT, optimized_cycle_time INT")).first()
    assert row["cycle_reduction_seconds"] == -10 and row["cycle_reduction_percent"] == pytest.approx(-11.1111, abs=1e-4)
    assert (row["current_avg_delay"], row["optimized_avg_delay"], row["delay_reduction_seconds"]) == (45, 50, -5)


def test_gps_test_frame(spark):
    rows = [("v", t, 40.7128, -74.0060) for t in minutes(*range(10))]
    df = spark.createDataFrame(rows, "vehicle_id STRING, timestamp TIMESTAMP, latitude DOUBLE, longitude DOUBLE")
    for align in ("leg", "reference"):
        out = trajectory.gps_speed(df, align=align).collect()
        assert {(r["distance_meters"], r["speed_kmh"]) for r in out} == {(0.0, 0.0)}
    stops = trajectory.detect_stops(df).collect()
    assert {(r["stop_duration"], r["is_significant_stop"]) for r in stops} == {(540.0, True)}
    with pytest.raises(ValueError):
        trajectory.gps_speed(df, align="other")


def test_stop_runs(spark):
    speeds = [0.0, 0.0, 0.0, 50.0, 0.0]
    rows = [("v", t, s) for t, s in zip(minutes(0, 1, 3, 4, 5), speeds)]
    df = spark.createDataFrame(rows, "vehicle_id STRING, timestamp TIMESTAMP, speed_kmh DOUBLE")
    by_rows = trajectory.detect_stops(df, duration="rows").orderBy("timestamp").collect()
    assert [r["stop_duration"] for r in by_rows] == [120, 120, 120, 0, 0]
    by_time = trajectory.detect_stops(df).orderBy("timestamp").collect()
    assert [r["stop_duration"] for r in by_time] == [180, 180, 180, 0, 0]
    assert [r["is_significant_stop"] for r in by_time] == [True, True, True, False, False]


def test_rolling_with_nulls(spark):
    def run(values):
        rows = [("s", t, v) for t, v in zip(minutes(0, 1, 2), values)]
        df = spark.createDataFrame(rows, "sensor_id STRING, timestamp TIMESTAMP, speed DOUBLE")
        return features.traffic_features(df).orderBy("timestamp").collect()

    assert [r["speed_rolling_mean_5"] for r in run([1.0, None, 3.0])] == [1, 1, 2]
    stds = [r["speed_rolling_std_5"] for r in run([None, 1.0, 3.0])]
    assert stds[:2] == [None, None] and stds[2] == pytest.approx(math.sqrt(2))


def test_flow_rate(spark):
    rows = [("s", t, 10) for t in minutes(0, 6, 6)]
    df = spark.createDataFrame(rows, "sensor_id STRING, timestamp TIMESTAMP, vehicle_count INT")
    flow = sorted(r["flow_rate"] for r in features.traffic_features(df).collect())
    assert flow == pytest.approx([0, 10 / (0.1 + 1e-6), 1e7])


def test_sequence_counts(spark):
    df = spark.range(100).select(
        F.lit("s").alias("sensor_id"), F.timestamp_seconds(F.col("id") * 60).alias("timestamp"), F.col("id").cast("double").alias("speed"))
    out = sequences.with_sequences(df, ["speed"], "speed", 10).orderBy("timestamp").collect()
    assert len(out) == 90 and out[-1]["y"] == 99 and [v[0] for v in out[-1]["x"]] == list(range(89, 99))
    blocks = sequences.block_sequences(df, ["speed"], "speed", 30).orderBy("block").collect()
    assert [(b["y"], len(b["x"])) for b in blocks] == [(0, 30), (30, 30), (60, 30)]


def test_split_rounds_the_validation_part_up(spark):
    df = spark.range(7).select(F.col("id").alias("event_id"), F.lit(T0).alias("timestamp"))
    split = sequences.chronological_split(df).filter("split = 'validation'").collect()
    assert sorted(r["event_id"] for r in split) == [5, 6]


def test_resample_keeps_empty_buckets(spark):
    rows = [("v", T0 + timedelta(seconds=30), 1.0), ("v", T0 + timedelta(minutes=3, seconds=10), 2.0)]
    df = spark.createDataFrame(rows, "vehicle_id STRING, timestamp TIMESTAMP, x DOUBLE")
    out = resample.resample(df).orderBy("timestamp").collect()
    assert [(r["timestamp"].minute, r["x"]) for r in out] == [(0, 1), (1, None), (2, None), (3, 2)]
    filled = resample.fill_gaps(resample.resample(df), ["x"]).orderBy("timestamp").collect()
    assert [r["x"] for r in filled] == pytest.approx([1, 4 / 3, 5 / 3, 2])
    assert resample.resample(df.drop("vehicle_id"), by=None).count() == 4
    with pytest.raises(ValueError):
        resample.fill_gaps(df, ["x"], "guess")


def test_fill_edges(spark):
    rows = [("v", t, x) for t, x in zip(minutes(0, 1, 2, 3), [None, 5.0, None, None])]
    df = spark.createDataFrame(rows, "vehicle_id STRING, timestamp TIMESTAMP, x DOUBLE")
    value = lambda method: [r["x"] for r in resample.fill_gaps(df, ["x"], method).orderBy("timestamp").collect()]
    assert value("interpolate") == [None, 5, 5, 5]
    assert value("forward_fill") == [None, 5, 5, 5]
    assert value("backward_fill") == [5, 5, None, None]
    assert value("drop") == [5]


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0), (4.0, 2.0)], "y_true DOUBLE, y_pred DOUBLE")
    row = metrics.error_metrics(df).first()
    assert row["mae"] == 1 and row["mse"] == pytest.approx(5 / 3) and row["rmse"] == pytest.approx(1.2910, abs=1e-4)
    assert row["mape"] == 25 and row["r2"] == pytest.approx(0.375)
    zeros = metrics.error_metrics(df.withColumn("y_true", F.lit(0.0)), metrics=["mape", "mae"]).first()
    assert zeros["mape"] == math.inf
    history = metrics.metric_rows(metrics.error_metrics(df), "a", 1).union(
        metrics.metric_rows(metrics.error_metrics(df.limit(1)), "a", 2)).cache()
    latest = {r["metric"]: r["value"] for r in metrics.latest_metrics(history).collect()}
    assert latest["mae"] == 1.0
    text = metrics.metrics_summary(metrics.average_metrics(metrics.metric_rows(metrics.error_metrics(df), "b", 1))).first()["summary"]
    assert text.splitlines()[2:] == ["MAE: 1.0000", "RMSE: 1.2910", "MAPE: 25.00%", "R2: 0.3750", "MSE: 1.6667"]


def test_constant_columns(spark):
    df = spark.createDataFrame([(7.0, 1.0), (7.0, 3.0)], "c DOUBLE, x DOUBLE")
    for method in normalize.METHODS:
        scaled, stats = normalize.normalize(df, None, method)
        assert [r["c"] for r in scaled.collect()] == [0.0, 0.0]
        assert [r["c"] for r in normalize.apply_normalizer(df, stats, "keep").collect()] == [7.0, 7.0]
    scaled, _ = normalize.normalize(df)
    assert sorted(r["x"] for r in scaled.collect()) == [0.0, 1.0]
    with pytest.raises(ValueError):
        normalize.fit_normalizer(df, method="other")


def test_outliers(spark):
    df = spark.createDataFrame([(float(i % 10), 5.0) for i in range(50)] + [(1000.0, 5.0), (None, 5.0)], "x DOUBLE, flat DOUBLE")
    for method in ("iqr", "zscore"):
        bad = quality.detect_outliers(df, None, method).filter("is_outlier").collect()
        assert [r["x"] for r in bad] == [1000.0]
        assert quality.remove_outliers(df, None, method).count() == 51
    with pytest.raises(ValueError):
        quality.detect_outliers(df, ["x"], "other")


def test_validation_of_empty_and_partial_tables(spark):
    empty = spark.createDataFrame([], "speed STRING")
    failed = {r["check_name"] for r in quality.validate_readings(empty, ["speed", "x"]).filter("not passed").collect()}
    assert failed == {"empty", "required_columns", "timestamp_column", "speed_numeric"}
    assert not quality.is_valid(quality.validate_readings(empty))
    assert quality.is_valid(quality.validate_geographic_bounds(empty))
    assert quality.missing_columns(empty, ["speed", "x"]) == ["x"]
    ok = spark.createDataFrame([(T0, 1.0)], "timestamp TIMESTAMP, speed DOUBLE")
    assert quality.is_valid(quality.validate_readings(ok, ["speed"]))
    assert quality.is_valid(quality.validate_timestamp_range(ok, now=T0))
    assert not quality.is_valid(quality.validate_timestamp_range(ok, now=T0 - timedelta(hours=2)))


def test_cleaning(spark):
    raw = spark.createDataFrame([("2024-01-01 00:00:00", "12.5"), ("bad", "1"), (None, "n/a")], "date STRING, speed STRING")
    (row,) = clean.clean_city_sensors(raw).collect()
    assert row["timestamp"] == T0 and row["speed"] == 12.5
    named = spark.createDataFrame([("1", "2", "3")], "lat STRING, lon STRING, lng STRING")
    row = clean.clean_trajectory(named).first()
    assert (row["latitude"], row["longitude"]) == (1.0, 2.0) and row["timestamp"] is not None
    filled = clean.fill_missing(spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (2.0,)], "x DOUBLE"), ["x"])
    assert sorted(r["x"] for r in filled.collect()) == [0, 0, 0, 2]
    assert clean.nan_to_null(spark.createDataFrame([(float("nan"),)], "x DOUBLE")).first()["x"] is None
    prepared = clean.canonical_names(spark.createDataFrame([(1.0, "c")], "average_speed DOUBLE, camera_id STRING"))
    assert prepared.columns == ["speed", "sensor_id"]


def test_alerts(spark):
    rows = [(s, f"L{i}") for i, s in enumerate(["none", "low", "medium", "high", "severe"])]
    df = spark.createDataFrame(rows, "severity STRING, location_id STRING")
    assert [r["severity"] for r in alerts.traffic_alerts(df).collect()] == ["high", "severe"]
    assert alerts.traffic_alerts(df, "LOW").count() == 4
    one = alerts.traffic_alerts(df, "severe").first()
    assert one["location"]["location_id"] == "L4" and "L4" in one["message"] and one["location"]["latitude"] == 0.0
    advice = {r["location_id"]: [e["type"] for e in r["recommendations"]]
              for r in alerts.route_recommendations(df.withColumnRenamed("severity", "congestion_level")).collect()}
    assert advice["L4"] == ["alternative_route", "route_optimization"] and advice["L0"] == ["route_optimization"]
    routes = spark.createDataFrame([("r", "severe", 61.0, 0.1, 4.0)], "route_id STRING, congestion_level STRING, travel_time_minutes DOUBLE, precipitation DOUBLE, visibility DOUBLE")
    row = alerts.travel_advisory(routes).first()
    assert [a["type"] for a in row["alerts"]] == ["congestion", "weather", "weather"] and len(row["recommendations"]) == 1
    calm = alerts.travel_advisory(routes.select("route_id")).first()
    assert calm["alerts"] == [] and calm["recommendations"] == []


def test_two_node_route(spark):
    nodes = spark.createDataFrame([(0, 40.7128, -74.0060), (1, 40.7580, -73.9855)], "id BIGINT, latitude DOUBLE, longitude DOUBLE")
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 5, 1.0)], "src BIGINT, dst BIGINT, weight DOUBLE")
    requests = spark.createDataFrame([(1, 40.7128, -74.0060, 40.7580, -73.9855), (2, 40.7580, -73.9855, 40.7128, -74.0060), (3, 40.7, -74.0, 40.7, -74.0)],
                                     "request_id INT, origin_lat DOUBLE, origin_lon DOUBLE, dest_lat DOUBLE, dest_lon DOUBLE")
    rows = {r["request_id"]: r for r in network.find_routes(requests, nodes, edges).collect()}
    assert rows[1]["success"] and rows[1]["path"] == [0, 1] and rows[1]["num_segments"] == 1
    assert rows[1]["distance_km"] == pytest.approx(5.314523, abs=1e-6) and len(rows[1]["coordinates"]) == 2
    assert not rows[2]["success"] and rows[2]["path"] is None
    assert rows[3]["path"] == [0] and rows[3]["distance_km"] == 0 and rows[3]["num_segments"] == 0
    assert tuple(network.graph_counts(nodes, edges).first()) == (2, 1)


def test_shortest_paths_against_brute_force(spark):
    import random

    rng = random.Random(3)
    edges = {(rng.randrange(25), rng.randrange(25)): float(rng.randrange(1, 9)) for _ in range(90)}
    best = {(i, i): 0.0 for i in range(25)}
    for _ in range(25):  # relax every edge as often as there are nodes
        for s in range(25):
            for (a, b), w in edges.items():
                if (s, a) in best and best[s, a] + w < best.get((s, b), math.inf):
                    best[s, b] = best[s, a] + w
    df = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src BIGINT, dst BIGINT, weight DOUBLE")
    pairs = spark.createDataFrame([(s, d) for s in range(0, 25, 3) for d in range(25)], "src BIGINT, dst BIGINT")
    for r in network.shortest_paths(df, pairs).collect():
        assert r["cost"] == best.get((r["src"], r["dst"])), r
        assert r["success"] == (r["cost"] is not None)
        if r["success"]:
            path = r["path"]
            assert path[0] == r["src"] and path[-1] == r["dst"] and r["num_segments"] == len(path) - 1
            assert sum(edges[a, b] for a, b in zip(path, path[1:])) == r["cost"]
    with pytest.raises(ValueError):
        network.shortest_paths(df.withColumn("weight", F.lit(-1.0)), pairs)


def test_nearest_against_brute_force(spark, monkeypatch):
    """Clusters, copies, far points and both sides of the date line; cells of at most 4 nodes."""
    import random

    monkeypatch.setattr(spatial, "LEAF_NODES", 4)
    rng = random.Random(11)
    nodes = [(i, 40 + rng.random() * 0.01, -74 + rng.random() * 0.01) for i in range(60)]
    nodes += [(100 + i, 40.005, -73.995) for i in range(20)]
    nodes += [(200 + i, rng.uniform(-80, 80), rng.choice([179.999, -179.999])) for i in range(20)]
    points = [(i, rng.uniform(39.99, 40.02), rng.uniform(-74.01, -73.98)) for i in range(20)]
    points += [(50, 0.0, 180.0), (51, 89.9, 10.0), (52, -40.0, 106.0), (53, 40.005, -73.995)]

    def metres(a, b):
        p, q = math.radians(a[1]), math.radians(b[1])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6_371_000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    schema = "{0} INT, latitude DOUBLE, longitude DOUBLE"
    df = spark.createDataFrame(nodes, schema.format("id"))
    found = spatial.knn_join(spark.createDataFrame(points, schema.format("point_id")), df, k=3).collect()
    got = {(r["point_id"], r["rank"]): r["id"] for r in found}
    for p in points:
        expected = sorted((round(metres(p, n), 3), n[0]) for n in nodes)[:3]
        assert [got[p[0], i + 1] for i in range(3)] == [n for _, n in expected], p
    graph = {}
    for r in spatial.knn_graph(df, k=2, radius_m=300.0).collect():
        graph.setdefault(r["src"], []).append((round(r["distance_m"], 3), r["dst"]))
    for n in nodes:
        expected = sorted((round(metres(n, m), 3), m[0]) for m in nodes if m[0] != n[0] and metres(n, m) <= 300)[:2]
        assert sorted(graph.get(n[0], [])) == expected, n


def test_haversine_special_points(spark):
    row = spark.range(1).select(haversine(0.0, 0.0, 0.0, 180.0).alias("half"), haversine(1.0, 2.0, 1.0, 2.0).alias("zero")).first()
    assert row["half"] == pytest.approx(math.pi * 6371) and row["zero"] == 0


def test_propagation_on_a_line(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1)], "src BIGINT, dst BIGINT")
    h = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 5.0)], "id BIGINT, x DOUBLE")
    out = {r["id"]: r["x"] for r in network.propagate(edges, h, ["x"]).collect()}
    assert out == pytest.approx({1: 3.0, 2: 3.0, 3: 5.0})
    assert network.pool_features(h, ["x"]).first()["x"] == pytest.approx(11 / 3)


def test_ensemble_and_vote(spark):
    df = spark.createDataFrame([(1.0, 3.0, "x", "y", "y"), (None, 3.0, "x", "y", "z")], "a DOUBLE, b DOUBLE, p STRING, q STRING, r STRING")
    out = forecast.ensemble(df, {"a": 0.25, "b": 0.75}).collect()
    assert [r["prediction"] for r in out] == [2.5, 3.0]
    assert [r["vote"] for r in forecast.majority_vote(df, ["p", "q", "r"]).collect()] == ["y", "x"]
    assert forecast.equal_weights(["a", "b"]) == {"a": 0.5, "b": 0.5}
    scored = forecast.score_with(df.select("a", "b"), ["b"], lambda: lambda frame: frame["b"] * 2)
    assert [r["prediction"] for r in scored.collect()] == [6.0, 6.0]


def test_holidays(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5),), (datetime(2024, 1, 2),)], "timestamp TIMESTAMP")
    days = spark.createDataFrame([(T0.date(),), (T0.date(),)], "date DATE")
    assert sorted(r["is_holiday"] for r in joins.holiday_flag(df, days).collect()) == [0, 1]


def test_window_bounds(spark):
    df = spark.createDataFrame([("s", T0, 10.0, 1, None)], "sensor_id STRING, timestamp TIMESTAMP, speed DOUBLE, vehicle_count INT, occupancy DOUBLE")
    rows = windows.window_aggregate(df).orderBy("window_start").collect()
    assert len(rows) == 5 and rows[-1]["window_start"] == T0 and rows[0]["window_end"] == T0 + timedelta(minutes=1)
    assert rows[0]["avg_occupancy"] is None and rows[0]["total_vehicles"] == 1
    assert windows.window_aggregate(df, "5 minutes", None).count() == 1
