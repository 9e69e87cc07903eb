"""Header-only reading, update tables with a base, the metric store, stored sequences, sketches and routes."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arterial.operators import metrics, network, quality, sequences
from arterial.operators.bellman_ford import bellman_ford
from arterial.session import pin
from arterial.sources import files
from arterial.streaming import sinks


def bytes_read(spark, since):
    store, total, stage = spark.sparkContext._jsc.sc().statusStore(), 0, since
    while True:
        try:
            total += store.lastStageAttempt(stage).inputBytes()
        except Exception:  # no such stage
            if stage > since + 40:
                return total
        stage += 1


def last_stage(spark):
    spark.range(1).collect()
    store, stage = spark.sparkContext._jsc.sc().statusStore(), 0
    for number in range(20_000):
        try:
            store.lastStageAttempt(number)
            stage = number
        except Exception:  # not run
            if number > stage + 200:
                break
    return stage + 1


def test_headers_cost_a_buffer_per_file(spark, tmp_path):
    for i, (head, line) in enumerate([("a,b,t", "{0},x{0},2024-01-01"), ('"t", b ,a', "2024-01-02,y{0},{0}"), ("a,t", "{0},never")]):
        lines = "".join(line.format(j) + "\n" for j in range(60_000))
        (tmp_path / f"f{i}.csv").write_text(("" if i else "\ufeff") + head + "\n" + lines)
    (tmp_path / "empty.csv").write_text("")
    size = sum(f.stat().st_size for f in tmp_path.iterdir())
    since = last_stage(spark)
    heads = files.file_heads(spark, str(tmp_path))
    assert heads.count() == 3
    assert bytes_read(spark, since) < size / 10
    df = files.read_by_name(spark, str(tmp_path), T.StructType.fromDDL("a int, t timestamp, missing double"))
    assert df.columns == ["a", "t", "missing", "b"]
    rows = df.groupBy(F.substring("b", 1, 1).alias("b")).agg(F.count("*").alias("n"), F.max("a").alias("a"), F.count("t").alias("t"), F.count("missing").alias("m"))
    assert {r["b"]: tuple(r)[1:] for r in rows.collect()} == {"x": (60_000, 59_999, 60_000, 0), "y": (60_000, 59_999, 60_000, 0), None: (60_000, 59_999, 0, 0)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "FileScan text" not in plan


def test_landed_csv_goes_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("speed,created_date\n40,2024-01-01\n")
    (tmp_path / "b.csv").write_text("created_date,volume,speed\n2024-01-02,7,50\n")
    rows = files.read_city_sensors(spark, str(tmp_path), "csv").orderBy("created_date").collect()
    assert [(r.created_date, r.speed, r.volume) for r in rows] == [("2024-01-01", "40", None), ("2024-01-02", "50", "7")]
    trips = tmp_path / "trips"
    trips.mkdir()
    (trips / "a.csv").write_text("lat,lon,time\n40.6,-74,2024-01-01 00:00:00\n")
    (trips / "b.csv").write_text("time,lng,latitude\n2024-01-01 00:01:00,-74.5,40.7\n")
    rows = files.read_trajectory(spark, str(trips)).orderBy("timestamp").collect()
    assert [(r.latitude, r.longitude) for r in rows] == [(40.6, -74.0), (40.7, -74.5)]
    assert all(r.timestamp is not None for r in rows)


def test_update_tables_are_read_while_they_are_merged(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = lambda n: spark.createDataFrame([(k, n) for k in range(n % 3, 30, 3)] + [(100 + n, n)], "k int, v int")
    want = {}
    for number in range(8):
        rows(number).write.mode("overwrite").parquet(f"{path}/batch={number}")
        want |= {r.k: r.v for r in rows(number).collect()}
        if number in (3, 6):
            before = sinks.read_updates(spark, path, ["k"])  # a reader that started with the version before
            assert sinks.compact_updates(spark, path, ["k"]) == number // 3
            assert {r.k: r.v for r in before.collect()} == want
        assert {r.k: r.v for r in sinks.read_updates(spark, path, ["k"]).collect()} == want
    table = sinks.UpdateTable(spark, path)
    assert table.manifest() == (2, 5) and table.batches(-1)[0] > 2  # what only the first version read is gone
    rows(7).write.mode("overwrite").parquet(f"{path}/batch=7")  # the last batch once more
    assert {r.k: r.v for r in sinks.read_updates(spark, path, ["k"]).collect()} == want
    with pytest.raises(RuntimeError):
        table.publish(2, 7)
    assert table.manifest() == (2, 5)


def test_metric_store_counts_attempts_once(spark, tmp_path):
    store = metrics.MetricStore(spark, str(tmp_path / "metrics"))
    of = lambda e: metrics.error_metrics(spark.createDataFrame([(1.0, 1.0 + e), (2.0, 2.0)], "y_true double, y_pred double"), metrics=["mae"])
    assert store.history().count() == 0
    assert [store.append(of(1.0), "a"), store.append(of(3.0), "b"), store.append(of(3.0), "b"), store.append(of(1.0), "a")] == [0, 1, 1, 0]
    assert store.average().first()["value"] == 1.0 and store.latest().first()["value"] == 1.5
    numbers = []
    threads = [threading.Thread(target=lambda i=i: numbers.append(store.append(of(2.0), f"t{i}"))) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(numbers) == [2, 3, 4, 5]
    assert store.reset() == 1 and store.history().count() == 0 and store.history(0).count() == 6


def test_stored_sequences_hold_rows_about_once(spark, readings):
    length, block = 10, 40
    blocks = pin(sequences.sequence_blocks(readings, ["speed"], "speed", length, block, by=None, tiebreak="event_id"))
    n = readings.count()
    assert blocks.agg(F.sum(F.size("rows"))).first()[0] <= n * (block + length) / block + length
    got = {(r.event_id, tuple(x[0] for x in r.x), r.y) for r in sequences.samples(blocks, length, block).collect()}
    plain = sequences.with_sequences(readings, ["speed"], "speed", length, by=None, tiebreak="event_id")
    assert got == {(r.event_id, tuple(x[0] for x in r.x), r.y) for r in plain.collect()} and len(got) == n - length


def test_sketched_limits_are_close_to_exact_ones(spark, readings):
    sketches = pin(quality.daily_sketches(readings, ["speed", "occupancy"]))
    limits = quality.sketched_limits(sketches)
    flagged = quality.detect_outliers(readings, limits=limits)
    for name in ("speed", "occupancy"):
        low, high = quality.outlier_limits(readings, [name])[name]
        assert abs(limits[name][0] - low) < 0.05 * (high - low) and abs(limits[name][1] - high) < 0.05 * (high - low)
    assert flagged.filter("is_outlier").count() <= readings.count() * 0.1


def graph(spark, edges):
    return spark.createDataFrame([(a, b, float(w)) for a, b, w in edges], "src long, dst long, weight double")


def test_directed_searches_find_the_same_costs(spark):
    import random

    rng = random.Random(5)
    side = 9
    nodes = [(r * side + c, 40 + r * 0.01, -74 + c * 0.01) for r in range(side) for c in range(side)]
    near = [(a, b) for a in range(side * side) for b in (a + 1, a - 1, a + side, a - side)
            if 0 <= b < side * side and (abs(a - b) == side or a // side == b // side)]
    edges = graph(spark, [(a, b, rng.randint(1, 9)) for a, b in near] + [(500, 501, 1)])
    places = spark.createDataFrame([*nodes, (500, 40.0, -74.0), (501, 40.01, -74.0)], "id long, latitude double, longitude double")
    pairs = spark.createDataFrame([(rng.randrange(81), rng.randrange(81)) for _ in range(25)] + [(3, 501), (500, 501)], "src long, dst long")
    cost = lambda **how: {(r.src, r.dst): (r.success, r.cost) for r in network.shortest_paths(edges, pairs, with_path=False, **how).collect()}
    plain = cost()
    assert plain[3, 501] == (False, None)
    assert cost(nodes=places) == plain
    assert cost(landmarks=pin(network.landmark_table(edges, [0, 80]))) == plain


def test_landmark_costs_do_not_take_rounds_along_the_network(spark, monkeypatch):
    """A strip of 4 x 300 nodes in cells of 50, with one-way and free segments, a part of its own and a landmark nobody meets."""
    import heapq
    import random

    from arterial.operators import cells

    monkeypatch.setattr(cells, "CELL_NODES", 50)
    rng = random.Random(7)
    near = [(a, b) for a in range(1200) for b in (a + 4, a - 4, a + 1, a - 1) if 0 <= b < 1200 and (abs(a - b) == 4 or a // 4 == b // 4)]
    ways = [(a, b, rng.randint(0, 9)) for a, b in near if rng.random() < 0.9] + [(2000, 2001, 1)]
    landmarks = [0, 1199, 2001, 5000]
    want = {}
    for kind in (0, 1):
        for i, start in enumerate(landmarks):
            queue, cost = [(0.0, start)], {start: 0.0}
            steps = {}
            for a, b, w in ways:
                steps.setdefault((a, b)[kind], []).append(((b, a)[kind], w))
            while queue:
                so_far, at = heapq.heappop(queue)
                for to, w in steps.get(at, []) if so_far == cost[at] else []:
                    if so_far + w < cost.get(to, 1e9):
                        cost[to] = so_far + w
                        heapq.heappush(queue, (cost[to], to))
            for n, c in cost.items():
                want.setdefault(n, [[None] * 4, [None] * 4])[kind][i] = c
    spark.sparkContext.setJobGroup("landmarks", "landmarks")
    found = network.landmark_table(graph(spark, ways), landmarks, reach=1).collect()
    spark.sparkContext._jsc.clearJobGroup()
    some = lambda costs: None if all(c is None for c in costs) else costs
    assert {r["node"]: (r["from_landmarks"], r["to_landmarks"]) for r in found} == {n: (some(a), some(b)) for n, (a, b) in want.items()}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("landmarks")) < 250  # two directions of 150 rounds took 4 or more each


def test_landmark_costs_where_all_nodes_of_a_cell_stay(spark, monkeypatch):
    """Ladders in cells of 10: the last cell has a rung of two nodes on its rim, or one node without a segment of its own."""
    from arterial.operators import cells

    monkeypatch.setattr(cells, "CELL_NODES", 10)
    for size in (22, 21):
        near = [(a, b) for a in range(size) for b in (a + 2, a - 2, a ^ 1) if 0 <= b < size]
        found = network.landmark_table(graph(spark, [(a, b, 1) for a, b in near]), [0, 20], reach=1).collect()
        assert len(found) == size
        for r in found:
            assert r["from_landmarks"] == r["to_landmarks"] == [r["node"] // 2 + r["node"] % 2, 10 - r["node"] // 2 + r["node"] % 2]


def test_bellman_ford_against_a_plain_one(spark):
    import random

    rng = random.Random(11)
    edges = [(rng.randrange(14), rng.randrange(14), rng.randint(-1, 9)) for _ in range(40)] + [(20, 21, 1), (21, 22, -3), (22, 21, 1), (22, 23, 1), (20, 24, 1), (30, 30, -1), (31, 30, 1)]
    pairs = [(a, b) for a in (0, 3, 20, 31) for b in (0, 5, 9, 20, 21, 23, 24, 30)]
    routes, cycles = bellman_ford(graph(spark, edges), spark.createDataFrame(pairs, "src long, dst long"))
    got = {(r.src, r.dst): (r.success, r.cost, r.negative_cycle) for r in routes.collect()}
    inf = float("inf")
    for s in (0, 3, 20, 31):
        best = {s: 0.0}
        for _ in range(60):
            for a, b, w in edges:
                if best.get(a, inf) + w < best.get(b, inf):
                    best[b] = best[a] + w
        bad = {b for a, b, w in edges if best.get(a, inf) + w < best.get(b, inf)}
        while more := {b for a, b, _ in edges if a in bad} - bad:
            bad |= more
        for d in (0, 5, 9, 20, 21, 23, 24, 30):
            want = (False, None, True) if d in bad else (d in best, best.get(d), False)
            assert got[s, d] == want, (s, d)
    weight = {}
    for a, b, w in edges:
        weight[a, b] = min(w, weight.get((a, b), inf))
    listed = cycles.collect()
    assert {21, 30} <= {c.cycle for c in listed}
    for c in listed:
        ring = [*c.nodes, c.nodes[0]]
        assert sum(weight[e] for e in zip(ring, ring[1:])) == c.cost < 0 and min(c.nodes) == c.nodes[0] == c.cycle


def test_sources_stop_at_their_targets_where_weights_are_negative(spark, monkeypatch):
    """A long street up and down: a source with a target next to it does not spread over all of the street."""
    from arterial.operators import bellman_ford as module
    from arterial.operators import network

    height = [0, 4, 1, 3, 2, 5]
    both = [(a, b) for i in range(39) for a, b in ((i, i + 1), (i + 1, i))]
    edges = spark.createDataFrame([(a, b, 1.0 + height[b % 6] - height[a % 6]) for a, b in both], "src int, dst int, weight double")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(39)], "src int, dst int")
    sizes, pin = [], module.pin

    def watched(df):
        out = pin(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(module, "pin", watched)
    monkeypatch.setattr(network, "pin", watched)
    routes, cycles = module.bellman_ford(edges, pairs)
    got = {(r["src"], r["dst"]): (r["success"], r["cost"], r["num_segments"], r["negative_cycle"]) for r in routes.collect()}
    assert got == {(i, i + 1): (True, 1.0 + height[(i + 1) % 6] - height[i % 6], 1, False) for i in range(39)}
    assert cycles.isEmpty() and cycles.columns == ["cycle", "nodes", "num_segments", "cost"]
    assert max(sizes) <= 8 * 39  # all pairs of places would be 1600
