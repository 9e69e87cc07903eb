"""Physical plans, and the driver contract."""

from collections import Counter
from datetime import datetime

import pytest

import __spark_entry__ as entry
from arterial.functions.geo import within_bounds
from arterial.operators import congestion, features, ordering, spatial
from arterial.plans import catalogue, views
from arterial.session import checkpoint_root
from arterial.sources.files import time_range
from conftest import SF_DIR


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_bundle_shuffles_once(spark):
    out = features.traffic_features(views.readings(spark, SF_DIR), tiebreak="event_id")
    assert plan_of(out).count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan_of(out)


def test_congestion_needs_no_shuffle_and_hotspots_take_ordered(spark):
    flags = congestion.detect_congestion(views.readings(spark, SF_DIR))
    assert "Exchange" not in plan_of(flags)
    assert "TakeOrderedAndProject" in plan_of(congestion.hotspots(flags))


def test_scans_read_what_they_need(spark):
    out = time_range(views.readings(spark, "/root/testdata/sf0.01"), datetime(2024, 1, 10), datetime(2024, 1, 12)).select("event_id")
    plan = plan_of(out)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp>" in plan


def test_bounds_are_pushed_down(spark, tmp_path):
    path = str(tmp_path / "gps")
    views.gps_points(spark, SF_DIR).write.parquet(path)
    assert "GreaterThanOrEqual(latitude,40.7)" in plan_of(within_bounds(spark.read.parquet(path), 40.7, 40.71, -75.0, -73.0))


def test_windows_aggregate_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["agg1_sliding"](spark, SF_DIR))
    assert plan.rindex("partial_sum") > plan.rindex("Exchange")  # below the last exchange in the tree
    assert plan.index("Generate") < plan.rindex("partial_sum")  # panes are summed before they are spread over windows


def test_no_python_in_the_batch_operators(spark):
    for name in ("win4_traffic", "win9_stops", "rsm2_fill", "sig1_timing", "jon9_asof", "alr1_alerts"):
        assert "Python" not in plan_of(entry.queries()[name](spark, SF_DIR)), name


def test_shared_folder_comes_from_the_session(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_chunks_are_pinned(spark, readings):
    ordered = ordering.OrderedRows(readings, None, ["timestamp", "event_id"], rows_per_task=300)
    assert ordered.plain is None
    sizes = [r["count"] for r in ordered.chunked.groupBy("_chunk").count().collect()]
    assert sum(sizes) == readings.count() and max(sizes) <= 300
    assert "Exchange" not in plan_of(ordered.chunked)


def test_contract():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert not set(catalogue.QUERIES) - set(oracles)  # every query of the catalogue can be checked


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10 and rows[0]["severity"] == "severe"


@pytest.mark.parametrize("name", ["agg1_sliding", "win9_stops", "jon3_nearest", "grf2_paths", "stm9_live_stops", "ml1_training_set"])
def test_queries_match_sql(spark, name):
    from compare import connect, difference, duck_rows, spark_rows

    left = spark_rows(entry.queries()[name](spark, SF_DIR))
    assert difference(left, duck_rows(connect(SF_DIR), entry.oracle_sql()[name])) is None


def test_paths_are_read_back_without_shuffling_the_search_state(spark):
    from arterial.operators import network

    nodes = views.road_nodes(spark, SF_DIR)
    pairs = nodes.selectExpr("id as src", "id + 50 as dst").limit(3)
    found = network.shortest_paths(views.road_edges(spark, SF_DIR), pairs)
    assert "SortMergeJoin" not in plan_of(found)


def test_what_a_run_pins_can_be_released(spark, readings):
    from pathlib import Path

    from arterial.session import pin, scratch

    root = Path(checkpoint_root(spark))
    before = set(root.iterdir())
    with scratch(spark):
        assert pin(readings).count() == readings.count()
        ordering.OrderedRows(readings, None, ["timestamp", "event_id"], rows_per_task=300)
        assert set(root.iterdir()) > before
    assert set(root.iterdir()) == before


def test_quantiles_take_few_jobs(spark, readings):
    from arterial.operators.quantiles import exact_quantiles

    spark.sparkContext.setJobGroup("quantiles", "quantiles")
    exact_quantiles(readings, ["speed", "occupancy", "vehicle_count", "latitude"], (0.25, 0.5, 0.75), max_values=100)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 16  # a scan is one or two jobs under adaptive execution


def rows_out(plan, found: Counter) -> Counter:
    """Rows that the operators of an executed plan put out, by the operator's name."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return rows_out(plan.executedPlan(), found)
    if name.endswith("QueryStageExec"):
        return rows_out(plan.plan(), found)
    metric = plan.metrics().get("numOutputRows")
    found[name] += metric.get().value() if metric.isDefined() else 0
    for i in range(plan.children().size()):
        rows_out(plan.children().apply(i), found)
    return found


def test_a_point_near_nodes_meets_few_cells(spark):
    """The nodes of its own cell bound its search: 29 rows of joins and 434 cells and nodes a point before that."""
    grid = lambda n, name, off: spark.range(n).selectExpr(f"id as {name}", f"40 + floor(id / 100) * 0.005 + {off} as latitude", f"-74 + id % 100 * 0.005 + {off} as longitude")
    found = spatial.nearest_node(grid(1000, "point_id", 0.001), grid(10_000, "id", 0.0))
    assert {(r.point_id, r.node_id) for r in found.collect()} == {(i, i) for i in range(1000)}
    rows = rows_out(found._jdf.queryExecution().executedPlan(), Counter())
    assert sum(n for name, n in rows.items() if "Join" in name) < 12 * 1000
    assert rows["GenerateExec"] < 300 * 1000
