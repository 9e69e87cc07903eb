"""Cheapest ways where edges may have negative weights, with detection of negative cycles (GRF-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arterial.operators.components import components
from arterial.operators.network import shortest_paths
from arterial.session import pin

# Rounds after which a network whose heights still fall is searched for negative cycles.
HEIGHT_ROUNDS = 24


def bellman_ford(edges: DataFrame, pairs: DataFrame, max_rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(routes, cycles) for each distinct pair of ``pairs(src, dst)`` over ``edges(src, dst, weight)``.

    Routes are ``(src, dst, success, cost, num_segments, negative_cycle)``. All sources relax together: a round offers the
    rows it improved to their neighbours and keeps what is cheaper, fewest segments first among equals. Rows remember their
    predecessor. A way of r segments is found in round r at the latest, so a chain of predecessors that has not come to its
    source after as many steps as there were rounds runs in a circle, and such a circle is a negative cycle. Chains are
    followed by doubling, each time the number of rounds has doubled. Everything that can be reached from a cycle has no
    cheapest way: those pairs get ``negative_cycle`` and no cost, and the search goes on without them, so that it always ends.

    Cycles are ``(cycle, nodes, cost, num_segments)``: named by their smallest node, with the nodes in driving order from
    there. Every pair reached through a cycle makes one be listed, not every cycle of the network.

    A network with heights (:func:`_heights`) has no such cycle, and weights that count the climb are not negative. It is
    searched by :func:`shortest_paths`, whose sources stop at the cost of their dearest target instead of spreading over all
    the network; costs are the same.
    """
    pairs = pin(pairs.select("src", "dst").dropna().distinct())
    weight = F.col("weight").cast("double")
    usable = edges.filter(weight.isNotNull() & ~F.isnan(weight))
    # a loop with a negative weight is a cycle of one segment; others lead nowhere
    usable = usable.filter((F.col("src") != F.col("dst")) | (weight < 0))
    edges = pin(usable.groupBy("src", "dst").agg(F.min(weight).alias("weight")))
    steps = edges.select(F.col("src").alias("node"), F.col("dst").alias("_to"), "weight")
    heights = _heights(edges)
    if heights is not None:
        return _over_heights(edges, pairs, heights, max_rounds), _cycles(_no_turning(pairs), edges)
    start = pairs.select(F.col("src").alias("source")).distinct()
    state = frontier = pin(start.select(
        "source", F.col("source").alias("node"), F.lit(0.0).alias("cost"), F.lit(0).alias("hops"), F.col("source").alias("pred")
    ))
    lost = None  # (source, node) without a cheapest way
    turning = None  # (source, node, pred) on cycles
    number, check = 0, 4
    while not frontier.isEmpty() and (max_rounds is None or number < max_rounds):
        number += 1
        way = F.min(F.struct((F.col("cost") + F.col("weight")).alias("cost"), (F.col("hops") + 1).alias("hops"), F.col("node").alias("pred")))
        moved = frontier.join(steps, "node").groupBy("source", F.col("_to").alias("node")).agg(way.alias("way")).select("source", "node", "way.*")
        if lost is not None:
            moved = moved.join(lost, ["source", "node"], "left_anti")
        known = state.select("source", "node", F.col("cost").alias("_cost"), F.col("hops").alias("_hops"))
        cheaper = "_cost is null or cost < _cost or (cost = _cost and hops < _hops)"
        frontier = pin(moved.join(known, ["source", "node"], "left").filter(cheaper).select("source", "node", "cost", "hops", "pred"))
        best = F.min(F.struct("cost", "hops", "pred")).alias("way")
        state = pin(state.unionByName(frontier).groupBy("source", "node").agg(best).select("source", "node", "way.*"))
        if number < check:
            continue
        check = 2 * number
        circling = _circling(state, number)
        if circling.isEmpty():
            continue
        turning = circling if turning is None else turning.unionByName(circling)
        reached = _reached(circling.select("source", "node"), steps)
        lost = reached if lost is None else pin(lost.unionByName(reached).distinct())
        state = pin(state.join(lost, ["source", "node"], "left_anti"))
        frontier = pin(frontier.join(lost, ["source", "node"], "left_anti"))
    found = pairs.join(state.select(F.col("source").alias("src"), F.col("node").alias("dst"), "cost", "hops"), ["src", "dst"], "left")
    if lost is None:
        found = found.withColumn("negative_cycle", F.lit(False))
    else:
        marks = lost.select(F.col("source").alias("src"), F.col("node").alias("dst"), F.lit(True).alias("_lost"))
        found = found.join(marks, ["src", "dst"], "left").withColumn("negative_cycle", F.coalesce("_lost", F.lit(False)))
    routes = found.select("src", "dst", F.col("cost").isNotNull().alias("success"), "cost", F.col("hops").alias("num_segments"), "negative_cycle")
    if turning is None:
        turning = _no_turning(pairs)
    return routes, _cycles(turning, edges)


def _no_turning(pairs: DataFrame) -> DataFrame:
    return pairs.limit(0).select(F.col("src").alias("source"), F.col("src").alias("node"), F.col("src").alias("pred"))


def _heights(edges: DataFrame) -> DataFrame | None:
    """(node, height): the cost of the cheapest way from anywhere to the node, at most 0; a row per node, not per source.

    None if they still fall after ``HEIGHT_ROUNDS`` rounds, as they do for ever on a negative cycle.
    """
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()
    heights = pin(nodes.withColumn("height", F.lit(0.0)))
    lowest = edges.agg(F.min("weight")).first()[0]
    if lowest is None or lowest >= 0:
        return heights
    if lowest == float("-inf"):
        return None
    for _ in range(HEIGHT_ROUNDS):
        offers = edges.join(heights.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node"))
        offers = offers.agg(F.min(F.col("height") + F.col("weight")).alias("_offer"))
        lower = F.col("_offer") < F.col("height")
        moved = pin(heights.join(offers, "node", "left").select("node", F.when(lower, F.col("_offer")).otherwise(F.col("height")).alias("height"), lower.alias("_moved")))
        if moved.where("_moved").isEmpty():
            return heights
        heights = moved.drop("_moved")
    return None


def _over_heights(edges: DataFrame, pairs: DataFrame, heights: DataFrame, max_rounds: int | None) -> DataFrame:
    """Routes by weights that count the climb from height to height; along a way the climbs add up to that of its ends."""
    of_src = heights.withColumnsRenamed({"node": "src", "height": "_from"})
    of_dst = heights.withColumnsRenamed({"node": "dst", "height": "_to"})
    level = F.greatest(F.col("weight") + F.col("_from") - F.col("_to"), F.lit(0.0))  # below 0 by rounding only
    found = shortest_paths(
        edges.join(of_src, "src").join(of_dst, "dst").select("src", "dst", level.alias("weight")), pairs, max_rounds, with_path=False
    )
    climb = F.coalesce("_to", F.lit(0.0)) - F.coalesce("_from", F.lit(0.0))
    return found.join(of_src, "src", "left").join(of_dst, "dst", "left").select(
        "src", "dst", "success", (F.col("cost") + climb).alias("cost"), "num_segments", F.lit(False).alias("negative_cycle")
    )


def _circling(state: DataFrame, rounds: int) -> DataFrame:
    """(source, node, pred) of the nodes on circles of predecessors, found by doubling steps."""
    back = state.select("source", "node", "pred")
    far = back
    for _ in range(rounds.bit_length()):
        onwards = far.select("source", F.col("node").alias("pred"), F.col("pred").alias("_further"))
        far = pin(far.join(onwards, ["source", "pred"]).select("source", "node", F.col("_further").alias("pred")))
    # chains that came to the start of their source are ways; a source that was improved itself is no start any more
    home = state.filter("node = source and hops = 0").select("source", F.col("source").alias("pred"))
    far = pin(far.join(home, ["source", "pred"], "left_anti"))
    ends = pin(far.select("source", F.col("pred").alias("node")).distinct())
    while True:
        n = ends.count()
        again = pin(far.join(ends, ["source", "node"], "left_semi").select("source", F.col("pred").alias("node")).distinct())
        if again.count() == n:  # as many places as before: each leads to another of them and none is the end of a long chain
            return pin(back.join(ends, ["source", "node"], "left_semi"))
        ends = again


def _reached(start: DataFrame, steps: DataFrame) -> DataFrame:
    """(source, node) of all nodes that ways from ``start`` lead to, itself included."""
    seen = frontier = pin(start.distinct())
    while not frontier.isEmpty():
        moved = frontier.join(steps, "node").select("source", F.col("_to").alias("node")).distinct()
        frontier = pin(moved.join(seen, ["source", "node"], "left_anti"))
        seen = pin(seen.unionByName(frontier))
    return seen


def _cycles(turning: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per cycle, from the predecessors of the nodes on it."""
    turning = pin(turning.select("source", "node", "pred").distinct())
    arcs = turning.select(F.struct("source", F.col("pred").alias("n")).alias("a"), F.struct("source", F.col("node").alias("n")).alias("b"))
    part = components(arcs.filter("a <> b")).unionByName(arcs.filter("a = b").select(F.col("a").alias("node"), F.col("b").alias("component")))
    named = part.select(F.col("node.source").alias("source"), F.col("node.n").alias("node"), F.col("component.n").alias("cycle"))
    weighted = turning.join(named, ["source", "node"]).withColumnsRenamed({"pred": "src", "node": "dst"}).join(edges, ["src", "dst"])
    per = weighted.groupBy("source", "cycle").agg(
        F.map_from_entries(F.collect_list(F.struct("src", "dst"))).alias("_next"), F.sum("weight").alias("cost"), F.count("*").cast("int").alias("num_segments")
    )
    walk = F.aggregate(
        F.sequence(F.lit(1), F.col("num_segments")), F.array("cycle"), lambda path, _: F.concat(path, F.array(F.col("_next")[F.element_at(path, -1)]))
    )
    listed = per.select("cycle", F.slice(walk, 1, F.col("num_segments")).alias("nodes"), "cost", "num_segments")
    return listed.groupBy("cycle", "nodes", "num_segments").agg(F.min("cost").alias("cost"))
