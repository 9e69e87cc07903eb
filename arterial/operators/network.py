"""Road networks and routes (GRF-1 to GRF-7, JON-2, JON-6, AGG-8, AGG-9, ARR-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arterial.functions.geo import EARTH_RADIUS_KM, haversine
from arterial.functions.traffic import travel_time_minutes
from arterial.operators import cells
from arterial.operators.components import components
from arterial.operators.joins import lookup_join, salted_join
from arterial.operators.ordering import ROWS_PER_TASK
from arterial.operators.spatial import nearest_node
from arterial.session import pin, scratch_path

# Requested routes up to this number (of four numbers each) are broadcast while their paths are read back.
BROADCAST_PAIRS = 100_000
# Rounds after which a search asks which ends are connected at all; shorter searches end before that pays.
CONNECTED_AFTER = 8
ALGORITHMS = ("astar", "dijkstra")


def known_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """GRF-1/JON-2: edges whose two ends are nodes."""
    ids = nodes.select("id").distinct()
    for end in ("src", "dst"):
        edges = lookup_join(edges, ids.withColumnRenamed("id", end), end, "left_semi")
    return edges


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """AGG-8: ``(nodes, edges)`` of the graph that GRF-1 keeps."""
    counts = nodes.select(F.lit(1).alias("n"), F.lit(0).alias("e")).unionAll(
        known_edges(edges, nodes).select(F.lit(0).alias("n"), F.lit(1).alias("e"))
    )
    return counts.agg(F.sum("n").alias("nodes"), F.sum("e").alias("edges"))


def traffic_weights(
    edges: DataFrame, speeds: DataFrame, nodes: DataFrame, default_speed: float = 50.0
) -> DataFrame:
    """GRF-5: edge weight = minutes to drive it, from ``speeds(id, avg_speed)`` at the start node."""
    placed = with_edge_lengths(edges, nodes)
    known = speeds.select(F.col("id").alias("src"), "avg_speed")
    joined = lookup_join(placed, known, "src", "left")
    speed = F.when(F.col("avg_speed") > 0, F.col("avg_speed")).otherwise(F.lit(default_speed))
    return joined.select("src", "dst", travel_time_minutes(F.col("length_km"), speed).alias("weight"))


def with_edge_lengths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add ``length_km``, the great-circle length of each edge."""
    for end in ("src", "dst"):
        place = nodes.select(
            F.col("id").alias(end), F.col("latitude").alias("_lat_" + end), F.col("longitude").alias("_lon_" + end)
        )
        edges = lookup_join(edges, place, end)
    length = haversine("_lat_src", "_lon_src", "_lat_dst", "_lon_dst", EARTH_RADIUS_KM)
    return edges.withColumn("length_km", length).drop("_lat_src", "_lon_src", "_lat_dst", "_lon_dst")


def landmark_table(edges: DataFrame, landmarks: Sequence, reach: int = 3) -> DataFrame:
    """``(node, from_landmarks, to_landmarks)``: costs from and to each of ``landmarks`` (ids), null where there is no way.

    For lower bounds in :func:`shortest_paths`; make it once per network and keep it. Landmarks at the rim serve best.
    The network is cut into cells of nodes with neighbouring ids, and only the rims of cells stay, level by level; costs are
    found between the few nodes of the last level and go back down, so the work does not grow with the length of ways.
    Where ids say so little about places that cells are nearly all rim, rounds follow the ways: shortcuts over up to
    2 ** ``reach`` segments are laid first, so they cover that many segments each; lower it for networks with many
    neighbours per node.
    """
    weight = F.col("weight").cast("double")
    plain = edges.filter((F.col("src") != F.col("dst")) & weight.isNotNull() & ~F.isnan(weight))
    graph = pin(plain.groupBy("src", "dst").agg(F.min(weight).alias("weight")))
    levels = []
    while not graph.isEmpty():
        parts = cells.cut(graph)
        placed, count = cells.placed(graph, parts), parts.count()
        tasks = -(-count // cells.TASK_NODES)
        smaller = pin(cells.contract(placed, landmarks, tasks))
        ends = smaller.select(F.col("src").alias("node")).unionByName(smaller.select(F.col("dst").alias("node")))
        if ends.distinct().count() > cells.SHRINKS * count:
            break
        levels.append((placed, parts, tasks))
        graph = smaller
    costs = _landmark_rounds(graph, landmarks, reach)
    for placed, parts, tasks in reversed(levels):
        costs = cells.expand(placed, parts, costs, landmarks, tasks)
    finite = lambda c: F.transform(c, lambda v: F.when(v < float("inf"), v))
    some = lambda c: F.when(F.exists(c, lambda v: v < float("inf")), finite(c)).alias(c)
    return costs.select("node", some("from_landmarks"), some("to_landmarks")).filter("from_landmarks is not null or to_landmarks is not null")


def _landmark_rounds(short: DataFrame, landmarks: Sequence, reach: int) -> DataFrame:
    """``(node, from_landmarks, to_landmarks)``, infinity where there is no way, by rounds over shortcuts."""
    spark = short.sparkSession
    for _ in range(reach):
        further = short.select(F.col("src").alias("dst"), F.col("dst").alias("_end"), F.col("weight").alias("_more"))
        longer = short.join(further, "dst").select("src", F.col("_end").alias("dst"), (F.col("weight") + F.col("_more")).alias("weight"))
        both = short.unionByName(longer.filter("src <> dst"))
        short = pin(both.groupBy("src", "dst").agg(F.min("weight").alias("weight")))
    start = spark.createDataFrame([(i, n) for i, n in enumerate(landmarks)], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("node", short.schema["src"].dataType)]))
    found = {}
    for name, tail, head in (("from_landmarks", "src", "dst"), ("to_landmarks", "dst", "src")):
        steps = short.select(F.col(tail).alias("node"), F.col(head).alias("_next"), "weight")
        state = frontier = pin(start.withColumn("cost", F.lit(0.0)))
        while not frontier.isEmpty():
            moved = frontier.join(steps, "node").groupBy("i", F.col("_next").alias("node")).agg(F.min(F.col("cost") + F.col("weight")).alias("cost"))
            known = state.withColumnRenamed("cost", "_cost")
            frontier = pin(moved.join(known, ["i", "node"], "left").filter("_cost is null or cost < _cost").select("i", "node", "cost"))
            state = pin(state.unionByName(frontier).groupBy("i", "node").agg(F.min("cost").alias("cost")))
        costs = F.map_from_entries(F.collect_list(F.struct("i", "cost")))  # one entry per landmark
        numbers = F.sequence(F.lit(0), F.lit(len(landmarks) - 1))
        dense = F.transform(numbers, lambda i: F.coalesce(F.col("_costs")[i], F.lit(float("inf"))))
        found[name] = state.groupBy("node").agg(costs.alias("_costs")).select("node", dense.alias(name))
    both = found["from_landmarks"].join(found["to_landmarks"], "node", "full")
    nowhere = F.array_repeat(F.lit(float("inf")), len(landmarks))
    return pin(both.select("node", *[F.coalesce(name, nowhere).alias(name) for name in found]))


class Goals:
    """How far rows of a search can still be from their targets, at least.

    Bounds come from costs from and to landmarks, or from the distance on the globe times the lowest weight per kilometre
    of any edge. Sources with more than ``MAX_GOALS`` targets spread without them.
    """

    MAX_GOALS = 8

    def __init__(self, edges: DataFrame, targets: DataFrame, nodes: DataFrame | None, landmarks: DataFrame | None):
        self.step = 0.5 * float(edges.agg(F.avg("weight")).first()[0] or 0.0)
        few = targets.groupBy("source").agg(F.count("*").alias("_n")).filter(F.col("_n") <= self.MAX_GOALS).select("source")
        goals = targets.join(few, "source", "left_semi").withColumnRenamed("node", "target")
        if landmarks is not None:
            self.places = landmarks.select("node", "from_landmarks", "to_landmarks")
            ahead = landmarks.select(F.col("node").alias("target"), F.col("from_landmarks").alias("_from"), F.col("to_landmarks").alias("_to"))
            behind = landmarks.select(F.col("node").alias("source"), F.col("to_landmarks").alias("_out"))
            goals = goals.join(ahead, "target", "left").join(behind, "source", "left")
            # some way leads over the best landmark, so a cheapest one costs no more
            self.known = F.array_min(F.zip_with("_out", "_from", lambda a, b: a + b))
            apart = F.concat(
                F.zip_with("_from", "from_landmarks", lambda a, b: a - b), F.zip_with("to_landmarks", "_to", lambda a, b: a - b)
            )
            self.bound = F.array_max(apart)
        else:
            placed = with_edge_lengths(edges, nodes)
            total, measured, rate = placed.agg(
                F.count("*"), F.count("length_km"), F.min(F.when(F.col("length_km") > 0, F.col("weight") / F.col("length_km")))
            ).first()
            rate = float(rate or 0.0) if total == measured == edges.count() else 0.0  # an edge of unknown length bounds nothing
            self.places = nodes.select(F.col("id").alias("node"), "latitude", "longitude")
            ahead = nodes.select(F.col("id").alias("target"), F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
            goals = goals.join(ahead, "target", "left")
            self.known = F.lit(None).cast("double")
            self.bound = haversine("latitude", "longitude", "_lat", "_lon", EARTH_RADIUS_KM) * rate
        self.goals = pin(goals.withColumn("_known", self.known))

    def promising(self, rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows to go on from now, rows to go on from later); rows that cannot give a cheaper way to any target are dropped.

        A row promises its cost and what is left at least. Those go on now that promise no more than the best row of their
        source does, or half an average edge more.
        """
        best = state.join(self.goals.select("source", F.col("target").alias("node")), ["source", "node"], "left_semi")
        best = best.groupBy("source", F.col("node").alias("target")).agg(F.min("cost").alias("_best"))
        met = rows.join(self.goals.join(best, ["source", "target"], "left"), "source", "left").join(self.places, "node", "left")
        total = F.col("cost") + F.greatest(F.coalesce(self.bound, F.lit(0.0)), F.lit(0.0))
        limit = F.least("_best", "_known") * (1 + 1e-9)  # above any rounding; ways of equal cost may still have fewer segments
        useful = F.col("target").isNull() | F.least("_best", "_known").isNull() | (total <= limit)
        rated = met.filter(useful).groupBy(*rows.columns).agg(F.min(F.when(F.col("target").isNotNull(), total)).alias("_total"))
        first = rated.groupBy("source").agg((F.min("_total") + F.lit(self.step)).alias("_first"))
        rated = pin(rated.join(first, "source"))
        now = F.col("_total").isNull() | (F.col("_total") <= F.col("_first"))
        return rated.filter(now).select(rows.columns), rated.filter(~now).select(rows.columns)


def _connected(targets: DataFrame, edges: DataFrame) -> DataFrame:
    """The (source, node) rows whose two ends are in one part of the network."""
    part = components(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")))
    of_source = part.select(F.col("node").alias("source"), F.col("component").alias("_from"))
    of_node = part.select("node", F.col("component").alias("_to"))
    return lookup_join(lookup_join(targets, of_source, "source"), of_node, "node").filter("_from = _to").select("source", "node")


def shortest_paths(
    edges: DataFrame, pairs: DataFrame, max_rounds: int | None = None, with_path: bool = True,
    nodes: DataFrame | None = None, landmarks: DataFrame | None = None,
) -> DataFrame:
    """GRF-2/3: ``(src, dst, success, cost, num_segments, path)`` for each distinct pair.

    ``edges`` is ``(src, dst, weight)`` with weights of at least 0. All sources advance together, one
    hop per round: the rows improved in the last round meet the edges, and the cheapest way to each
    (source, node) is kept, fewest segments first among equals. A source stops spreading beyond the
    cost at which it has reached all its targets. A round writes only what it improved to the shared folder, so what is
    written grows with the improvements and not with rounds times state. Pairs whose ends are not connected at all are
    found after ``CONNECTED_AFTER`` rounds and not searched for any longer. Pairs without a way stay, with ``success`` false.

    With the places of the ``nodes`` or with a table of ``landmarks`` (:func:`landmark_table`), the search is directed: a
    source goes on from the rows that promise the cheapest ways first, and drops rows from which no target can be reached as
    cheaply as it was already. Costs are the same. For negative weights see :mod:`arterial.operators.bellman_ford`.
    """
    spark = edges.sparkSession
    pairs = pin(pairs.select("src", "dst").dropna().distinct())
    # a segment without a usable weight is no way
    weight = F.col("weight").cast("double")
    edges = pin(
        edges.filter((F.col("src") != F.col("dst")) & weight.isNotNull() & ~F.isnan(weight))
        .groupBy("src", "dst")
        .agg(F.min(F.col("weight").cast("double")).alias("weight"))
    )
    lowest = edges.agg(F.min("weight")).first()[0]
    if lowest is not None and lowest < 0:
        raise ValueError("edge weights must not be negative")
    # a target no edge leads to is out of reach
    entered = lookup_join(pairs.filter("src <> dst"), edges.select("dst").distinct(), "dst", "left_semi")
    targets = entered.unionByName(pairs.filter("src = dst"))
    targets = pin(targets.select(F.col("src").alias("source"), F.col("dst").alias("node")))
    wanted = targets.groupBy("source").agg(F.count("*").alias("_wanted"))
    steps = edges.select(F.col("src").alias("node"), F.col("dst").alias("_to"), "weight")
    goals = Goals(edges, targets, nodes, landmarks) if nodes is not None or landmarks is not None else None
    start = wanted.select(
        "source", F.col("source").alias("node"), F.lit(0.0).alias("cost"), F.lit(0).alias("hops"), F.col("source").alias("pred")
    )
    root = scratch_path(spark, "paths")
    start.write.parquet(f"{root}/round=0")
    number = 0
    waiting = None  # rows of a directed search that are not the most promising of their source
    while True:
        # all improvements so far: a place may have several, the cheapest counts
        state = spark.read.schema(start.schema).parquet(*[f"{root}/round={i}" for i in range(number + 1)])
        frontier = spark.read.schema(start.schema).parquet(f"{root}/round={number}")
        if waiting is not None:
            frontier = frontier.unionByName(waiting)
        if max_rounds is not None:
            frontier = frontier.filter(F.col("hops") < max_rounds)
        size = frontier.count()
        if size == 0:
            break
        if number == CONNECTED_AFTER:
            # ends in different parts of the network would keep their sources searching all of theirs
            targets = pin(_connected(targets, edges))
            wanted = targets.groupBy("source").agg(F.count("*").alias("_wanted"))
            frontier = lookup_join(frontier, wanted.select("source"), "source", "left_semi")
        if number:
            # once all targets of a source are reached, dearer rows cannot improve any of them
            cheapest = state.join(targets, ["source", "node"], "left_semi").groupBy("source", "node").agg(F.min("cost").alias("cost"))
            reached = cheapest.groupBy("source").agg(F.count("*").alias("_reached"), F.max("cost").alias("_limit"))
            done = reached.join(wanted, "source").filter(F.col("_reached") == F.col("_wanted"))
            frontier = lookup_join(frontier, done.select("source", "_limit"), "source", "left").filter(
                F.col("_limit").isNull() | (F.col("cost") < F.col("_limit"))
            ).drop("_limit")
        if goals:
            frontier, waiting = goals.promising(frontier, state)
        # many sources may stand at the same busy node
        if size > ROWS_PER_TASK:
            met = salted_join(frontier, steps, "node", ["source"])
        else:
            met = frontier.join(steps, "node")
        way = F.min(F.struct((F.col("cost") + F.col("weight")).alias("cost"), (F.col("hops") + 1).alias("hops"), F.col("node").alias("pred")))
        moved = met.groupBy("source", F.col("_to").alias("node")).agg(way.alias("way")).select("source", "node", "way.*")
        moved = pin(moved)
        # what is as good already stays; a small frontier is broadcast, so the state is read but not shuffled
        known = state.select("source", "node", F.col("cost").alias("_cost"), F.col("hops").alias("_hops"))
        on = (moved["source"] == known["source"]) & (moved["node"] == known["node"])
        better = (known["_cost"] < moved["cost"]) | ((known["_cost"] == moved["cost"]) & (known["_hops"] <= moved["hops"]))
        same = known.join(moved, on, "inner").where(better).select(known["source"].alias("source"), known["node"].alias("node")).distinct()
        number += 1
        moved.join(same, ["source", "node"], "left_anti").write.parquet(f"{root}/round={number}")
    best = F.min(F.struct("cost", "hops", "pred")).alias("way")
    state = pin(state.groupBy("source", "node").agg(best).select("source", "node", "way.*"))
    found = pairs.join(
        state.select(F.col("source").alias("src"), F.col("node").alias("dst"), "cost", "hops"),
        ["src", "dst"], "left",
    )
    out = found.select(
        "src", "dst", F.col("cost").isNotNull().alias("success"), "cost", F.col("hops").alias("num_segments")
    )
    return with_paths(out, state) if with_path else out


def with_paths(routes: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``path`` by following predecessors back from the targets, one segment per join.

    Only (source, target, node) moves along; each step's nodes are written as rows and gathered into paths at the end.
    """
    routes = pin(routes)
    count, longest = routes.agg(F.count("*"), F.max("num_segments")).first()
    back = state.select("source", "node", "pred")
    walk = routes.filter("success").select("src", "dst", F.col("num_segments").alias("left"), F.col("dst").alias("node"))
    steps = [walk]
    for step in range(longest or 0):
        moving = walk.filter("left > 0").withColumnRenamed("src", "source")
        side = F.broadcast(moving) if count <= BROADCAST_PAIRS else moving
        walk = back.join(side, ["source", "node"]).select(
            F.col("source").alias("src"), "dst", (F.col("left") - 1).alias("left"), F.col("pred").alias("node")
        )
        walk = pin(walk)
        steps.append(walk)
    nodes = steps[0]
    for more in steps[1:]:
        nodes = nodes.unionByName(more)
    place = F.struct("left", "node")
    paths = nodes.groupBy("src", "dst").agg(F.transform(F.array_sort(F.collect_list(place)), lambda p: p["node"]).alias("path"))
    return routes.join(paths, ["src", "dst"], "left")


def route_geometry(
    paths: DataFrame, nodes: DataFrame, key: list[str], rows_per_task: int | None = None
) -> DataFrame:
    """AGG-9/JON-6/ARR-1: ``(key, coordinates, distance_km, num_segments)`` of node paths."""
    stops = paths.select(*key, F.posexplode("path").alias("pos", "id"))
    placed = lookup_join(stops, nodes.select("id", "latitude", "longitude"), "id", "inner", rows_per_task)
    w = W.partitionBy(*key).orderBy("pos")  # one path, already an array
    leg = haversine(F.lag("latitude").over(w), F.lag("longitude").over(w), "latitude", "longitude")
    legs = placed.withColumn("_leg", leg)
    point = F.struct("pos", "latitude", "longitude")
    return legs.groupBy(*key).agg(
        F.transform(
            F.sort_array(F.collect_list(point)),
            lambda p: F.struct(p["latitude"].alias("latitude"), p["longitude"].alias("longitude")),
        ).alias("coordinates"),
        F.coalesce(F.sum("_leg"), F.lit(0.0)).alias("distance_km"),
        (F.count("*") - 1).cast("int").alias("num_segments"),
    )


def find_routes(
    requests: DataFrame, nodes: DataFrame, edges: DataFrame, algorithm: str = "astar", max_rounds: int | None = None
) -> DataFrame:
    """GRF-4: routes for ``(request_id, origin_lat, origin_lon, dest_lat, dest_lon)`` rows.

    Ends snap to their nearest nodes. The accepted algorithms all find cheapest ways with one batch search; "astar" directs it
    by the places of the nodes. Other names are refused. Unreachable requests stay, with ``success`` false.
    """
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm!r}, expected one of {ALGORITHMS}")
    requests = pin(requests)
    ends = [
        F.struct(F.lit(name).alias("end"), F.col(end + "_lat").alias("latitude"), F.col(end + "_lon").alias("longitude"))
        for end, name in (("origin", "src"), ("dest", "dst"))
    ]
    points = requests.select("request_id", F.explode(F.array(*ends)).alias("p")).select(
        F.struct("request_id", "p.end").alias("point_id"), "p.latitude", "p.longitude"
    )
    found = nearest_node(points, nodes)
    snapped = found.groupBy(F.col("point_id.request_id").alias("request_id")).agg(
        *[F.max(F.when(F.col("point_id.end") == name, F.col("node_id"))).alias(name) for name in ("src", "dst")]
    )
    snapped = pin(requests.join(snapped, "request_id", "left"))
    paths = pin(shortest_paths(known_edges(edges, nodes), snapped, max_rounds, nodes=nodes if algorithm == "astar" else None))
    shapes = route_geometry(paths.filter("success"), nodes, ["src", "dst"])
    routes = snapped.join(paths.drop("num_segments"), ["src", "dst"], "left").join(shapes, ["src", "dst"], "left")
    return routes.select(
        "request_id",
        F.coalesce("success", F.lit(False)).alias("success"),
        F.lit(algorithm).alias("algorithm"),
        "path", "coordinates", "distance_km", "num_segments", "cost",
        F.struct(F.col("origin_lat").alias("latitude"), F.col("origin_lon").alias("longitude")).alias("origin"),
        F.struct(F.col("dest_lat").alias("latitude"), F.col("dest_lon").alias("longitude")).alias("destination"),
    )


def propagate(
    edges: DataFrame, features: DataFrame, columns: list[str], hops: int = 1
) -> DataFrame:
    """GRF-6/JON-8: neighbourhood averages of ``features(id, columns...)`` along directed edges.

    Each node also sends to itself; a message weighs 1 / sqrt(deg(src) deg(dst)), where the degree
    counts incoming edges and the self-loop. Sums are combined before the shuffle.
    """
    loops = features.select(F.col("id").alias("src"), F.col("id").alias("dst"))
    arcs = known_edges(edges.select("src", "dst").filter(F.col("src") != F.col("dst")), features)
    arcs = pin(arcs.unionByName(loops))
    degree = arcs.groupBy("dst").agg(F.count("*").alias("_deg"))
    weighted = lookup_join(arcs, degree.select(F.col("dst").alias("src"), F.col("_deg").alias("_out")), "src")
    weighted = lookup_join(weighted, degree, "dst")
    weighted = pin(weighted.select("src", "dst", (1 / F.sqrt(F.col("_out") * F.col("_deg"))).alias("_w")))
    state = features.select(F.col("id").alias("src"), *[F.col(c).cast("double").alias(c) for c in columns])
    for _ in range(hops):
        sent = lookup_join(weighted, state, "src")
        sums = sent.groupBy("dst").agg(*[F.sum(F.col(c) * F.col("_w")).alias(c) for c in columns])
        state = sums.withColumnRenamed("dst", "src")
    return state.withColumnRenamed("src", "id")


def pool_features(features: DataFrame, columns: list[str], graph: str | None = None) -> DataFrame:
    """GRF-6: mean of the node features per graph, or over all nodes."""
    return features.groupBy(*([graph] if graph else [])).agg(*[F.avg(c).alias(c) for c in columns])


def travel_times(df: DataFrame) -> DataFrame:
    """GRF-7: ``distance_km`` and ``travel_time_minutes`` of origin-destination rows.

    Needs origin_lat, origin_lon, dest_lat, dest_lon and predicted_speed_kmh.
    """
    distance = haversine("origin_lat", "origin_lon", "dest_lat", "dest_lon")
    return df.withColumn("distance_km", distance).withColumn(
        "travel_time_minutes", travel_time_minutes(F.col("distance_km"), F.col("predicted_speed_kmh"))
    )
