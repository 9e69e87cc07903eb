"""Exact nearest neighbours on the sphere (JON-3, JON-4).

Nodes are sorted into cells of a grid over their bounding cube (unit-sphere coordinates, so poles and
the date line need no care); a cell with too many nodes is divided again. A point first meets the nodes
of the undivided cell it lies in, which bounds how far it has to look. Points then descend that
hierarchy as a series of equi-joins: at each level a point keeps only cells that can still hold one of
its k nearest nodes, judged by that bound and by the distances to the cells' bounding boxes. No point meets all
nodes of a crowded area, however the nodes are spread, and nothing is cut off that could matter.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arterial.functions.geo import EARTH_RADIUS_M, haversine
from arterial.operators.joins import lookup_join
from arterial.session import pin

LEAF_NODES = 64  # nodes a cell may hold undivided
MAX_LEVEL = 8  # 2 ** 24 cells along the bounding cube: millimetres within a city
_BITS = 3  # each level divides a cell by 8 along each axis
# Up to this number of cells, or of nodes, they are broadcast (about 100 bytes each).
BROADCAST_CELLS = 200_000
_SLACK = 5e-10  # 3 mm in units of the earth's radius: more than the rounding of ranked distances
_CELL = ["cx", "cy", "cz"]


def _xyz(lat: Column, lon: Column) -> dict[str, Column]:
    lat, lon = F.radians(lat), F.radians(lon)
    return {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}


def _box_distance(cell: Column, farthest: bool) -> Column:
    """Least or greatest straight-line distance from (px, py, pz) to the cell's bounding box."""
    total = F.lit(0.0)
    for axis in "xyz":
        p, low, high = F.col("p" + axis), cell[axis + "0"], cell[axis + "1"]
        gap = F.greatest(high - p, p - low) if farthest else F.greatest(low - p, p - high, F.lit(0.0))
        total = total + gap * gap
    return F.sqrt(total)


def _grid(low: dict, extent: float) -> dict[str, Column]:
    """Numbers of the finest cells of (x, y, z) along each axis of the cube."""
    scale = 2 ** (_BITS * MAX_LEVEL)
    return {"g" + a: F.floor((F.col(a) - low[a]) / extent * scale).cast("long") for a in "xyz"}


def _divide(nodes: DataFrame, broadcast_cells: int) -> tuple[list[DataFrame], DataFrame, list[int], int, Callable]:
    """Cells of each level, nodes packed per undivided cell, number of cells per level and of nodes, and ``own``.

    ``own(points)`` has a row for each level with undivided cells: the cell that (x, y, z) lies in, or the nearest along each axis.
    """
    low = nodes.agg(*[F.min(a).alias(a) for a in "xyz"], *[F.max(a).alias(a + "1") for a in "xyz"]).first()
    levels, sizes, leaves, depths, total = [], [], [], [], 0
    if low["x"] is None:
        return levels, None, sizes, total, None
    low = low.asDict()
    extent = max(low[a + "1"] - low[a] for a in "xyz") * (1 + 1e-9) + 1e-15
    active = nodes.withColumns(_grid(low, extent))
    for level in range(1, MAX_LEVEL + 1):
        shift = _BITS * (MAX_LEVEL - level)
        at_level = {"c" + a: F.shiftright("g" + a, shift) for a in "xyz"}
        active = active.withColumns(at_level)
        bounds = [F.min(a).alias(a + "0") for a in "xyz"] + [F.max(a).alias(a + "1") for a in "xyz"]
        cells = pin(active.groupBy(*_CELL).agg(F.count("*").alias("n"), *bounds))
        full = (F.col("n") > LEAF_NODES) if level < MAX_LEVEL else F.lit(False)
        cells = cells.withColumn("divided", full)
        count, divided, inside = cells.agg(F.count("*"), F.count_if("divided"), F.sum("n")).first()
        total = inside if level == 1 else total
        levels.append(cells)
        sizes.append(count)
        if divided < count:
            depths.append(level)
        flags = cells.select(*_CELL, "divided")
        if count <= broadcast_cells:
            marked = active.join(F.broadcast(flags), _CELL)
        else:
            marked = lookup_join(active, flags, _CELL)
        leaves.append(
            marked.filter(~F.col("divided")).select(F.lit(level).alias("level"), *_CELL, "id", "lat", "lon")
        )
        if divided == 0:
            break
        active = marked.filter("divided").drop("divided")
    stacked = leaves[0]
    for leaf in leaves[1:]:
        stacked = stacked.unionByName(leaf)
    packed = pin(stacked.groupBy("level", *_CELL).agg(F.collect_list(F.struct("id", "lat", "lon")).alias("nodes")))

    def own(points: DataFrame) -> DataFrame:
        inside = {a: F.least(F.greatest(F.col(a), F.lit(low[a])), F.lit(low[a + "1"])) for a in "xyz"}
        at = points.withColumns(inside).withColumns(_grid(low, extent))
        cells = [F.struct(F.lit(n).alias("level"), *[F.shiftright("g" + c[1], _BITS * (MAX_LEVEL - n)).alias(c) for c in _CELL]) for n in depths]
        return at.select(*points.columns, F.explode(F.array(*cells)).alias("_own")).select(*points.columns, "_own.*")

    return levels, packed, sizes, total, own


def knn_join(
    points: DataFrame,
    nodes: DataFrame,
    k: int = 1,
    radius_m: float | None = None,
    point_id: str = "point_id",
    node_id: str = "id",
    exclude_same_id: bool = False,
    broadcast_cells: int = BROADCAST_CELLS,
) -> DataFrame:
    """``(point_id, node_id, distance_m, rank)``: the k nearest nodes of each point.

    Both tables have ``latitude`` and ``longitude``; ids are unique. Distances are ranked in
    millimetres and ties go to the smaller node id. ``exclude_same_id`` skips a node with the id of the
    point.
    """
    wanted = k + 1 if exclude_same_id else k
    located = nodes.select(
        F.col(node_id).alias("id"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon")
    ).dropna()
    # of nodes at the same place only the smallest ids can be among the k nearest
    same_place = W.partitionBy("lat", "lon").orderBy("id")
    located = located.withColumn("_r", F.row_number().over(same_place)).filter(F.col("_r") <= wanted).drop("_r")
    located = pin(located.withColumns(_xyz(F.col("lat"), F.col("lon"))))
    base = points.select(
        F.col(point_id).alias("pid"), F.col("latitude").alias("plat"), F.col("longitude").alias("plon")
    ).dropna()
    # many points may stand at one place (fixed sensors report for years): search once per place
    places = base.select("plat", "plon").distinct().withColumn("place", F.monotonically_increasing_id())
    # every place starts at the root cell
    places = places.withColumns(
        {"level": F.lit(0), **{c: F.lit(0).cast("long") for c in _CELL}, "n": F.lit(0).cast("long"),
         "near": F.lit(0.0), "far": F.lit(0.0), "divided": F.lit(True)}
    )
    # each place meets many cells, so it takes more tasks than the bytes of the places suggest
    tasks = 2 * int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = pin(places)
    columns = ["place", "plat", "plon", "px", "py", "pz", "within"]
    levels, packed, sizes, total, own_cells = _divide(located, broadcast_cells)
    if not levels:
        return _rename(
            base.limit(0).select("pid", F.lit(None).cast(located.schema["id"].dataType).alias("id"),
                                 F.lit(0.0).alias("distance_m"), F.lit(0).alias("rank")), point_id, node_id)
    on_cell = ["level", *_CELL]
    # the nodes of its own cell bound how far a place has to look; where they are too few, boxes do below
    own = own_cells(places.select("place", "plat", "plon").withColumns(_xyz(F.col("plat"), F.col("plon"))))
    own = own.join(F.broadcast(packed), on_cell) if total <= broadcast_cells else lookup_join(own, packed, on_cell)
    metres = F.transform("nodes", lambda n: F.round(haversine("plat", "plon", n["lat"], n["lon"], EARTH_RADIUS_M), 3))
    bounds = own.select("place", F.get(F.array_sort(metres), F.lit(wanted - 1)).alias("within"))
    start = lookup_join(places, bounds, "place", "left").repartition(tasks, "place")
    start = start.withColumns({"p" + a: c for a, c in _xyz(F.col("plat"), F.col("plon")).items()})
    chord = 2 * F.sin(F.least(F.col("within") / EARTH_RADIUS_M, F.lit(math.pi)) / 2)
    reach = math.inf if radius_m is None else 2 * math.sin(min(radius_m / EARTH_RADIUS_M, math.pi) / 2)

    # the root is one row; the first level has at most 512 cells, deeper ones hang below their parents
    state = start
    for level, cells in enumerate(levels, start=1):
        entry = F.struct(*_CELL, "n", "divided", *[a + b for a in "xyz" for b in "01"])
        above = {c: F.shiftright(c, _BITS) if level > 1 else F.lit(0).cast("long") for c in _CELL}
        parents = (
            cells.groupBy(*[c.alias(name) for name, c in above.items()])
            .agg(F.collect_list(entry).alias("cells"))
            .withColumns({"level": F.lit(level - 1), "divided": F.lit(True)})
        )
        on = ["level", "divided", *_CELL]
        if sizes[level - 1] <= broadcast_cells:
            joined = state.join(F.broadcast(parents), on, "left")
        else:
            joined = lookup_join(state, parents, on, "left")
        # a cell with enough nodes of its own bounds the search before all its siblings are sorted
        enough = F.filter("cells", lambda c: c["n"] >= wanted)
        bound = F.array_min(F.transform(enough, lambda c: _box_distance(c, True)))
        bound = F.least(F.coalesce(chord, bound, F.lit(4.0)), F.lit(min(reach, 4.0))) + F.lit(_SLACK)
        # undivided cells have no children and stay as they are
        own = ["level", *_CELL, "n", "near", "far", "divided"]
        spread = joined.select(*columns, *own, "cells", bound.alias("_bound")).withColumn("cell", F.explode_outer("cells"))
        cell, child = F.col("cell"), F.col("cell").isNotNull()
        spread = spread.select(
            *columns,
            "_bound",
            child.alias("_child"),
            F.when(child, F.lit(level)).otherwise(F.col("level")).alias("level"),
            *[F.when(child, cell[c]).otherwise(F.col(c)).alias(c) for c in (*_CELL, "n", "divided")],
            F.when(child, _box_distance(cell, False)).otherwise(F.col("near")).alias("near"),
            F.when(child, _box_distance(cell, True)).otherwise(F.col("far")).alias("far"),
        )
        spread = spread.filter(~F.col("_child") | (F.col("near") <= F.col("_bound"))).drop("_bound", "_child")
        # the nearest cells that together hold enough nodes bound the search radius
        by_far = W.partitionBy("place").orderBy("far", "level", *_CELL)
        upto = F.sum("n").over(by_far.rowsBetween(W.unboundedPreceding, 0))
        bounded = spread.withColumn("_upto", upto)
        limit = F.min(F.when(F.col("_upto") >= wanted, F.col("far"))).over(W.partitionBy("place"))
        bounded = bounded.withColumn("_limit", limit)
        state = bounded.filter(
            F.col("_limit").isNull() | (F.col("near") <= F.col("_limit") + F.lit(_SLACK))
        ).drop("_upto", "_limit")
    if total <= broadcast_cells:
        matched = state.join(F.broadcast(packed), on_cell)
    else:
        matched = lookup_join(state, packed, on_cell)
    candidates = matched.select("place", "plat", "plon", "within", F.explode("nodes").alias("node")).select(
        "place", "plat", "plon", "within",
        F.col("node.id").alias("id"),
        haversine("plat", "plon", "node.lat", "node.lon", EARTH_RADIUS_M).alias("distance_m"),
    )
    candidates = candidates.filter(F.col("within").isNull() | (F.round("distance_m", 3) <= F.col("within"))).drop("within")
    if radius_m is not None:
        candidates = candidates.filter(F.col("distance_m") <= radius_m)
    nearest = W.partitionBy("place").orderBy(F.round("distance_m", 3), "id")
    ranked = candidates.withColumn("_r", F.row_number().over(nearest)).filter(F.col("_r") <= wanted)
    entry = F.struct(F.round("distance_m", 3).alias("mm"), "id", "distance_m")
    found = ranked.groupBy("place").agg(F.first("plat").alias("plat"), F.first("plon").alias("plon"), F.collect_list(entry).alias("near"))
    joined = lookup_join(base, found.drop("place"), ["plat", "plon"]).select("pid", "near")
    near = F.array_sort("near")
    if exclude_same_id:
        near = F.filter(near, lambda c: c["id"] != F.col("pid"))
    result = joined.select("pid", F.posexplode(F.slice(near, 1, k)).alias("_p", "n"))
    result = result.select("pid", F.col("n.id").alias("id"), F.col("n.distance_m").alias("distance_m"), (F.col("_p") + 1).alias("rank"))
    return _rename(result, point_id, node_id)


def _rename(df: DataFrame, point_id: str, node_id: str) -> DataFrame:
    node = node_id if node_id != point_id else node_id + "_node"
    return df.withColumnsRenamed({"pid": point_id, "id": node})


def nearest_node(points: DataFrame, nodes: DataFrame, point_id: str = "point_id") -> DataFrame:
    """JON-3: ``(point_id, node_id, distance_m)``."""
    found = knn_join(points, nodes.withColumnRenamed("id", "node_id"), 1, None, point_id, "node_id")
    return found.drop("rank")


def knn_graph(
    nodes: DataFrame, k: int = 5, radius_m: float = 1000.0, broadcast_cells: int = BROADCAST_CELLS
) -> DataFrame:
    """JON-4: directed edges ``(src, dst, distance_m, connection_type)`` to the k nearest within reach."""
    sides = nodes.withColumnRenamed("id", "src"), nodes.withColumnRenamed("id", "dst")
    found = knn_join(*sides, k, radius_m, "src", "dst", exclude_same_id=True, broadcast_cells=broadcast_cells)
    return found.select("src", "dst", "distance_m", F.lit(1.0).alias("connection_type"))
