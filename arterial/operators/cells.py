"""Costs from and to a few nodes of a large network, by cells of bounded size instead of rounds along its length."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arterial.operators.joins import lookup_join
from arterial.operators.ordering import ROWS_PER_TASK
from arterial.session import pin

CELL_NODES = 2_000  # a cell's costs are a matrix of this width: 32 MB
TASK_NODES = 16_000  # a few cells to a task: their bytes say little about their work
SHRINKS = 0.8  # a level that keeps more of its nodes than this does not pay


def cut(edges: DataFrame) -> DataFrame:
    """``(node, cell)``: the nodes of ``edges`` in the order of their ids, ``CELL_NODES`` to a cell."""
    nodes = pin(edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct())
    parts = -(-nodes.count() // ROWS_PER_TASK) or 1
    ranged = pin(nodes.repartitionByRange(parts, "node").withColumn("part", F.spark_partition_id().cast("long")))
    place = F.row_number().over(W.partitionBy("part").orderBy("node")) - 1  # a range of about ROWS_PER_TASK nodes
    return pin(ranged.select("node", (F.col("part") * 2**32 + F.floor(place / CELL_NODES)).cast("long").alias("cell")))


def placed(edges: DataFrame, cells: DataFrame) -> DataFrame:
    """The edges with the cells of both ends."""
    for end in ("src", "dst"):
        edges = lookup_join(edges, cells.withColumnsRenamed({"node": end, "cell": end + "_cell"}), end)
    return pin(edges)


def touching(edges: DataFrame, tasks: int) -> DataFrame:
    """The placed edges once per cell they touch."""
    return edges.withColumn("cell", F.explode(F.array_distinct(F.array("src_cell", "dst_cell")))).repartition(tasks, "cell")


def solved(touches: pd.DataFrame, landmarks: set) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple]]:
    """A cell's (node ids, those that stay, costs between the nodes, steps of the elimination).

    Nodes that no edge joins to other cells are taken out one by one, those with the fewest neighbours first; the costs of
    the ways over such a node go to its neighbours. A step is (node, neighbours at that time, costs from them, costs to them).
    """
    inside = ((touches["src_cell"] == touches["cell"]) & (touches["dst_cell"] == touches["cell"])).to_numpy()
    within, across = touches[inside], touches[~inside]
    out = across["src_cell"] == across["cell"]
    border = set(across["src"][out]) | set(across["dst"][~out])
    ids = np.sort(pd.unique(pd.concat([within["src"], within["dst"]])))
    stay = np.array([n in border or n in landmarks for n in ids], dtype=bool)
    src, dst = (pd.Index(ids).get_indexer(within[end]) for end in ("src", "dst"))
    costs = np.full((len(ids), len(ids)), np.inf)
    costs[src, dst] = within["weight"]
    linked = np.zeros(costs.shape, dtype=bool)
    linked[src, dst] = linked[dst, src] = True
    degree = np.where(stay, len(ids) + 1, linked.sum(axis=1))
    steps = []
    for _ in range(len(ids) - int(stay.sum())):
        k = int(np.argmin(degree))
        near = np.flatnonzero(linked[k])
        to, on = costs[near, k], costs[k, near]
        steps.append((k, near, to, on))
        block = np.ix_(near, near)
        costs[block] = np.minimum(costs[block], to[:, None] + on)
        costs[near, near] = np.inf  # no way leads back to its start
        linked[block] = True
        linked[near, near] = linked[near, k] = False
        degree[near] = np.where(stay[near], len(ids) + 1, linked[near].sum(axis=1))
        degree[k] = len(ids) + 1
    return ids, stay, costs, steps


def contract(edges: DataFrame, landmarks: Sequence, tasks: int) -> DataFrame:
    """``(src, dst, weight)`` between the nodes of placed ``edges`` that stay, with the same costs."""
    kept = set(landmarks)

    def between(touches: pd.DataFrame) -> pd.DataFrame:
        ids, stay, costs, _ = solved(touches, kept)
        ids, costs = ids[stay], costs[np.ix_(stay, stay)]
        needed = np.isfinite(costs)
        for k in range(len(ids)):  # a way over another node that stays needs no edge of its own
            to, on = costs[:, k, None], costs[k]
            needed &= ~((to > 0) & (on > 0) & np.isfinite(costs) & (to + on <= costs))
        src, dst = np.nonzero(needed)
        return pd.DataFrame({"src": ids[src], "dst": ids[dst], "weight": costs[src, dst]})

    schema = edges.select("src", "dst", "weight").schema
    inner = touching(edges, tasks).groupBy("cell").applyInPandas(between, schema)
    return inner.unionByName(edges.filter("src_cell <> dst_cell").select("src", "dst", "weight"))


def expand(edges: DataFrame, cells: DataFrame, costs: DataFrame, landmarks: Sequence, tasks: int) -> DataFrame:
    """``costs`` of the nodes that stay, and of all other nodes of the placed ``edges``.

    Costs are ``(node, from_landmarks, to_landmarks)`` with infinity where there is no way.
    """
    kept = set(landmarks)
    width = len(landmarks)
    names = ["from_landmarks", "to_landmarks"]

    def inner(touches: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        ids, stay, _, steps = solved(touches, kept) if len(touches) else ([], [], None, [])
        at = pd.Index(ids).get_indexer(known["node"]) if len(ids) else np.full(len(known), -1)
        here = at >= 0
        from_, to = (np.full((width, len(ids)), np.inf) for _ in names)
        for table, name in ((from_, names[0]), (to, names[1])):
            if here.any():
                table[:, at[here]] = np.stack(known[name][here].to_list()).T
        for k, near, there, back in reversed(steps):  # neighbours went later, so they are known by now
            from_[:, k] = np.min(from_[:, near] + there, axis=1, initial=np.inf)
            to[:, k] = np.min(to[:, near] + back, axis=1, initial=np.inf)
        gone = [k for k, *_ in steps]
        found = {"node": [ids[k] for k in gone], names[0]: list(from_[:, gone].T), names[1]: list(to[:, gone].T)}
        return pd.DataFrame(found, dtype=object)  # all nodes of a cell may stay, and pandas takes empty lists for numbers

    known = lookup_join(costs, cells, "node").repartition(tasks, "cell").groupBy("cell")
    found = touching(edges, tasks).groupBy("cell").cogroup(known).applyInPandas(inner, costs.schema)
    return pin(costs.unionByName(found))
