"""Connected components by contraction: no edge list, component or label ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arterial.session import pin


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); the component is its smallest node.

    Each round hooks every node to its smallest neighbour, shortens the resulting paths to their roots by pointer
    jumping, and contracts the graph to those roots. A root loses at least one neighbour per round, so the number of
    rounds grows with the logarithm of the graph; stars need one. Null ends and loops are ignored. Every round is
    written to the shared folder, which cuts lineage and survives lost executors. Joins meet hot nodes only against a
    table with one row per node, so adaptive execution can split them.
    """
    links = pin(_ordered(edges.select("a", "b")))
    rounds = []
    while True:
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        parents = pin(
            both.groupBy("node").agg(F.min("other").alias("lowest")).select("node", F.least("node", "lowest").alias("parent"))
        )
        while True:
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
            jumped = pin(parents.join(above, "parent").select("node", F.col("next").alias("parent"), (F.col("next") != F.col("parent")).alias("moved")))
            parents = jumped.select("node", "parent")
            if jumped.where("moved").isEmpty():
                break
        rounds.append(parents)
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("root_a"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("root_b"))
        links = pin(
            _ordered(links.join(of_a, "a").join(of_b, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
        )
        if links.isEmpty():
            break
    found = rounds[0].withColumnRenamed("parent", "component")
    for parents in rounds[1:]:
        later = parents.select(F.col("node").alias("component"), F.col("parent").alias("later"))
        found = found.join(later, "component", "left").select("node", F.coalesce("later", "component").alias("component"))
    return found


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
