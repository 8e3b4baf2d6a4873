"""Connected components of an edge table by alternating large and small stars.

Each round joins every node with the least of its neighbours, halving path
lengths or better, until every component is a star; all work is grouped minima and joins on a node, so a hub is
pre-aggregated and its join side can be split.  A round's edges are written to
the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import saved


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours point to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("n", F.least("n", "m").alias("m"))
    return (both.where("v > u").join(least, F.col("u") == F.col("n"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the least of them."""
    least = _least(edges)
    moved = edges.join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) for every node of ``pairs`` (a, b, both bigint): the least node reachable.

    Loops and repeated or reversed pairs are harmless; an empty table gives none.
    """
    edges = saved(pairs.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                  "component-edges")
    while True:
        # Stars only: every node points once, and none that others point to points on.
        per = edges.groupBy("u").count()
        astray = per.where("count > 1").select("u").unionByName(
            per.join(edges.select("v").distinct(), F.col("u") == F.col("v"), "left_semi").select("u"))
        if astray.isEmpty():
            break
        edges = saved(_small_star(_large_star(edges)), "component-edges")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
