"""Connected components of a large graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.session import stage


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One step over edges (u, v) with u > v: neighbours meet at the least one. The minimum per node is
    summed up map-side and joined back, so a node with many neighbours is no group of one task."""
    sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else edges
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = sides.join(least, "u")
    if both_ways:  # larger neighbours go to the least neighbour
        out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # smaller neighbours, and the node, go to the least neighbour
        out = met.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge to a node that has none: then the edges are the classes."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter(
        "out > 1 OR (out = 1 AND into = 1)").isEmpty()


def components(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """(node, component) of all nodes on the edges (u, v); a component is named by its least node.

    Each round is written to the shared folder, by at most ``tasks`` tasks; there are about as many rounds as the
    logarithm of the longest chain.
    """
    now = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .filter("u != v").distinct(), "edges", tasks=tasks)
    while not _settled(now):
        now = stage(_star(_star(now, True), False), "edges", tasks=tasks)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
