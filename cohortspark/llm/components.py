"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _directed(edges: DataFrame) -> DataFrame:
    """Every edge from its greater end (``hi``) to its lesser one (``lo``), once."""
    return edges.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).filter("hi != lo").distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour that is greater than a node is tied to the least of the node and its neighbours. Edges may repeat."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are tied to the least of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    across = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return _directed(across.union(least.select("hi", "m")))


def _stars(edges: DataFrame) -> bool:
    """Whether every edge is a node's only one to a lesser end that has none itself."""
    chained = edges.select("hi").join(edges.select(F.col("lo").alias("hi")), "hi", "left_semi")
    forked = edges.groupBy("hi").agg(F.count("*").alias("n")).filter("n > 1").select("hi")
    return chained.union(forked).isEmpty()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (the least node that can be reached) of every node that has an edge.

    Each round is written to the shared folder, so that a lost executor costs a task, not the rounds before. A row
    with a null end or equal ends is no edge; repeated edges count once. No edge reaches the driver.
    """
    now = written(_directed(edges.select(F.col(a).alias("hi"), F.col(b).alias("lo"))), "edges")
    while not _stars(now):
        now = written(small_star(large_star(now)), "edges")
    nodes = now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return nodes.union(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
