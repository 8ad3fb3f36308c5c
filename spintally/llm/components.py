"""Connected components of an edge list, by alternating large and small stars.

Every round hangs nodes onto smaller neighbours, in joins and minima over the
edges, which never grow in number. The edges that a round leaves are a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spintally.sources.scratch import kept


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node that it is linked with, from edges ``a``, ``b``."""
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = kept(edges.distinct(), "edges")
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        # Written, so that the join reads plain exchanges, and Spark can split a node of very many edges.
        least = kept(least.select(F.col("a").alias("node"), F.least("a", "least").alias("least")), "least")
        large = both.filter("b > a").join(least, F.col("a") == F.col("node"))
        edges = large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = edges.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "node")
        small = edges.join(least, F.col("a") == F.col("node"))
        moved = small.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b")
        edges = kept(moved.union(small.select("a", F.col("least").alias("b"))).distinct(), "small_stars")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs onto one other, which hangs onto none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.filter("up > 1 or (up = 1 and down = 1)").isEmpty()
