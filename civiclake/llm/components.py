"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the smallest node it reaches.

    Rounds grow with the logarithm of the longest chain.  Each round is a few joins and aggregations on
    the edges, whose hot nodes are combined before the shuffle or split by adaptive joins, and is written
    to the shared folder.  No part of a component is ever gathered in one place.
    """
    current = written(edges.filter("a <> b").distinct(), "edges")
    before = None
    while True:
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        step = written(_small_star(_large_star(current)).filter("a <> b").distinct(), "edges")
        discard(current)
        current = step
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
