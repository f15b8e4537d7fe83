"""Pairs of crowded candidate keys, without all pairs of a key.

Points of a key are compared with its smallest one first, which joins most of a group of copies.  What is left are keys with
points of several components, such as texts made from one template that are just not alike.  For those the exact prefix
filter finds the pairs: of two sets of Jaccard similarity ``least`` or more, the parts ``size - ceil(least * size) + 1`` that come first
in any common order share an element.  In the order taken here elements of a single component come first, which no pair
between components can share, then those of few points.  A text with enough parts of its own thus meets nobody, and others meet
by their rarest common parts.  No pair of the similarity is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, written

#: Parts before one in a text's order that are looked at to tell whether a pair has met already.
LOOK_BACK = 8


def hubs(grid: DataFrame) -> DataFrame:
    """Of ``grid (at, point)``: the keys of several points with the smallest of them."""
    return grid.groupBy("at").agg(F.min("point").alias("hub"), F.max("point").alias("last")).filter("hub < last").select("at", "hub")


def open_points(places: DataFrame, roots: DataFrame) -> DataFrame:
    """``(point, root)`` of the points in keys of ``places (at, point)`` that hold several components of ``roots (node, root)``."""
    named = places.join(roots.withColumnRenamed("node", "point").hint("merge"), "point", "left").select(
        "at", "point", F.coalesce("root", "point").alias("root"))
    several = named.groupBy("at").agg(F.min("root").alias("m"), F.max("root").alias("n")).filter("m < n").select("at")
    return named.join(several.hint("merge"), "at", "left_semi").select("point", "root").distinct()


def rare_pairs(points: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs ``(a, b)`` of different roots among ``points (point, root)`` that may have this similarity.

    ``sets`` has the ``shingles`` of every point.
    """
    held = written(sets.join(points.hint("merge"), "point").select("point", "root", "shingles"), "open-sets")
    parts = held.select("point", "root", F.size("shingles").alias("size"), F.explode("shingles").alias("s"))
    shared = parts.groupBy("s").agg(F.count("*").alias("df"), F.min("root").alias("m"), F.max("root").alias("n")).filter("m < n")
    ordered = parts.join(shared.select("s", "df").hint("merge"), "s").groupBy("point", "root", "size").agg(
        F.sort_array(F.collect_list(F.struct("df", "s"))).alias("parts"))  # the parts of one text
    alone = F.col("size") - F.size("parts")
    length = F.col("size") - F.ceil(F.col("size") * least - 1e-9) + 1
    heads = ordered.select("point", "root", "size", alone.alias("alone"), F.transform(
        F.slice("parts", F.lit(1), F.greatest(length - alone, F.lit(0)).cast("int")), lambda x: x["s"]).alias("head"))
    heads = heads.filter(F.size("head") > 0).select("point", "root", "size", "alone", F.explode(F.transform("head", lambda s, k: F.struct(
        s.alias("s"), k.alias("k"), F.slice("head", F.greatest(k - LOOK_BACK + 1, F.lit(1)), F.least(k, F.lit(LOOK_BACK))).alias("before")))).alias("x"))
    heads = written(heads.select("point", "root", "size", (F.col("alone") + F.col("x.k")).alias("at"), "x.s", "x.before"), "open-heads")
    discard(held)
    # what both hold from their first common part on must suffice
    ahead = 1 + F.least(F.col("a.size") - F.col("a.at") - 1, F.col("b.size") - F.col("b.at") - 1)
    enough = ahead >= F.ceil((F.col("a.size") + F.col("b.size")) * (least / (1 + least)) - 1e-9)
    alike = F.least("a.size", "b.size") >= F.greatest("a.size", "b.size") * least - 1e-9
    # a pair that shares a part shortly before has met there
    new = ~F.coalesce(F.arrays_overlap("a.before", "b.before"), F.lit(False))
    met = heads.alias("a").join(heads.alias("b").hint("merge"), (
        F.col("a.s") == F.col("b.s")) & (F.col("a.point") < F.col("b.point")) & (F.col("a.root") != F.col("b.root")) & alike & enough & new)
    return met.select(F.col("a.point").alias("a"), F.col("b.point").alias("b")).distinct()
