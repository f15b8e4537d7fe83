"""Positions in sorted groups of any size, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

PART_BITS = 33


def positions(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``pos``, the place from 0 in its ``group`` under ``order``, and ``n``, the rows of the group.

    Rows are dealt by ranges of group and order, so a group of any size takes as many tasks as it needs; a row's place is
    that within its range plus the rows of the group in earlier ranges.  The window holds one row per group and range.
    Null is a group like any other.  The frame must not have columns named ``pos``, ``n``, ``__at``.
    """
    keys = [F.col(group).asc_nulls_first(), *order]
    dealt = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", PART_BITS)
    heads = dealt.groupBy(F.col(group).alias("__group"), part.alias("__part")).agg(
        F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    of_group = Window.partitionBy("__group")
    before = F.sum("__rows").over(of_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    heads = heads.select("__group", "__part", F.sum("__rows").over(of_group).alias("n"),
                         (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    placed = dealt.join(heads, F.col(group).eqNullSafe(F.col("__group")) & (part == F.col("__part")))
    return placed.select(*rows.columns, (F.col("__at") + F.col("__shift")).alias("pos"), "n")
