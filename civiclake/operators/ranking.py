"""Ordered slices and top-k."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_root

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above this bit


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows under a total order: each task keeps its own best ``n``."""
    return df.orderBy(*order).limit(n)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows drawn by a keyed hash: the same rows every time, one small heap per task."""
    order = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(order, F.col(key)).limit(n)


def global_index(df: DataFrame, order: list[Column], index: str = "_index") -> DataFrame:
    """Zero-based position of every row under ``order``.

    Rows are range-sorted and checkpointed (ids taken from a recomputed sort could
    shift), the size of each sorted partition is read back, and the partition start is
    added to the position inside the partition.  No task holds more than its range.
    """
    spark = df.sparkSession
    shared_root(spark)
    ordered = df.orderBy(*order).checkpoint()
    located = ordered.withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", _ROW_BITS)
    sizes = {r["p"]: r["n"] for r in located.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return located.select(*df.columns, F.lit(0).cast("bigint").alias(index))
    counts = [sizes.get(p, 0) for p in range(max(sizes) + 1)]
    starts = [0, *accumulate(counts)][: len(counts)]
    start_of = F.get(F.lit(starts).cast("array<bigint>"), part.cast("int"))
    within = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return located.select(*df.columns, (start_of + within).alias(index))


def slice_by_rank(df: DataFrame, key: str, offset: int, size: int, ranges: int = 64) -> DataFrame:
    """Rows at positions ``offset .. offset+size-1`` when sorted by the unique, non-null ``key``.

    Rows are counted per key range (edges are estimated quantiles, so at most ``ranges``
    small numbers reach the driver); only the ranges that hold the slice are sorted, and
    rows without a key have no position.
    """
    keyed = df.where(F.col(key).isNotNull())
    shares = [i / ranges for i in range(1, ranges)]
    if isinstance(df.schema[key].dataType, T.NumericType):
        edges = keyed.agg(F.percentile_approx(key, shares, 10 * ranges)).first()[0] or []
    else:
        drawn = keyed.select(key).orderBy(F.xxhash64(key)).limit(10 * ranges).collect()
        edges = sorted(r[0] for r in drawn)[::10]
    edges = sorted(set(edges))
    if not edges:
        return keyed.orderBy(key).offset(offset).limit(size)
    kind = df.schema[key].dataType.simpleString()
    band = F.aggregate(F.lit(edges).cast(f"array<{kind}>"), F.lit(0), lambda n, e: n + (e <= F.col(key)).cast("int"))
    counts = dict(keyed.groupBy(band.alias("band")).agg(F.count("*")).collect())
    start, low, high, skipped = 0, None, None, 0
    for i in range(len(edges) + 1):
        n = counts.get(i, 0)
        if start + n > offset and start < offset + size and n:
            if low is None:
                low, skipped = i, start
            high = i
        start += n
    if low is None:
        return df.where(F.lit(False))
    inside = F.lit(True)
    if low > 0:
        inside = inside & (F.col(key) >= F.lit(edges[low - 1]))
    if high < len(edges):
        inside = inside & (F.col(key) < F.lit(edges[high]))
    return keyed.where(inside).orderBy(key).offset(offset - skipped).limit(size)
