"""Deduplication, set differences and snapshot comparison.

None of these collects a group: every step either combines on the map side or keeps
one row per key before the shuffle, so a key holding a third of the rows does no harm.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.schemas import LOAD_COLUMN


def dedupe_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key under ``order``.

    ``row_number = 1`` is planned with a group limit before the exchange: each map task
    sends at most one row per key.  ``order`` should end in a unique tie-break.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where("_rn = 1").drop("_rn")


def one_per_key(df: DataFrame, keys: list[str], load: str = LOAD_COLUMN) -> DataFrame:
    """One row per key: of the newest load if ``load`` is a column, of equal ones the first by all other columns."""
    newest = [F.col(load).desc_nulls_last()] if load in df.columns else []
    return dedupe_latest(df, keys, [*newest, *[F.col(f"`{c}`").asc_nulls_first() for c, kind in df.dtypes
                                         if c not in (*keys, load) and "map<" not in kind]])


def newest_load(df: DataFrame, key: str, load: str = LOAD_COLUMN) -> DataFrame:
    """All rows of each key's newest load; without a column ``load`` all rows.

    Registries are published whole, so what a key had in an earlier load and has no more is gone.
    """
    if load not in df.columns:
        return df
    rank = F.rank().over(Window.partitionBy(key).orderBy(F.col(load).desc_nulls_last()))
    return df.withColumn("_rk", rank).where("_rk = 1").drop("_rk")


def dedupe_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def _net(plus: DataFrame, minus: DataFrame) -> DataFrame:
    """Distinct rows of both frames with how often each side holds them (one shuffle)."""
    columns = plus.columns
    tagged = plus.select(*columns, F.lit(1).alias("_p"), F.lit(0).alias("_m")).unionByName(
        minus.select(*columns, F.lit(0).alias("_p"), F.lit(1).alias("_m"))
    )
    return tagged.groupBy(*columns).agg(F.sum("_p").alias("_p"), F.sum("_m").alias("_m"))


def batch_diff(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Distinct whole rows of ``current`` that ``previous`` lacks; nulls compare equal."""
    return _net(current, previous).where("_p > 0 AND _m = 0").drop("_p", "_m")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how many distinct rows differ in multiplicity, and whether none does."""
    differing = _net(a, b).where("_p <> _m")
    return differing.agg(F.count("*").alias("differing_rows")).withColumn("equal", F.col("differing_rows") == 0)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose rows differ between two states: added, removed or changed.

    Whole rows are counted per side with a map-side combined sum, then all of a key's rows:
    a key that both states hold is changed, however many of its rows are equal.
    """
    rows = _net(after, before)
    gained, lost = F.greatest(F.col("_p") - F.col("_m"), F.lit(0)), F.greatest(F.col("_m") - F.col("_p"), F.lit(0))
    return (
        rows.groupBy(*keys)
        .agg(
            F.sum("_m").alias("_old"), F.sum("_p").alias("_new"),
            F.sum(gained).cast("bigint").alias("rows_added"), F.sum(lost).cast("bigint").alias("rows_removed"),
        )
        .where("rows_added + rows_removed > 0")
        .select(
            *keys,
            F.when(F.col("_old") == 0, "added").when(F.col("_new") == 0, "removed").otherwise("changed").alias("change"),
            "rows_added",
            "rows_removed",
        )
    )


def union_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
