"""Equi-joins that keep their balance when a few keys hold much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def hot_keys(df: DataFrame, key: str, min_share: float = 0.01, fraction: float = 0.05) -> tuple[list, bool]:
    """Keys holding about ``min_share`` of the rows or more, and whether null is one of them.

    A frequent-items sketch over a sample of one column, merged map-side.  There can be no
    more than 1/min_share such keys, so the list is bounded whatever the data.  The list
    only steers how rows are spread; every row is joined whatever it says.
    """
    limit = max(1, int(1 / min_share))
    sample = df.select(key).sample(fraction, seed=17) if fraction < 1 else df.select(key)
    found = sample.agg(
        F.expr(f"approx_top_k(`{key}`, {limit}, {max(limit * 50, 1000)})").alias("top"),
        F.count("*").alias("n"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
    ).first()
    floor = max(2, min_share * found["n"])
    keys = [t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] >= floor]
    return keys, found["nulls"] >= floor


def skew_join(many: DataFrame, one: DataFrame, key: str, how: str = "inner", *,
              min_share: float | None = None, salts: int | None = None) -> DataFrame:
    """``many JOIN one ON key``, inner or left, with the key column merged.

    ``one`` is meant to be unique per key.  By default this is a plain join, whose hot
    partitions the adaptive planner splits.  With ``min_share``, keys of that share of the
    rows are sketched first (a job of its own): their rows are spread over ``salts`` tasks
    (by default as many as there are shuffle partitions), and only the few rows of ``one``
    that carry a hot key are repeated.  The salt is a hash of the row and its input
    partition, so copies of one row spread as well, and a retried task sends every row
    where the first attempt did.
    """
    hot, hot_null = hot_keys(many, key, min_share) if min_share else ([], False)
    if not hot and not (hot_null and how == "left"):
        return many.join(one, key, how)
    if salts is None:
        salts = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    hashable = [f.name for f in many.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = F.pmod(F.xxhash64(*hashable, F.spark_partition_id()), F.lit(salts)).cast("int")
    # null keys match nothing, so they may go anywhere
    salted = many.withColumn(SALT, F.when(is_hot | F.col(key).isNull(), spread).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = one.withColumn(SALT, F.explode(copies))
    return salted.join(repeated, [key, SALT], how).drop(SALT)
