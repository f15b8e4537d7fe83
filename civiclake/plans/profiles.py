"""Column profiles that are stored per ingest and merged over a ref, so that a ref is profiled without reading its rows.

Counts merge exactly.  Distinct values are a HyperLogLog sketch and lengths of texts (values of numbers) a KLL sketch: opt-in estimates beside
the exact profiles of ``operators.profiling``, off by about ``1 / sqrt(2 ** LG_K)`` of the count and 1 % of the ranks.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.profiling import is_empty_token
from .compact import origins
from .wap import INGEST, MAIN, Ledger

PROFILES = "_profiles"
LG_K = 14
SCHEMA = "table_name string, column_name string, total bigint, nulls bigint, empty bigint, distinct binary, measures binary"


def column_profiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """``SCHEMA`` without the table: one row per column from one scan."""
    kinds = dict(df.dtypes)
    metrics = [F.count("*").alias("total")]
    for i, name in enumerate(columns):
        c, text = F.col(f"`{name}`"), kinds[name] == "string"
        empty = F.coalesce(is_empty_token(c), F.lit(False)) if text else F.lit(False)
        filled = F.when(c.isNotNull() & ~empty, c)
        measure = F.length(filled) if text else filled.try_cast("double") if _numeric(kinds[name]) else F.lit(None)
        metrics += [F.count_if(c.isNull()).alias(f"n{i}"), F.count_if(empty).alias(f"e{i}"),
                    F.hll_sketch_agg(filled.cast("string"), LG_K).alias(f"d{i}"),
                    F.kll_sketch_agg_double(measure.cast("double")).alias(f"m{i}")]
    rows = F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), "total", F.col(f"n{i}").alias("nulls"), F.col(f"e{i}").alias("empty"),
                 F.col(f"d{i}").alias("distinct"), F.col(f"m{i}").alias("measures")) for i, name in enumerate(columns)]))
    return df.agg(*metrics).select(rows)


def _numeric(kind: str) -> bool:
    return kind.startswith("decimal") or kind in ("tinyint", "smallint", "int", "bigint", "float", "double")


def write_profile(ledger: Ledger, table: str, schema, ingest: str, columns: list[str]) -> None:
    """Profile a written ingest; its folder has one small row per column."""
    rows = ledger.read_ingests(table, schema, [ingest]).drop(INGEST)
    profile = column_profiles(rows, columns).select(F.lit(table).alias("table_name"), "*")
    ledger.write(profile, f"{PROFILES}/{table}", ingest)


def ref_profile(ledger: Ledger, table: str, ref: str = MAIN, as_of: datetime | None = None) -> DataFrame:
    """Per column of a table as a ref shows it: ``column_name, valid, nulls, empty, pct_complete, distinct_estimate, median_estimate``.

    Only stored profiles are read; an ingest that has none is an error.  The median is that of text lengths or of numbers.
    """
    ids = origins(ledger, table, ledger.ingest_ids(table, ref, as_of))
    stored = ledger.spark.read.schema(SCHEMA).parquet(*[ledger.location(f"{PROFILES}/{table}", i) for i in ids]) if ids else (
        ledger.spark.createDataFrame([], SCHEMA))
    merged = stored.groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in ("total", "nulls", "empty")], F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("measures").alias("measures"))
    valid = F.col("total") - F.col("nulls") - F.col("empty")
    share = F.try_divide(valid.cast("decimal(20,0)") * 100, F.col("total").cast("decimal(20,0)"))
    return merged.select(
        "column_name", valid.alias("valid"), "nulls", "empty", F.round(share, 2).cast("decimal(5,2)").alias("pct_complete"),
        F.hll_sketch_estimate("distinct").alias("distinct_estimate"),
        F.when(F.kll_sketch_get_n_double("measures") > 0, F.kll_sketch_get_quantile_double("measures", F.lit(0.5))).alias("median_estimate"))
