"""Aggregations over amendments, revenue and loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.brazil import PHASES
from ..functions.pairs import summary

TOTAL = "decimal(28,2)"
PHASE_COLUMNS = dict(zip(PHASES, ["empenho", "liquidacao", "pagamento"]))


def phase_sums(phase: Column, value: Column) -> list[Column]:
    """One conditional sum per budget phase: a pivot that needs a single shuffle."""
    return [
        F.coalesce(F.sum(F.when(phase == name, value)), F.lit(0)).cast(TOTAL).alias(f"valor_{column}")
        for name, column in PHASE_COLUMNS.items()
    ]


def execution_rollup(documents: DataFrame, key: str = "codigo_emenda", phase: str = "fase_documento",
                     value: str = "valor") -> DataFrame:
    """Per amendment: number of documents, total and payments."""
    return documents.groupBy(key).agg(
        F.count("*").alias("documentos"),
        F.sum(value).cast(TOTAL).alias("valor_total"),
        F.coalesce(F.sum(F.when(F.col(phase) == "Pagamento", F.col(value))), F.lit(0)).cast(TOTAL).alias("valor_pago"),
    )


def phase_pivot(documents: DataFrame, key: str = "codigo_emenda", phase: str = "fase_documento",
                value: str = "valor") -> DataFrame:
    """Per amendment: one column for each of the three phases."""
    return documents.groupBy(key).agg(*phase_sums(F.col(phase), F.col(value)))


def revenue_rollup(movements: DataFrame, levels: list[str], value: str, count: str | None = None) -> DataFrame:
    """Totals for every prefix of the hierarchy, grand total included.

    The finest groups are built first; only those few rows are expanded into the
    levels above.  ``count`` names a column of movement counts if the input is already
    summed up.
    """
    n = F.sum(count) if count else F.count(value)
    finest = movements.groupBy(*levels).agg(F.sum(value).alias("_v"), n.alias("_n"))
    return finest.rollup(*levels).agg(
        F.grouping_id().cast("bigint").alias("nivel"),
        F.sum("_v").cast(TOTAL).alias("valor"),
        F.sum("_n").cast("bigint").alias("movimentos"),
    )


def truncation_audit(rows: DataFrame, key: str, total: str, size: int) -> DataFrame:
    """Rows fetched per key against the total the source announced.

    ``truncated`` marks keys cut off exactly at a page boundary.
    """
    return rows.groupBy(key).agg(
        F.count("*").alias("fetched"), F.max(total).cast("bigint").alias("announced")
    ).select(
        key, "fetched", "announced",
        (F.col("fetched") >= F.col("announced")).alias("complete"),
        ((F.col("fetched") < F.col("announced")) & (F.col("fetched") % size == 0)).alias("truncated"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value, most frequent first; nulls are left out."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null and non-null count of every column, from one pass."""
    flat = df.agg(F.count("*").alias("_t"), *[F.count(F.col(c)).alias(c) for c in columns])
    return (
        flat.unpivot("_t", columns, "column_name", "non_null")
        .select("column_name", "non_null", (F.col("_t") - F.col("non_null")).alias("nulls"))
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of repeated keys, and of rows beyond the first of each key."""
    return duplicate_keys(df, keys).agg(
        F.count("*").alias("dup_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("extra_rows"),
    )


def short_key(c: Column) -> Column:
    """Long texts replaced by their SHA-256, so that grouping by them shuffles little.

    Digests carry a prefix that makes them longer than any text left as it is.
    """
    return F.when(F.length(c) > 64, F.concat(F.lit("sha256:"), F.sha2(c, 256))).otherwise(c)


def section_summary(sections: DataFrame, key: str, ok: str) -> DataFrame:
    """Processed, successful and failed sections per page, the rate and its grade."""
    return sections.groupBy(key).agg(
        F.count("*").alias("_n"), F.count_if(F.col(ok)).alias("_ok")
    ).select(key, summary(F.col("_n"), F.col("_ok")).alias("s")).select(key, "s.*")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
