"""Silver kept up to date by the keys of new ingests only.

The table is partitioned by the year in the amendment code, which is part of the natural key, so a key never moves.  An update reads the
ingests that were published since the last one and the partitions of their years, keeps the newest load of each key, and replaces
just these partitions.  Each row carries the raw row it was made from, so ties are broken as a full rebuild breaks them, and
loads may come in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import valid_amendments
from ..session import scratch_path
from .silver import latest_documents, typed_documents
from .wap import INGEST, Ledger

YEAR, RAW = "ano_emenda", "_raw"


def update_silver(ledger: Ledger, table: str, schema: T.StructType | str, path: str) -> list[str]:
    """Bring the ingests of a raw table that main has since the last update into the Silver table at ``path``; the years that changed.

    An update that fails is made again as a whole by the next one, with the same result.
    """
    spark, reader = ledger.spark, f"silver:{path}"
    ingests, upto = ledger.news(table, reader)
    if not ingests:
        return []
    valid, _ = valid_amendments(ledger.read_ingests(table, schema, ingests).drop(INGEST))
    new = _kept(latest_documents(valid).withColumn(YEAR, F.substring("codigo_emenda", 1, 4)), scratch_path(spark, "silver-news"))
    years = sorted(r[0] for r in new.select(YEAR).distinct().collect())  # four digits each
    old = partitions(spark, path, years)
    if old is not None:
        new = new.unionByName(old.select(f"{RAW}.*", YEAR), allowMissingColumns=True)
    latest = latest_documents(new)
    raw = F.struct(*[F.col(c) for c in latest.columns if c != YEAR]).alias(RAW)
    typed = typed_documents(latest.withColumn(RAW, raw))
    typed.hint("rebalance", F.col(YEAR)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd").partitionBy(YEAR).parquet(path)
    ledger.tick_off(reader, upto)
    return years


def partitions(spark: SparkSession, path: str, years: list[str]) -> DataFrame | None:
    """The rows of some years; None before the first update."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return _read(spark, path).where(F.col(YEAR).isin(years))


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The typed table."""
    return _read(spark, path).drop(RAW, YEAR)


def _read(spark: SparkSession, path: str) -> DataFrame:
    """With the year as text: partition values are not guessed."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == YEAR else f for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
