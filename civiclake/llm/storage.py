"""Intermediate tables in the folder that every executor shares, and row numbers."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


_stages = threading.local()  # of the thread: tables of the stage at work, and of the one before


def written(frame: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``frame`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage at a table that survives lost executors, and gives the planner its true size.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    if hasattr(_stages, "now"):
        _stages.now.append(path)
    writer = frame.write.option("compression", codec) if codec else frame.write
    writer.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table._llm_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more: those that only tables written since were made from."""
    for table in tables:
        _delete(table.sparkSession, table._llm_path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def stage(spark: SparkSession) -> Iterator[None]:
    """One stage of several whose results are written before the next begins: the tables of the stage before are deleted."""
    for path in getattr(_stages, "before", ()):
        _delete(spark, path)
    _stages.before, _stages.now = [], []
    try:
        yield
    finally:
        _stages.before = _stages.now
        del _stages.now


def keep_stages() -> None:
    """Leave the tables of the last stage to those who read its result: what begins now is another run."""
    _stages.before = []


def numbered(documents: DataFrame) -> DataFrame:
    """``documents`` with ``__rid``, a number that tells repeated rows apart.

    For frames that are scanned once: how files are packed into tasks, and so the numbers, depends on the
    cores that a session has when it plans.  Whoever needs the numbers twice takes ``kept_rows``.
    """
    return documents.withColumn("__rid", F.monotonically_increasing_id())


def kept_rows(documents: DataFrame, name: str) -> DataFrame:
    """``(__rid, __row)``: every row as one struct, with a number; written once, so that all later scans see the same numbers.

    As a struct the columns keep clear of those that operators add, whatever their names.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("__row")
    return written(documents.select(F.monotonically_increasing_id().alias("__rid"), row), name, "zstd")



def unpacked(documents: DataFrame) -> list[Column]:
    """The columns of ``documents`` out of the rows of ``kept_rows``."""
    return [F.col("__row")[c].alias(c) for c in documents.columns]
