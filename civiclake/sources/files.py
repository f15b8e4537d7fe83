"""Readers and writers for landed files: JSON Lines, JSON arrays, CSV."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import layout_for, strings

RAW = "_raw"


#: What tells one landed file from another: a file that is landed again under its old name is another one.
FILE_ID = ["file_path", "file_size", "file_modification_time"]


def landed_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(path, *FILE_ID)`` of the files below a path or glob whose name matches the glob ``pattern``.

    Spark lists the folders, in parallel where there are many; no content is read.  A path without match is an error.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        files = reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no file matches {path}") from error
        raise
    return files.select("path", *[f"_metadata.{c}" for c in FILE_ID])


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> list[str]:
    """Paths of landed files; nothing found is an error."""
    found = sorted(r[0] for r in landed_files(spark, path, pattern).select("path").collect())
    if not found:
        raise FileNotFoundError(f"no file matches {path}" + (f" with a name like {pattern}" if pattern else ""))
    return found


def archive_files(spark: SparkSession, paths: list[str], archive_dir: str) -> None:
    """Move files below ``archive_dir``, where each keeps its whole path; a file that is gone already is passed over."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        source = hadoop.Path(path)
        fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
        target = hadoop.Path(f"{archive_dir.rstrip('/')}{source.toUri().getPath()}")
        fs.mkdirs(target.getParent())
        if fs.exists(source) and not fs.rename(source, target):
            fs.rename(source, hadoop.Path(f"{target}.{uuid.uuid4().hex}"))


def read_jsonl(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """JSON Lines as text columns; nested values keep their raw JSON text.

    A glob that matches nothing is an error (PATH_NOT_FOUND).
    """
    return spark.read.schema(strings(columns)).json(path)


def write_jsonl(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """JSON Lines; ``partition_by`` gives every value (a management unit, say) a folder of its own."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])  # few files per value, large values split
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def read_json_documents(spark: SparkSession, path: str, schema) -> DataFrame:
    """Files holding one JSON value each: an object, or an array giving a row per element."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """JSON documents holding arrays of rows: one document per task, written as a stream."""

    def to_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opener = "["
        for batch in batches:
            lines = []
            for item in batch["item"]:
                lines.append(opener + item)
                opener = ","
            yield pd.DataFrame({"line": lines})
        yield pd.DataFrame({"line": ["[]" if opener == "[" else "]"]})

    items = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("item"))
    items.mapInPandas(to_lines, "line string").write.mode("overwrite").text(path)


def read_csv_header(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return (
        spark.read.schema(strings(columns))
        .option("header", "true").option("enforceSchema", "false").option("escape", '"')
        .csv(path)
    )


def write_csv_header(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def field_count(raw: Column, separator: str = ";") -> Column:
    """Number of fields on a raw line, separators inside quotes not counted."""
    bare = F.regexp_replace(raw, '(?s)"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1


def read_layout_csv(
    spark: SparkSession,
    root: str,
    pattern: str,
    *,
    columns: list[str] | None = None,
    separator: str = ";",
    encoding: str = "ISO-8859-1",
    multi_line: bool = False,
    na_tokens: list[str] | None = None,
    files: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Headerless CSV files below ``root`` whose name matches ``pattern``, or just ``files``.

    Returns (rows, rejects); no matching file is an error.  Short lines are padded with
    null; lines with too many fields or with an open quote go to rejects with their raw
    text.  ``multi_line`` accepts line feeds inside quotes at the price of unsplittable files.  ``na_tokens`` turns the given
    tokens (``NA``, ``NULL`` ...) into null; by default raw text is kept.
    """
    columns = columns or layout_for(pattern)
    schema = strings([*columns, RAW])
    lines = (
        spark.read.schema(schema)
        .option("sep", separator).option("encoding", encoding).option("escape", '"')
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
        .option("multiLine", str(multi_line).lower()).option("columnPruning", "false")
        .csv(files or list_files(spark, root, pattern))
        .withColumn("_file", F.col("_metadata.file_name"))
    )
    # The raw text is set only for lines whose width differs, so counting fields is rare work.
    # (Spark wants a parsed column in every query on the raw text, hence the empty prefix.)
    line = F.coalesce(F.col(RAW), F.substring(columns[0], 1, 0), F.lit(""))
    too_long = F.when(F.col(RAW).isNull(), False).otherwise(field_count(line, separator) > len(columns))
    if not multi_line:
        # a quote that stays open takes in the rest of its line, the closing one begins a line of its own
        odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
        too_long = too_long | F.when(F.col(RAW).isNull(), False).otherwise(odd)
    rows = lines.where(~too_long).select(
        *[without_tokens(F.col(c), na_tokens).alias(c) for c in columns], "_file"
    )
    rejects = lines.where(too_long).select(line.alias("raw"), "_file")
    return rows, rejects


def without_tokens(c: Column, tokens: list[str] | None) -> Column:
    """Null for the tokens that stand for it."""
    return F.when(~c.isin(tokens), c) if tokens else c


def count_by_file(df: DataFrame, file_column: str = "_file") -> DataFrame:
    """Loaded rows per file."""
    return df.groupBy(F.col(file_column).alias("file_name")).agg(F.count("*").alias("rows"))


def write_table(df: DataFrame, path: str, *, partition_by: list[str] | None = None,
                sort_by: list[str] | None = None, mode: str = "overwrite",
                max_records_per_file: int | None = None) -> None:
    """Parquet with zstd; sorting is local to each task, so it needs no shuffle."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        # rows of one output folder must stay together for the dynamic-partition writer
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def write_colocated(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """A catalog table whose rows lie in buckets of ``key``, sorted: tables of as many buckets join and group on it without a shuffle.

    ``buckets`` is chosen once for the largest of the tables, some 256 MB a bucket.
    """
    writer = df.hint("rebalance", F.col(key)).write.mode("error").bucketBy(buckets, key).sortBy(key).option("compression", "zstd")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def create_table_if_missing(spark: SparkSession, name: str, columns: list[str], location: str) -> None:
    """Raw table contract registered in the catalog; a second call changes nothing."""
    fields = ", ".join(f"`{c}` STRING" for c in columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (data_extracao TIMESTAMP, {fields}) "
        f"USING parquet OPTIONS (compression 'zstd') LOCATION '{location}'"
    )
