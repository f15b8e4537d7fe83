"""Bring a landed frame to the shape of its raw table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.schemas import LOAD_COLUMN

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def as_text(df: DataFrame) -> list[Column]:
    """Every column as text; nested values become JSON text with their nulls kept."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _NESTED):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        elif not isinstance(field.dataType, T.StringType):
            c = c.cast("string")
        out.append(c.alias(field.name))
    return out


def rename_coerce(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Rename by map (unknown names ignored), then everything to text."""
    return df.select(*as_text(df)).withColumnsRenamed(rename or {})


def stamp(df: DataFrame, load_ts: datetime | Column) -> DataFrame:
    """Load timestamp as first column: one value for the whole job."""
    value = load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    return df.select(value.cast("timestamp").alias(LOAD_COLUMN), "*")


def drop_all_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows in which every business column is null."""
    return df.na.drop("all", subset=columns)


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """Order columns by name for an append; absent ones become null, extra ones go."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def append_by_name(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """Frames in any column order as one frame in table order."""
    out = conform(frames[0], columns)
    for frame in frames[1:]:
        out = out.unionByName(conform(frame, columns))
    return out


def year_window(df: DataFrame, column: str, first: int, last: int, columns: list[str] | None = None) -> DataFrame:
    """Rows of a span of years with only the wanted columns.

    On a date or timestamp column this is a half-open range, which the scan can push
    down; on a year column it is a plain BETWEEN (and prunes partitions).
    """
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        kind = df.schema[column].dataType
        low, high = F.lit(f"{first:04d}-01-01").cast(kind), F.lit(f"{last + 1:04d}-01-01").cast(kind)
        kept = df.where((c >= low) & (c < high))
    elif isinstance(df.schema[column].dataType, T.StringType):
        kept = df.where(c.try_cast("int").between(first, last))
    else:
        kept = df.where(c.between(first, last))
    return kept.select(*columns) if columns else kept


def explode_rows(df: DataFrame, keep: list[str | Column], items: Column, name: str,
                 position: str | None = None) -> DataFrame:
    """One row per non-null element of a computed list.

    Plain ``explode`` makes the optimizer add a ``size(list) > 0`` filter underneath,
    which computes the list a second time; the outer form does not.
    """
    if position:
        rows = df.select(*keep, F.posexplode_outer(items).alias(position, name))
    else:
        rows = df.select(*keep, F.explode_outer(items).alias(name))
    return rows.where(F.col(name).isNotNull())
