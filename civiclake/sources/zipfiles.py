"""Archives as a data source with one partition per member.

The partitions are planned from the archives' central directories, a few bytes at the end of each file; a task then seeks to its
member and decompresses it as a stream.  So the members of a large archive are read side by side, and no archive
or member is ever in memory as a whole.  Archives must lie where every worker can open them by seeking: a mounted
folder, or a store that Arrow's file systems reach (``s3``, ``gs``, ``abfs``, ``hdfs``).
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "archive string, member string, line_no bigint, line string, error string"
_ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()), ("line_no", pa.int64()), ("line", pa.string()), ("error", pa.string())])
LINES_PER_BATCH = 20_000
#: Central directories that are read at a time.
DIRECTORIES_AT_ONCE = 16


def open_seekable(path: str):
    """A file by its Hadoop path, for reading anywhere in it."""
    if path.startswith("file:"):
        return open(re.sub(r"^file:/*", "/", path), "rb")
    if "://" not in path:
        return open(path, "rb")
    system, inner = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    return system.open_input_file(inner)


def records(stream, encoding: str, multi_line: bool) -> Iterator[str]:
    """Lines of a byte stream; ``multi_line`` keeps line feeds inside quotes in their record."""
    parts, open_quote = [], False
    for line in io.TextIOWrapper(stream, encoding=encoding, newline=""):
        parts.append(line)
        if multi_line and line.count('"') % 2:
            open_quote = not open_quote
        if not open_quote:
            yield "".join(parts).rstrip("\r\n")
            parts = []
    if parts:
        yield "".join(parts).rstrip("\r\n")


@dataclass
class Member(InputPartition):
    path: str
    member: str | None
    error: str | None = None


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"])
        self.encoding = options.get("encoding", "latin-1")
        self.multi_line = options.get("multiline", "false") == "true"

    def partitions(self) -> list[Member]:
        def members(path: str) -> list[Member]:
            try:
                with open_seekable(path) as file, zipfile.ZipFile(file) as archive:
                    return [Member(path, m.filename) for m in archive.infolist() if not m.is_dir()]
            except Exception as exc:  # noqa: BLE001 - any broken archive is a reject row
                return [Member(path, None, f"{type(exc).__name__}: {exc}")]

        with ThreadPoolExecutor(DIRECTORIES_AT_ONCE) as pool:
            return [m for found in pool.map(members, self.paths) for m in found]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        name = partition.path.rsplit("/", 1)[-1]

        def batch(numbers: list, lines: list, error: str | None = None) -> pa.RecordBatch:
            n = max(len(lines), 1) if error else len(lines)
            columns = [[name] * n, [partition.member] * n, numbers or [None] * n, lines or [None] * n, [error] * n]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

        if partition.error:
            yield batch([], [], partition.error)
            return
        numbers, lines = [], []
        try:
            with open_seekable(partition.path) as file, zipfile.ZipFile(file) as archive, archive.open(partition.member) as stream:
                for n, line in enumerate(records(stream, self.encoding, self.multi_line)):
                    if line:
                        numbers.append(n)
                        lines.append(line)
                    if len(lines) >= LINES_PER_BATCH:
                        yield batch(numbers, lines)
                        numbers, lines = [], []
        except Exception as exc:  # noqa: BLE001 - what was read before a broken place is kept, the place is a reject row
            if lines:
                yield batch(numbers, lines)
            yield batch([], [], f"{type(exc).__name__}: {exc}")
            return
        if lines:
            yield batch(numbers, lines)


class ZipMembers(DataSource):
    """``spark.read.format("zip_members")`` with the option ``paths`` (a JSON list), ``encoding`` and ``multiLine``."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def member_lines(spark: SparkSession, paths: list[str], encoding: str = "latin-1", multi_line: bool = False) -> DataFrame:
    """``(archive, member, line_no, line, error)``: filled lines of all members, numbered from 0; a broken archive is a row with its error."""
    spark.dataSource.register(ZipMembers)
    return spark.read.format("zip_members").option("paths", json.dumps(paths)).option("encoding", encoding).option(
        "multiLine", str(multi_line).lower()).load()
