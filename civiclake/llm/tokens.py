"""Whole texts as numpy arrays: words, their hashes, and row-aligned Arrow mapping.

Python tasks receive Arrow batches from Spark and work on slices of at most about
``CHUNK_BYTES`` of text, so a task's memory does not follow the batch.  A single longer text is
a slice of its own.  Texts are handled as UTF-8 bytes, nulls as empty texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 1 << 21

_BYTE = np.arange(256)
#: Bytes that separate words of ``[^\x20\x09-\x0D]+``.
SPACE = (_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D))
#: Bytes that separate words of letters, digits and anything beyond ASCII.
NOT_ALNUM = ~(((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A))
              | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80))
#: A-Z to a-z, every other byte as it is.
LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    """``base ** 0 .. size - 1`` modulo 2**64, kept for the next call."""
    held = _powers.get(base)
    if held is None or len(held) < size:
        held = np.full(max(size, CHUNK_BYTES + (1 << 16)), base, dtype=np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if size <= CHUNK_BYTES + (1 << 16):
            _powers[base] = held
    return held[:size]


def scramble(x: np.ndarray) -> np.ndarray:
    """Mix every bit of 64-bit words into every other."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


class RollingHash:
    """64-bit hashes of any slices of one byte string, each in constant time."""

    def __init__(self, data: np.ndarray):
        total = np.empty(len(data) + 1, dtype=np.uint64)
        total[0] = 0
        codes = _BYTE_CODE.take(data)
        codes *= _power_table(_BASE, len(data))
        np.cumsum(codes, out=total[1:])
        self._total = total
        self._shift = _power_table(_BASE_INVERSE, len(data) + 1)

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self._total[end] - self._total[start]) * self._shift[start])

    def every(self, length: int) -> np.ndarray:
        """Hashes of all slices of one length, by start."""
        n = len(self._total) - length
        return scramble((self._total[length:] - self._total[:n]) * self._shift[:n]) if n > 0 else np.empty(0, np.uint64)


@dataclass
class Words:
    """Words of some texts: ``start`` and ``end`` in ``data``, ``row`` of the text, words per text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    rows: int

    def hashes(self) -> np.ndarray:
        return RollingHash(self.data).slices(self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def first(self) -> np.ndarray:
        """Index of each text's first word (and, last, the number of words)."""
        return np.concatenate(([0], np.cumsum(self.counts())))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, a line feed after each, and where each begins (and, last, the total length)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    return data, np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))


def _translated(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The entry of a table of 256 one-byte values for each byte."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), table.dtype)


def words_of(texts: list[bytes], separators: np.ndarray = SPACE, lower: bool = True) -> Words:
    data, begin = joined(texts)
    if lower:
        data = _translated(data, LOWER)
    inside = np.concatenate(([False], _translated(data, ~separators), [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, begin)))
    return Words(data, start, end, row, len(texts))


def slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """``(first row, texts)`` over a text column, each slice within ``limit`` bytes if it has several rows."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at, n = 0, len(texts)
    while at < n:
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right"))
        stop = max(stop, at + 1)
        yield at, texts.slice(at, stop - at).to_pylist()
        at = stop


def with_text_columns(
    frame: DataFrame, text: str | Column, added: T.StructType, compute: Callable[[list[bytes]], list[pa.Array]],
    limit: int = CHUNK_BYTES,
) -> DataFrame:
    """``frame`` with columns computed from whole texts, slice by slice.

    Without clashes: the frame's own columns travel as one struct ``__row``; the result is that
    struct and the ``added`` columns.  ``compute`` gives one array per added column.
    """
    text = F.col(text) if isinstance(text, str) else text
    packed = frame.select(F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("__row"), text.alias("__text"))
    schema = T.StructType([packed.schema["__row"], *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in added.fields]
        for batch in batches:
            rows, column = batch.column(0), batch.column(1)
            for at, texts in slices(column, limit):
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(at, len(texts)), *compute(texts)], names=["__row", *names]
                )

    return packed.mapInArrow(run, schema)


def map_texts(
    frame: DataFrame, text: str | Column, schema: str, compute: Callable[[list[bytes]], list], limit: int = CHUNK_BYTES
) -> DataFrame:
    """Any number of rows from each slice of whole texts; ``compute`` gives the columns of ``schema``."""
    text = F.col(text) if isinstance(text, str) else text
    names = [f.name for f in T._parse_datatype_string(schema).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column(0), limit):
                columns = compute(texts)
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return frame.select(text.alias("__text")).mapInArrow(run, schema)


def list_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column from flat values and the length of each list."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values))


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each of some adjacent runs; an empty run has 0."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def text_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a document by id and text; rows alike in both are one document and share every decision."""
    return F.xxhash64(F.col(doc_id).cast("string"), F.col(text))
