"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is mapped to the number of set bits in each of 32 segments.  The Manhattan distance
of two such vectors is never above the Hamming distance of the fingerprints, so fingerprints within two
bits stand at most two steps apart on the grid of vectors, and then some vector is at most one step from
both.  The range join therefore meets at such vectors: a fingerprint that meets no other one there has no link.
The rest is verified exactly in the same way on the fingerprints themselves: two of them differ in at most two
bits if and only if some 64-bit word differs from each in at most one.  Members of a meeting place are linked
to its smallest member, a star, so that a group of any size gives as many edges as it has members.

Defined results: a null or empty text has fingerprint zero and links like any other; repeated rows each get
a row; null ids are ignored by ``component_id`` (null if a component has no other); extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .storage import discard, kept_rows, numbered, unpacked, written
from .tokens import with_text_columns

SHINGLE = 3
SEED = 42
SEGMENTS, SEGMENT_BITS = 32, 2

#: For each byte, its eight bits in the eight bytes of a 64-bit word.
_SPREAD = (
    (np.arange(256, dtype=np.uint64)[:, None] >> np.arange(8, dtype=np.uint64) & np.uint64(1))
    << (np.arange(8, dtype=np.uint64) * np.uint64(8))
).sum(axis=1, dtype=np.uint64)


def shingle_hashes(text: bytes) -> list[int]:
    """Hashes of all 3-word shingles of a lower-cased text, repeats included."""
    words = text.lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) < SHINGLE:
        return [xxhash.xxh64_intdigest(line, SEED)]
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = np.concatenate(([0], end[:-SHINGLE] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(start, end[SHINGLE - 1:].tolist())]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per run of hashes, the word of the bits that over half of them have."""
    out = np.zeros(len(counts), dtype=np.uint64)
    used = np.flatnonzero(counts)
    if not len(used):
        return out
    sizes = counts[used]
    # runs are cut into blocks of at most 255, whose sums fit in a byte
    blocks = -(-sizes // 255)
    first = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    offset = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    inner = np.arange(blocks.sum()) - np.repeat(first, blocks)
    block_start = np.repeat(offset, blocks) + inner * 255
    octets = hashes.view(np.uint8).reshape(-1, 8)
    word = np.zeros(len(used), dtype=np.uint64)
    for i in range(8):
        sums = np.add.reduceat(_SPREAD[octets[:, i]], block_start).view(np.uint8).reshape(-1, 8)
        totals = np.add.reduceat(sums.astype(np.int64), first, axis=0)
        for bit in range(8):
            word |= (2 * totals[:, bit] > sizes).astype(np.uint64) << np.uint64(8 * i + bit)
    out[used] = word
    return out


def fingerprints(texts: list[bytes]) -> np.ndarray:
    lists = [shingle_hashes(t) for t in texts]
    counts = np.array([len(x) for x in lists], dtype=np.int64)
    flat = np.fromiter((h for x in lists for h in x), dtype=np.uint64, count=int(counts.sum()))
    return majority_bits(flat, counts)


def with_fingerprint(documents: DataFrame, text: str = "text") -> DataFrame:
    """``(__row, __fp)`` with the fingerprint of every whole text as a signed long."""
    return with_text_columns(
        documents, text, T.StructType().add("__fp", T.LongType(), False),
        lambda texts: [pa.array(fingerprints(texts).view(np.int64))],
    )


def meeting_cells(fp: Column) -> Column:
    """The fingerprint's popcount vector and all vectors one step away, two bits a segment."""
    counts = [F.bit_count(F.shiftrightunsigned(fp, SEGMENT_BITS * i).bitwiseAND((1 << SEGMENT_BITS) - 1)).cast("long")
              for i in range(SEGMENTS)]
    cell = F.lit(0).cast("long")
    for i, c in enumerate(counts):
        cell = cell.bitwiseOR(F.shiftleft(c, 2 * i))
    steps = [F.lit(0).cast("long")]
    for i, c in enumerate(counts):
        # as a cell holds one vector, a step is an exclusive or of its old and new count
        down, up = (F.shiftleft(c.bitwiseXOR(c + s), 2 * i) for s in (-1, 1))
        steps += [F.when(c > 0, down), F.when(c < SEGMENT_BITS, up)]
    return F.transform(F.array_compact(F.array(*steps)), lambda s: s.bitwiseXOR(cell))


def one_bit_away(fp: Column) -> Column:
    """The fingerprint and every word that differs from it in one bit."""
    return F.transform(F.sequence(F.lit(-1), F.lit(63)), lambda i: F.when(i < 0, fp).otherwise(
        fp.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))


def _hubs(points: DataFrame) -> DataFrame:
    """Points that several fingerprints share, with the smallest of those."""
    return points.groupBy("at").agg(F.min("fp").alias("hub"), F.max("fp").alias("last")).filter("hub < last")


def meeting_words(points: DataFrame) -> DataFrame:
    """``(fp, at)``: the words one bit away at most from fingerprints of ``points (fp)`` that stand near another row on the grid.

    Two rows are within two bits of each other if and only if they share a word.
    """
    grid = points.select("fp", F.explode(meeting_cells(F.col("fp"))).alias("at"))
    several = grid.groupBy("at").count().filter("count > 1").select("at")
    # always merge joins, so that the plan (and what it moves) is the same at every size
    met = written(grid.join(several.hint("merge"), "at", "left_semi").select("fp").distinct(), "met")
    return met.select("fp", F.explode(one_bit_away(F.col("fp"))).alias("at"))


def near_links(distinct: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect all of ``distinct (fp)`` within two bits of each other, exactly."""
    exact = meeting_words(distinct)
    return exact.join(_hubs(exact).hint("merge"), "at").filter("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``(__rid, doc_id, fp, component_id)`` per row of documents; only these narrow rows are shuffled."""
    return near_rows(numbered(documents.select("doc_id", "text")))


def near_rows(frame: DataFrame) -> DataFrame:
    """``near_duplicates`` of rows ``(__rid, doc_id, text)`` that have their numbers."""
    rows = written(
        with_fingerprint(frame).select(
            "__row.__rid", "__row.doc_id", F.col("__fp").alias("fp")), "fingerprints")
    first = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = written(components(near_links(first.select("fp"))), "roots")
    named = first.join(roots, first.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = written(named.join(smallest, "root").select("fp", "root", "component_id"), "groups")
    discard(roots)
    return rows.join(groups, "fp").select("__rid", "doc_id", "fp", "root", "component_id")


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """One row of each component stays: that of the smallest id (null last), the first of repeated rows."""
    frame = kept_rows(documents, "simhash-documents")
    groups = near_rows(frame.select("__rid", "__row.doc_id", "__row.text")).select("__rid", "doc_id", "root")
    return drop_others(frame, groups).select(*unpacked(documents))


def drop_others(frame: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows ``(__rid, ...)`` of ``frame`` that are the first of their root in ``groups (__rid, doc_id, root)``."""
    rows = written(groups, "grouped")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__rid")
    first = rows.groupBy("root").agg(F.min(order)["__rid"].alias("stays"))
    others = written(rows.join(first, "root").filter("__rid <> stays").select("__rid"), "others")
    return frame.join(others.hint("merge"), "__rid", "left_anti")
