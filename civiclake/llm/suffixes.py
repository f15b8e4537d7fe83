"""Removal of repeated 200-byte strings by blockwise suffix sorting with a periodic cover.

A string of ``LENGTH`` bytes is found by its anchor, the position in it whose ``GRAM`` bytes have the smallest hash (the last
of equal ones): equal strings have equal anchors at equal distances.  So

1. each document gives its anchors, with the interval of string starts that each is the anchor of, and a hash of the context,
   the bytes that these strings cover;
2. anchors whose bytes occur once are dropped (aggregation and join by hash);
3. equal contexts are repeated throughout and from here on count as one (aggregation and join by hash);
4. where an anchor has several different contexts, one document each hands them in, and they are dealt to suffix buckets
   by the anchor's bytes;
5. one bucket at a time is sorted: suffixes are ordered by their first bytes up to the next cover position, and ties by the
   precomputed rank of the suffix there.  Cover positions lie every ``PERIOD`` bytes from the anchor; as suffixes of one bucket
   that can be equal stand at equal distances from it, one shift serves every pair of them, and the ranks (by doubling, to
   256 bytes) end all ties;
6. neighbours in that order with equal strings are repeats, and the bytes that they cover are removed.

A task holds about ``CHUNK_BYTES`` of contexts, or a bucket, and sorts at most about ``SORTED_AT_ONCE`` suffixes at a time (those
at other distances from the anchor cannot be equal to them).  The strings of an anchor with more than ``HOT_CONTEXTS`` different
contexts are compared by an aggregation of their hashes instead.  Hashes of 64 bits decide equality in the end.

Defined results: a null text is an empty one; documents shorter than ``LENGTH`` bytes stay; repeated rows are separate documents, so
that each is removed as the other's repeat; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import numbered, written
from .tokens import CHUNK_BYTES, RollingHash, joined, scramble, slices

LENGTH, GRAM = 200, 40
PERIOD = 32
HOT_CONTEXTS = 50_000
SORTED_AT_ONCE = 1 << 20
#: Bits for a position; longer texts are taken in overlapping pieces of ``PIECE`` bytes.
_PLACE_BITS = 24
PIECE = 1 << 22
_U = np.uint64


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by block-wise running minima."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[:len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(text, anchor, lo, hi, gram, context)``: string starts ``lo`` to ``hi`` share an anchor; positions within the text.

    ``gram`` is the hash of the anchor's bytes, ``context`` that of the strings' bytes and their distance from the anchor.

    ``begin`` has the start of each text in ``data`` and the end, one separator after each text.
    """
    if len(data) < LENGTH:
        return tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, _U), np.empty(0, _U))
    hashed = RollingHash(data)
    gram = hashed.every(GRAM)
    place = np.arange(len(gram), dtype=_U)
    last = _U((1 << _PLACE_BITS) - 1)
    least = _sliding_least((gram & ~last) | (last - place), LENGTH - GRAM + 1)
    size = np.diff(begin) - 1
    starts = np.maximum(size - LENGTH + 1, 0)
    row = np.repeat(np.arange(len(size)), starts)
    start = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(starts) - starts, starts)
    anchor = (last - (least[start] & last)).astype(np.int64)
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])))[:len(row)]
    head = np.flatnonzero(new)
    tail = np.concatenate((head[1:] - 1, [len(row) - 1]))[:len(head)]
    row, anchor, lo, hi = row[head], anchor[head], start[head], start[tail]
    context = scramble(hashed.slices(lo, hi + LENGTH) + (anchor - lo).astype(_U))
    return row, anchor - begin[row], lo - begin[row], hi - begin[row], scramble(gram[anchor]), context


def anchors_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """``anchors`` of some texts, a long one in pieces that share no string start."""
    if len(texts) == 1 and len(texts[0]) > PIECE:
        parts = []
        for at in range(0, len(texts[0]) - LENGTH + 1, PIECE):
            row, anchor, lo, hi, gram, context = anchors(*joined([texts[0][at:at + PIECE + LENGTH - 1]]))
            parts.append((row, anchor + at, lo + at, hi + at, gram, context))
        return tuple(np.concatenate(x) for x in zip(*parts))
    return anchors(*joined(texts))


def anchor_rows(documents: DataFrame) -> DataFrame:
    """``(rid, place, gram, context)`` for all documents ``(__rid, text)``.

    ``place`` packs the anchor's position and its distances from the first and the last string start.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column(0).to_numpy()
            for at, texts in slices(batch.column(1)):
                row, anchor, lo, hi, gram, context = anchors_of(texts)
                if len(row):
                    place = (anchor << 16) | ((anchor - lo) << 8) | (anchor - hi)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rid[at + row]), pa.array(place), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64))],
                        names=["rid", "place", "gram", "context"])

    return documents.select("__rid", "text").mapInArrow(run, "rid long, place long, gram long, context long")


def _unpacked(place: int) -> tuple[int, int, int]:
    at = place >> 16
    return at, at - (place >> 8 & 255), at - (place & 255)


def _packed_texts(documents: DataFrame) -> DataFrame:
    """``(rid, packed)``: the texts compressed, for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor().compress
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array([squeeze(t) for t in texts], pa.binary())],
                                                 names=["rid", "packed"])

    return documents.select("__rid", "text").mapInArrow(run, "rid long, packed binary")


def _handed_in(batch: pa.RecordBatch, hot: bool) -> Iterator[tuple[int, bytes, int, int, int, int, bool]]:
    """Document, text, anchor, string starts, gram and whether it is repeated, of the marks that are hot or not."""
    expand = zstandard.ZstdDecompressor().decompress
    for i in range(batch.num_rows):
        marks = [m for m in batch.column("marks")[i].as_py() if m["hot"] == hot]
        if marks:
            rid, text = batch.column("rid")[i].as_py(), expand(batch.column("packed")[i].as_py())
            for m in marks:
                yield rid, text, *_unpacked(m["place"]), m["gram"], m["repeated"]


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["rid", "lo", "distance", "gram", "repeated", "context"]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
    for batch in batches:
        rows: list[tuple] = []
        for rid, text, at, lo, hi, gram, repeated in _handed_in(batch, hot=False):
            rows.append((rid, lo, at - lo, gram, repeated, text[lo:hi + LENGTH]))
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _hot_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rid, text, _, lo, hi, _, _ in _handed_in(batch, hot=True):
            string = RollingHash(np.frombuffer(text[lo:hi + LENGTH], dtype=np.uint8)).every(LENGTH)
            begin = np.arange(lo, hi + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rid] * len(begin), pa.int64()), pa.array(begin), pa.array(begin + np.int32(LENGTH)), pa.array(string.view(np.int64))],
                names=["rid", "begin", "end", "string"])


def cover_ranks(data: np.ndarray, base: np.ndarray, size: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks, in lexicographic order, of the suffixes at the cover positions of some contexts; where each context's begin.

    Cover positions of a context are all at a multiple of ``PERIOD`` from its anchor.  A suffix ends with its context.
    """
    offset = distance % PERIOD
    count = -(-(size - offset) // PERIOD)
    first = np.concatenate(([0], np.cumsum(count)))
    of = np.repeat(np.arange(len(base)), count)
    at = base[of] + offset[of] + PERIOD * (np.arange(len(of)) - first[of])
    reach = at[:, None] + np.arange(PERIOD)
    block = np.where(reach < (base + size)[of][:, None], data[np.minimum(reach, len(data) - 1)], np.uint8(0))
    block = np.ascontiguousarray(block).view(">u8").astype(_U)
    order = np.lexsort(block.T[::-1])
    ordered = block[order]
    rank = np.empty(len(of), np.int64)
    rank[order] = np.concatenate(([1], 1 + np.cumsum((ordered[1:] != ordered[:-1]).any(axis=1))))[:len(of)]
    step = 1
    while step * PERIOD < LENGTH:
        ahead = np.arange(len(of)) + step
        inside = ahead < first[of + 1]
        following = np.where(inside, rank[np.minimum(ahead, len(of) - 1)], 0)
        rank = 1 + np.unique(rank * (len(of) + 1) + following, return_inverse=True)[1]
        step *= 2
    return rank, first


def repeated_starts(contexts: list[bytes], distance: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """For different contexts, one flag per string start in them: does the string start in another one, too?

    Contexts of one bucket belong together.  The flags of all contexts follow each other.
    """
    size = np.array([len(c) for c in contexts], dtype=np.int64)
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    base = np.cumsum(size) - size
    rank, first = cover_ranks(data, base, size, distance)
    starts = size - LENGTH + 1
    flags_at = np.cumsum(starts) - starts
    hashed = RollingHash(data)
    out = np.zeros(int(starts.sum()), dtype=bool)
    width = LENGTH - GRAM + 1
    rounds = min(width, -(-len(out) // SORTED_AT_ONCE))
    for i in range(rounds):
        nearest, farthest = width * i // rounds, width * (i + 1) // rounds - 1
        begin = np.maximum(distance - farthest, 0)
        count = np.maximum(np.minimum(distance - nearest, starts - 1) - begin + 1, 0)
        of = np.repeat(np.arange(len(contexts)), count)
        inner = begin[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        at, left = base[of] + inner, distance[of] - inner
        shift = left % PERIOD
        head = scramble(hashed.slices(at, at + shift) + bucket[of].astype(_U) * _U(0x9E3779B97F4A7C15) + left.astype(_U))
        tie = rank[first[of] + (inner + shift - (distance % PERIOD)[of]) // PERIOD]
        order = np.lexsort((tie, head))
        whole = hashed.slices(at, at + LENGTH)[order]
        same = (whole[1:] == whole[:-1]) & (head[order][1:] == head[order][:-1])
        place = (flags_at[of] + inner)[order]
        out[place[1:][same]] = True
        out[place[:-1][same]] = True
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]


def bucket_spans(rows: pa.Table) -> pa.RecordBatch | None:
    """Spans ``(rid, begin, end)`` of repeated bytes from the different contexts of some whole buckets."""
    contexts, distance = rows.column("context").to_pylist(), rows.column("distance").to_numpy().astype(np.int64)
    bucket = rows.column("gram").to_numpy().view(_U)
    flags = repeated_starts(contexts, distance, bucket)
    found: list[tuple[int, int, int]] = []
    at = 0
    for rid, lo, repeated, context in zip(*[rows.column(c).to_pylist() for c in ("rid", "lo", "repeated")], contexts):
        n = len(context) - LENGTH + 1
        if not repeated:
            begin, end = _runs(flags[at:at + n])
            found += [(rid, lo + a, lo + b + LENGTH - 1) for a, b in zip(begin.tolist(), end.tolist())]
        at += n
    if not found:
        return None
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (pa.int64(), pa.int32(), pa.int32()))],
                                      names=["rid", "begin", "end"])


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive bucket by bucket; whole buckets of about ``CHUNK_BYTES`` in all are sorted at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at, limit = 0, CHUNK_BYTES
        lengths = np.cumsum(pc.binary_length(batch.column("context")).to_numpy(zero_copy_only=False).astype(np.int64))
        gram = batch.column("gram").to_numpy()
        ends = np.flatnonzero(gram[1:] != gram[:-1]) + 1
        if held and held[-1].column("gram")[-1].as_py() != gram[0]:
            ends = np.concatenate(([0], ends))
        for end in ends:
            now = size + int((lengths[end - 1] if end else 0) - (lengths[at - 1] if at else 0))
            if now >= limit:
                part = [*held, batch.slice(at, end - at)]
                if (out := bucket_spans(pa.Table.from_batches(part))) is not None:
                    yield out
                held, size, at = [], 0, int(end)
        if at < batch.num_rows:
            held.append(batch.slice(at))
            size += int(lengths[-1] - (lengths[at - 1] if at else 0))
    if held and (out := bucket_spans(pa.Table.from_batches(held))) is not None:
        yield out


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            text = np.frombuffer(expand(batch.column("packed")[i].as_py()), dtype=np.uint8)
            change = np.zeros(len(text) + 1, dtype=np.int32)
            for column in ("spans", "more"):
                pairs = np.array(batch.column(column)[i].as_py() or [], dtype=np.int64).reshape(-1, 2)
                np.add.at(change, pairs[:, 0], 1)
                np.add.at(change, pairs[:, 1], -1)
            gone = np.cumsum(change[:-1]) > 0
            out.append((batch.column("rid")[i].as_py(), int(gone.sum()), len(_runs(gone)[0]),
                        hashlib.sha256(text[~gone].tobytes()).hexdigest()))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             names=["rid", "n_removed", "n_spans", "kept_sha256"])


def _by_document(spans: DataFrame, name: str) -> DataFrame:
    return spans.groupBy("rid").agg(F.flatten(F.collect_list(F.array("begin", "end"))).alias(name))


def removals(documents: DataFrame) -> DataFrame:
    """``(rid, n_removed, n_spans, kept_sha256)`` of the documents ``(__rid, text)`` in which anything may be repeated."""
    spark = documents.sparkSession
    rows = anchor_rows(documents)
    several = written(rows.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "shared-grams")
    shared = written(rows.join(several, "gram"), "shared-anchors")
    different = written(shared.groupBy("gram", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "place")).alias("first")), "contexts")
    equal = shared.join(different.filter("n > 1").select("gram", "context"), ["gram", "context"])
    at = F.shiftright("place", 16).cast("int")
    begin = at - F.shiftright("place", 8).bitwiseAND(255).cast("int")
    end = at - F.col("place").bitwiseAND(255).cast("int") + LENGTH
    spans = _by_document(equal.select("rid", begin.alias("begin"), end.alias("end")), "spans")
    mixed = different.groupBy("gram").agg(F.count("*").alias("m")).filter("m > 1")
    mark = F.struct("first.place", "gram", (F.col("n") > 1).alias("repeated"), (F.col("m") > HOT_CONTEXTS).alias("hot"))
    marks = different.join(mixed, "gram").select(F.col("first.rid").alias("rid"), mark.alias("mark"))
    marks = marks.groupBy("rid").agg(F.collect_list("mark").alias("marks"))
    found = written(spans.join(marks, "rid", "full"), "found")

    # one shuffle of the texts: what follows reads them from buckets by document
    candidates = f"llm_candidates_{uuid.uuid4().hex}"
    _packed_texts(documents).join(found, "rid").write.bucketBy(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "rid").format("parquet").saveAsTable(candidates)
    table = spark.table(candidates)
    handed = table.filter("marks is not null").select("rid", "packed", "marks")
    dealt = handed.mapInArrow(_contexts, "rid long, lo int, distance int, gram long, repeated boolean, context binary")
    dealt = dealt.repartition("gram").sortWithinPartitions("gram")
    sorted_spans = dealt.mapInArrow(_sort_buckets, "rid long, begin int, end int")
    strings = handed.filter(F.exists("marks", lambda m: m["hot"])).mapInArrow(
        _hot_strings, "rid long, begin int, end int, string long")
    again = strings.groupBy("string").agg(F.count("*").alias("n")).filter("n > 1").select("string")
    hot_spans = strings.join(again, "string", "left_semi").select("rid", "begin", "end")
    more = _by_document(sorted_spans.union(hot_spans), "more")
    out = written(table.select("rid", "packed", "spans").join(more, "rid", "left").mapInArrow(
        _removed, "rid long, n_removed long, n_spans long, kept_sha256 string"), "removed")
    spark.sql(f"DROP TABLE {candidates}")
    return out


def removal_report(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    rows = written(numbered(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))), "suffix-documents")
    whole = rows.select("__rid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    return whole.join(removals(rows), F.col("__rid") == F.col("rid"), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
