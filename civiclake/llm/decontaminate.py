"""Benchmark decontamination with suffix arrays over shards of the training documents.

Every task holds a shard of whole documents at a time, sorts the shard's suffixes by words and binary-searches
every suffix of the benchmark in it.  The array is sparse: it holds the suffixes that begin with the same few words as
some benchmark window, all others cannot match one.  Runs of neighbouring matches give the longest verbatim matches and
where they are.  Words are compared by 64-bit hashes.

The benchmark is broadcast in blocks of about ``BLOCK_BYTES`` of text, one pass over the documents for each.

Defined results: null and empty texts have no words and are never contaminated; a benchmark item without words
has no window; items of one id count once, a null id is an empty name; repeated rows are judged alike;
an empty benchmark leaves every document; extra columns are kept by ``decontaminated``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import written
from .tokens import NOT_ALNUM, list_array, scramble, with_text_columns, words_of

WINDOW = 13
BLOCK_BYTES = 4 << 20
#: A document is contaminated if at least one word in this many is hit.
HIT_SHARE = 20
_PREFIX = 4
_FILTER_BITS = 22
_U = np.uint64


def prefix_hashes(word: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each start."""
    out = np.zeros(len(start), dtype=_U)
    for i in range(length):
        out = out * _U(0x9E3779B97F4A7C15) + word[start + i]
    return scramble(out)


def _keys(word: np.ndarray, start: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Sortable byte strings of up to ``length`` words from each start; shorter ones end in zeros."""
    at = start[:, None] + np.arange(length)
    rows = np.where(np.arange(length) < left[:, None], word[np.minimum(at, len(word) - 1)], _U(0)) if len(word) else \
        np.zeros((len(start), length), dtype=_U)
    return np.ascontiguousarray(rows.astype(">u8")).view(f"S{8 * length}").ravel()


@dataclass
class TestSuffixes:
    """All windows of a block of benchmark items: their words, item and place, by window length."""

    names: list[str]
    item: np.ndarray
    place: np.ndarray
    length: np.ndarray
    keys: dict[int, np.ndarray]
    prefix: int
    prefixes: np.ndarray

    @classmethod
    def of(cls, names: list[str], texts: list[bytes]) -> TestSuffixes:
        words = words_of(texts, NOT_ALNUM)
        word, counts, first = words.hashes(), words.counts(), words.first()
        windows = np.where(counts >= WINDOW, counts - WINDOW + 1, np.minimum(counts, 1))
        item = np.repeat(np.arange(len(texts)), windows)
        place = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
        start, length = first[item] + place, np.minimum(counts[item], WINDOW)
        keys = {int(n): _keys(word, start[length == n], length[length == n], int(n)) for n in np.unique(length)}
        prefix = int(min(_PREFIX, length.min())) if len(length) else 0
        return cls(names, item, place, length, keys, prefix, np.unique(prefix_hashes(word, start, prefix)))


@dataclass
class Matches:
    """Occurrences of windows in a shard: position of the first word, index of the window."""

    at: np.ndarray
    window: np.ndarray


def search_shard(word: np.ndarray, left: np.ndarray, tests: TestSuffixes) -> Matches:
    """Sort the shard's suffixes that may match and binary-search every test suffix among them.

    ``word`` has the shard's words, ``left`` how many the document still has from each.
    """
    none = Matches(np.empty(0, np.int64), np.empty(0, np.int64))
    if not len(tests.item):
        return none
    start = np.flatnonzero(left >= tests.prefix)
    begins = prefix_hashes(word, start, tests.prefix)
    seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
    seen[tests.prefixes >> _U(64 - _FILTER_BITS)] = True
    maybe = seen[begins >> _U(64 - _FILTER_BITS)]
    start, begins = start[maybe], begins[maybe]
    found = np.searchsorted(tests.prefixes, begins)
    start = start[tests.prefixes[np.minimum(found, len(tests.prefixes) - 1)] == begins]
    if not len(start):
        return none
    depth = max(tests.keys)
    suffixes = _keys(word, start, left[start], depth)
    order = np.argsort(suffixes, kind="stable")
    suffixes, start = suffixes[order], start[order]
    at, window = [], []
    for length, keys in tests.keys.items():
        sorted_prefixes = suffixes if length == depth else np.ascontiguousarray(
            suffixes.view(np.uint8).reshape(len(suffixes), -1)[:, :8 * length]).view(f"S{8 * length}").ravel()
        low = np.searchsorted(sorted_prefixes, keys, side="left")
        times = np.searchsorted(sorted_prefixes, keys, side="right") - low
        hit = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
        at.append(start[hit])
        window.append(np.repeat(np.flatnonzero(tests.length == length), times))
    return Matches(np.concatenate(at), np.concatenate(window))


def _spans(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]


def shard_hits(texts: list[bytes], tests: TestSuffixes) -> list[pa.Array]:
    """Per text: number of words, hit spans as flat (begin, end) pairs, item names, longest match and its place."""
    words = words_of(texts, NOT_ALNUM)
    counts, first = words.counts(), words.first()
    word = words.hashes()
    left = first[words.row + 1] - np.arange(len(word))
    found = search_shard(word, left, tests)
    length = tests.length[found.window]
    change = np.zeros(len(word) + 1, dtype=np.int64)
    np.add.at(change, found.at, 1)
    np.add.at(change, found.at + length, -1)
    # a document's windows end within it, so spans of neighbours meet at most at the border
    covered = np.cumsum(change[:-1]) > 0
    begin, end = _spans(np.concatenate((covered, [False])))
    cut = np.unique(np.concatenate((begin, first[:-1][covered[np.minimum(first[:-1], max(len(word) - 1, 0))]
                                                      & (counts > 0)] if len(word) else begin[:0])))
    stop = np.minimum(end[np.searchsorted(end, cut, side="right")] if len(cut) else cut,
                      first[words.row[cut] + 1] if len(cut) else cut)
    row = words.row[cut] if len(cut) else cut
    flat = np.column_stack((cut - first[row], stop - first[row])).ravel().astype(np.int32)

    text, item, place = words.row[found.at], tests.item[found.window], tests.place[found.window]
    pair = np.unique(np.column_stack((text, item)), axis=0) if len(text) else np.empty((0, 2), np.int64)
    names = pa.array([tests.names[i] for i in pair[:, 1]], pa.string())
    name_ends = np.concatenate(([0], np.cumsum(np.bincount(pair[:, 0], minlength=len(texts))))).astype(np.int32)

    # neighbouring windows on one diagonal are one longer match
    order = np.lexsort((found.at, found.at - place, item))
    at, diagonal, of = found.at[order], (found.at - place)[order], item[order]
    new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(diagonal) != 0) | (np.diff(of) != 0)))[:len(at)]
    head = np.flatnonzero(new)
    run = np.diff(np.concatenate((head, [len(at)]))) + length[order][head] - 1
    longest, where = np.zeros(len(texts), np.int64), np.full(len(texts), -1, np.int64)
    best = np.lexsort((-at[head], run))
    owner = words.row[at[head][best]]
    longest[owner] = run[best]
    where[owner] = at[head][best] - first[owner]
    return [
        pa.array(counts.astype(np.int64)), list_array(flat, 2 * np.bincount(row, minlength=len(texts))),
        pa.ListArray.from_arrays(pa.array(name_ends), names), pa.array(longest), pa.array(where),
    ]


def _pass(tests: TestSuffixes, frame: DataFrame) -> Callable[[list[bytes]], list[pa.Array]]:
    shared = frame.sparkSession.sparkContext.broadcast(vars(tests))
    return lambda texts: shard_hits(texts, TestSuffixes(**shared.value))


def benchmark_blocks(benchmark: DataFrame) -> list[TestSuffixes]:
    """The benchmark in blocks of about ``BLOCK_BYTES``, each indexed on the driver."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = []
    for block in range(blocks):
        # a share of the items by hash, about BLOCK_BYTES of text
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        out.append(TestSuffixes.of([r.item for r in rows], [(r.text or "").encode() for r in rows]))
    return out


def with_hits(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(__row, __words, __hit, __items, __longest, __longest_at)`` for every document."""
    added = (
        T.StructType().add("__words", T.LongType()).add("__spans", T.ArrayType(T.IntegerType()))
        .add("__names", T.ArrayType(T.StringType())).add("__longest", T.LongType()).add("__longest_at", T.LongType())
    )
    blocks = benchmark_blocks(benchmark)
    rows = with_text_columns(documents, "text", added, _pass(blocks[0], documents))
    for tests in blocks[1:]:
        rows = written(rows, "decontaminate")
        rows = with_text_columns(rows, F.col("__row.text"), added, _pass(tests, documents)).select(
            F.col("__row.__row").alias("__row"), "__words",
            F.concat("__row.__spans", "__spans").alias("__spans"), F.concat("__row.__names", "__names").alias("__names"),
            F.when(F.col("__longest") > F.col("__row.__longest"), F.col("__longest_at"))
            .otherwise(F.col("__row.__longest_at")).alias("__longest_at"),
            F.greatest("__longest", "__row.__longest").alias("__longest"))
    names = F.array_sort(F.array_distinct("__names"))
    return rows.select("__row", "__words", _hit_words(F.col("__spans"), len(blocks)).alias("__hit"), names.alias("__items"),
                       "__longest", "__longest_at")


def _hit_words(spans: Column, blocks: int) -> Column:
    """Words in the spans; those of several blocks may overlap, so their positions are counted once."""
    pairs = F.when(F.size(spans) > 0, F.sequence(F.lit(0), (F.size(spans) / 2).cast("int") - 1)).otherwise(
        F.array().cast("array<int>"))
    if blocks == 1:
        return F.aggregate(pairs, F.lit(0).cast("long"), lambda total, i: total + (spans[2 * i + 1] - spans[2 * i]))
    places = F.transform(pairs, lambda i: F.sequence(spans[2 * i], spans[2 * i + 1] - 1))
    return F.size(F.array_distinct(F.flatten(places))).cast("long")


def contaminated(hit: Column, words: Column) -> Column:
    return (hit > 0) & (hit * HIT_SHARE >= words)


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Report per document, without its text."""
    rows = with_hits(documents.select("doc_id", "text"), benchmark)
    return rows.select(
        F.col("__row.doc_id").alias("doc_id"), F.col("__words").alias("n_words"), F.col("__hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"), F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        contaminated(F.col("__hit"), F.col("__words")).alias("contaminated"),
        F.col("__longest").alias("longest_match"), F.col("__longest_at").alias("longest_match_at"))


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    rows = with_hits(documents, benchmark).filter(~contaminated(F.col("__hit"), F.col("__words")))
    return rows.select(*[F.col("__row")[c].alias(c) for c in documents.columns])
