"""Near copies by shingle sets: SimHash and, beyond its reach, MinHash find candidates, exact Jaccard similarity decides.

A text is the set of its runs of ``words`` words, lower-cased (a shorter one: of the whole).  Texts with equal sets are one point.
Its SimHash fingerprint is placed on the grid of segment popcounts of ``simhash``; points within two bits are candidates, all of them.
Sets of similarity 0.8 differ in ten of 64 bits on average and in over twenty at times, a radius in which unrelated texts lie as
well and that no grid of popcounts parts.  So ``BANDS`` keys of ``BAND_ROWS`` minima each add the candidates that lie further apart:
they make two points of similarity 0.8 meet in all but three of a million cases.
Every candidate is verified on both whole sets.  Points of one key are first compared with its smallest one, so that a group of
any size gives as many pairs as it has members.  Where that leaves a key with points of several components, the exact prefix filter
of ``crowded`` finds what is left, so no pair that shares a key is left out and no key gives all its pairs.

Defined results: texts without words are alike; repeated rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .crowded import hubs, open_points, rare_pairs
from .simhash import drop_others, majority_bits, meeting_words
from .storage import discard, kept_rows, unpacked, written
from .tokens import list_array, scramble, with_text_columns, words_of

WORDS, LEAST = 5, 0.8
BANDS, BAND_ROWS = 32, 5

_RNG = np.random.default_rng(80)
_FLIPS = _RNG.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2)
_FACTORS = _RNG.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The distinct hashes of each text's shingles, in order."""
    found = words_of(texts)
    hashed, first = found.hashes(), found.first().tolist()
    out = []
    for a, b in zip(first, first[1:]):
        k = min(words, b - a)
        total = np.zeros(max(b - a - k + 1, 0) if k else 0, np.uint64)
        for i in range(k):
            total = scramble(total * _PLACE + hashed[a + i:a + i + len(total)])
        out.append(np.unique(total))
    return out


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digest, size and SimHash fingerprint of each set; its band keys, flat, and how many."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    digest = np.zeros(len(sets), np.uint64)
    used = np.flatnonzero(sizes)
    counts = np.where(sizes > 0, BANDS, 0)
    if not len(used):
        return digest, sizes, digest, np.empty(0, np.uint64), counts
    flat = np.concatenate(sets)
    start = (np.cumsum(sizes) - sizes)[used]
    digest[used] = np.add.reduceat(scramble(flat ^ _PLACE), start)
    keys = np.empty((len(used), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(used), band, np.uint64)
        for i in range(band * BAND_ROWS, (band + 1) * BAND_ROWS):
            key = scramble(key * _PLACE + np.minimum.reduceat((flat ^ _FLIPS[i]) * _FACTORS[i], start))
        keys[:, band] = key
    return digest, sizes, majority_bits(flat, sizes), keys.ravel(), counts


def with_sketch(documents: DataFrame, words: int) -> DataFrame:
    """``(__rid, doc_id, digest, size, fp, bands)`` of every whole text."""

    def compute(texts: list[bytes]) -> list[pa.Array]:
        digest, sizes, prints, keys, counts = sketches(shingle_sets(texts, words))
        return [pa.array(digest.view(np.int64)), pa.array(sizes), pa.array(prints.view(np.int64)), list_array(keys.view(np.int64), counts)]

    added = (T.StructType().add("digest", T.LongType()).add("size", T.LongType()).add("fp", T.LongType())
             .add("bands", T.ArrayType(T.LongType())))
    return with_text_columns(documents.select("__rid", "doc_id", "text"), "text", added, compute).select(
        "__row.__rid", "__row.doc_id", "digest", "size", "fp", "bands")


def simhash_keys(points: DataFrame) -> DataFrame:
    """``(at, point)``: the points ``(digest, size, fp)`` within two bits of another one, each pair of them under a common key."""
    used = points.filter("size > 0").select(F.col("digest").alias("point"), "fp")
    return meeting_words(used.select("fp")).join(used.hint("merge"), "fp").select("at", "point")


def band_keys(points: DataFrame) -> DataFrame:
    """``(at, point)``: the band keys of ``points (digest, bands)``."""
    return points.select(F.explode("bands").alias("at"), F.col("digest").alias("point"))


def with_shingles(texts: DataFrame, words: int) -> DataFrame:
    """``(digest, shingles)`` of ``texts (digest, text)``."""

    def compute(piece: list[bytes]) -> list[pa.Array]:
        sets = shingle_sets(piece, words)
        return [list_array(np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets]))]

    return with_text_columns(texts, "text", T.StructType().add("shingles", T.ArrayType(T.LongType())), compute).select(
        "__row.digest", "shingles")


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The ``pairs (a, b)`` whose sets have at least this Jaccard similarity."""
    a = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").select(
        "a", "b", F.size(F.array_intersect("x", "y")).alias("shared"), (F.size("x") + F.size("y")).alias("held"))
    return both.filter(F.col("shared") >= (F.col("held") - F.col("shared")) * least - 1e-9).select("a", "b")


def near_duplicates(frame: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """``(__rid, doc_id, root)`` per row of ``frame (__rid, doc_id, text)``: ``root`` names the component."""
    rows = written(with_sketch(frame, words), "sketches")
    points = written(rows.groupBy("digest").agg(
        F.min("__rid").alias("__rid"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "points")
    grid = simhash_keys(points).union(band_keys(points))
    # always merge joins, so that the plan (and what it moves) is the same at every size
    places = written(grid.join(hubs(grid).hint("merge"), "at"), "places")
    met = points.join(places.select(F.col("point").alias("digest")).distinct().hint("merge"), "digest", "left_semi").select("digest", "__rid")
    sets = written(with_shingles(frame.select("__rid", "text").join(met.hint("merge"), "__rid").select("digest", "text"), words), "shingles")
    discard(points)
    star = places.filter("point <> hub").select(F.col("point").alias("a"), F.col("hub").alias("b")).distinct()
    links = written(similar(star, sets, least), "links")
    crowd = written(open_points(places, components(links)), "open-points")
    more = written(similar(rare_pairs(crowd, sets.withColumnRenamed("digest", "point"), least), sets, least), "more-links")
    discard(places, sets, crowd)
    roots = written(components(links.union(more)), "roots")
    discard(links, more)
    named = roots.withColumnRenamed("node", "digest")
    return rows.join(named.hint("merge"), "digest", "left").select("__rid", "doc_id", F.coalesce("root", "digest").alias("root"))


def drop_near_duplicates(documents: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """One row of each component stays: that of the smallest id (null last), the first of repeated rows."""
    frame = kept_rows(documents, "near-documents")
    groups = near_duplicates(frame.select("__rid", "__row.doc_id", "__row.text"), words, least)
    return drop_others(frame, groups).select(*unpacked(documents))
