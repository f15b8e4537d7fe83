"""Near copies by MinHash bands, odd sketches and an exact check on whole shingle sets.

A text is the set of its runs of ``words`` words, A-Z lower-cased (a shorter one: of the whole).  Texts with equal sets are one point.
Of ``SAMPLES`` minima of a set, ``BANDS`` groups of ``BAND_ROWS`` make keys, in which two sets of similarity 0.85 fail to meet in
seven of a thousand million cases.  All minima are folded into an odd sketch: each, with its number, flips one of ``BITS`` bits.
Two minima that differ flip at most two bits apart, so the population count of the exclusive or of two sketches is at most
twice the number of differing minima.  Candidates of a higher count than similarity 0.85 gives in all but one of 10**9
cases are dropped unread; the others are confirmed on both whole sets.  Crowded keys are handled as in ``crowded``.

Defined results: texts without words (null, empty, blank) are linked with nothing; copies are linked whatever their number; a null id
is never the smallest of a component that has others; repeated rows each get a row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .crowded import hubs, open_points, rare_pairs
from .nearsets import shingle_sets, with_shingles
from .storage import discard, numbered, written
from .tokens import list_array, scramble, with_text_columns

WORDS, PERCENT = 5, 85
BANDS, BAND_ROWS = 32, 5
SAMPLES, BITS = 256, 1024
#: Sets that are sketched at a time.
SETS_AT_ONCE = 2048

_RNG = np.random.default_rng(12)
_FLIPS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2)
_FACTORS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def minima(flat: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``SAMPLES`` minima of each of some sets that follow each other, none of them empty."""
    out = np.empty((len(start), SAMPLES), np.uint64)
    for i in range(SAMPLES):
        out[:, i] = np.minimum.reduceat((flat ^ _FLIPS[i]) * _FACTORS[i], start)
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """One row of ``BITS / 64`` words per row of samples: the parity of how often each bit is chosen."""
    n = len(samples)
    bit = scramble(samples * _PLACE + np.arange(SAMPLES, dtype=np.uint64)) % np.uint64(BITS)
    at = (np.arange(n)[:, None] * BITS + bit.astype(np.int64)).ravel()
    odd = (np.bincount(at, minlength=n * BITS) & 1).astype(np.uint8).reshape(n, BITS)
    return np.packbits(odd, axis=1).view(np.int64)


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Two digests and the size of each set, band keys and odd sketch (flat; none of an empty set)."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    digests = np.zeros((2, len(sets)), np.uint64)
    keys, odd = [np.empty((0, BANDS), np.uint64)], [np.empty((0, BITS // 64), np.int64)]
    used = np.flatnonzero(sizes)
    for lo in range(0, len(used), SETS_AT_ONCE):
        some = used[lo:lo + SETS_AT_ONCE]
        flat = np.concatenate([sets[i] for i in some])
        start = np.cumsum(sizes[some]) - sizes[some]
        for k, salt in enumerate((_PLACE, _OTHER)):
            digests[k, some] = np.add.reduceat(scramble(flat ^ salt), start)
        found = minima(flat, start)
        key = np.empty((len(some), BANDS), np.uint64)
        for band in range(BANDS):
            total = np.full(len(some), band, np.uint64)
            for i in range(band * BAND_ROWS, (band + 1) * BAND_ROWS):
                total = scramble(total * _PLACE + found[:, i])
            key[:, band] = total
        keys.append(key)
        odd.append(odd_sketches(found))
    return digests[0], digests[1], sizes, np.concatenate(keys).ravel(), np.concatenate(odd).ravel()


def with_sketch(documents: DataFrame, words: int) -> DataFrame:
    """``(__rid, doc_id, d1, d2, size, bands, odd)`` of every whole text."""

    def compute(texts: list[bytes]) -> list[pa.Array]:
        d1, d2, sizes, keys, odd = sketches(shingle_sets(texts, words))
        there = (sizes > 0).astype(np.int64)
        return [pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(sizes),
                list_array(keys.view(np.int64), there * BANDS), list_array(odd, there * (BITS // 64))]

    longs = T.ArrayType(T.LongType())
    added = T.StructType().add("d1", T.LongType()).add("d2", T.LongType()).add("size", T.LongType()).add("bands", longs).add("odd", longs)
    return with_text_columns(documents.select("__rid", "doc_id", "text"), "text", added, compute).select(
        "__row.__rid", "__row.doc_id", "d1", "d2", "size", "bands", "odd")


def most_flips(percent: int, misses: float = 1e-9) -> int:
    """Bits in which the sketches of two sets of this similarity differ at most, but for a share of ``misses``."""
    p = 1 - percent / 100
    tail, m = 0.0, SAMPLES
    while m > 0:
        tail += math.comb(SAMPLES, m) * p ** m * (1 - p) ** (SAMPLES - m)
        if tail > misses:
            break
        m -= 1
    return 2 * m


def flips(x: Column, y: Column) -> Column:
    """Bits in which two sketches differ."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, n: s + n)


def likely(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The ``pairs (a, b)`` whose sizes and odd sketches allow the similarity."""
    for side in ("a", "b"):
        pairs = pairs.join(points.select(F.col("point").alias(side), F.col("size").alias(f"n{side}"), F.col("odd").alias(f"o{side}")).hint("merge"), side)
    sized = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return pairs.filter(sized & (flips(F.col("oa"), F.col("ob")) <= most_flips(percent))).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs (a, b)`` whose whole sets have the similarity."""
    a = sets.select(F.col("point").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("point").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").select(
        "a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("shared"), (F.size("x") + F.size("y")).cast("long").alias("held"))
    return both.filter(100 * F.col("shared") >= percent * (F.col("held") - F.col("shared"))).select("a", "b")


def near_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of documents."""
    frame = written(numbered(documents.select("doc_id", "text")), "odd-texts", "zstd")
    rows = written(with_sketch(frame, words), "odd-sketches")
    points = written(rows.filter("size > 0").groupBy("d1", "d2", "size").agg(
        F.min("__rid").alias("point"), F.min("doc_id").alias("first"), F.first("bands").alias("bands"), F.first("odd").alias("odd")), "odd-points")
    grid = points.select("point", F.explode("bands").alias("at"))
    # always merge joins, so that the plan (and what it moves) is the same at every size
    places = written(grid.join(hubs(grid).hint("merge"), "at"), "odd-places")
    star = places.filter("point <> hub").select(F.col("point").alias("a"), F.col("hub").alias("b")).distinct()
    met = places.select("point").distinct()
    sets = written(with_shingles(frame.join(met.hint("merge"), F.col("__rid") == F.col("point"), "left_semi").select(
        F.col("__rid").alias("digest"), "text"), words).withColumnRenamed("digest", "point"), "odd-sets")
    discard(frame)
    links = written(confirmed(likely(star, points, percent), sets, percent), "odd-links")
    crowd = written(open_points(places, components(links)), "odd-open")
    more = confirmed(likely(rare_pairs(crowd, sets, percent / 100), points, percent), sets, percent)
    more = written(more, "odd-more")
    discard(places, sets, crowd)
    roots = components(links.union(more))
    named = points.join(roots.withColumnRenamed("node", "point").hint("merge"), "point", "left").select(
        "d1", "d2", "size", "first", F.coalesce("root", "point").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = written(named.join(smallest.hint("merge"), "root").select("d1", "d2", "size", "component_id"), "odd-groups")
    discard(points, links, more)
    out = rows.select("doc_id", "d1", "d2", "size").join(groups.hint("merge"), ["d1", "d2", "size"], "left")
    own = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"))


def near_report(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id, kept``."""
    return near_components(documents).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
s AS (
  SELECT rid, doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(
    [array_to_string(words[i:i + {WORDS - 1}], ' ') FOR i IN range(1, greatest(len(words) - {WORDS - 1}, 1) + 1)]) END AS shingles FROM w),
e AS (SELECT rid, len(shingles) AS n, unnest(shingles) AS x FROM s),
l AS (
  SELECT a.rid AS a, b.rid AS b FROM e a JOIN e b ON a.x = b.x AND a.rid <> b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT rid, rid FROM s UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b),
c AS (SELECT r.a AS rid, min(s.doc_id) AS component_id FROM reach r JOIN s ON s.rid = r.b GROUP BY r.a)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, c.component_id, s.doc_id IS NOT DISTINCT FROM c.component_id AS kept
FROM s JOIN c ON c.rid = s.rid
"""
