"""Document fingerprints by locally consistent parsing.

A text is cut into phrases by deterministic coin tossing: equal neighbours are joined to runs, every symbol is compared with
the one before it and keeps the place and value of the lowest bit in which they differ, which after a few
rounds leaves six labels; a phrase begins at each local maximum of the labels.  A phrase's name is a hash of its symbols, and the
names are the symbols of the next level.  Where a phrase begins depends on a few symbols around it only, so equal
substrings share all phrases in their interior, wherever they stand.  The fingerprint keeps, for each of 128 classes of
names of the upper levels, eight bits of the smallest name.

Defined results: a null or empty text has the fingerprint of zeros, and two of those have likeness 1; a document that is alone is
its own next one; repeated ids are ordered by text, null ids come last; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import CHUNK_BYTES, scramble

LEVELS = 4
#: Levels whose names make the fingerprint: phrases of some 30 and some 100 bytes.
KEPT = (3, 4)
CLASSES = 128
_U = np.uint64
_POWER = np.multiply.accumulate(np.concatenate(([1], np.full(63, 0x9E3779B97F4A7C15, dtype=_U))).astype(_U))
_BYTE_NAME = scramble(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


def _toss(label: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing: place and value of the lowest bit that differs from the symbol before."""
    before = np.empty_like(label)
    before[:1], before[1:] = 0, label[:-1]
    differs = label ^ before
    one = label.dtype.type(1)
    place = np.bitwise_count((differs & (~differs + one)) - one)
    place[first] = 0
    return (place << np.uint8(1)) | ((label >> place.astype(label.dtype)) & one).astype(np.uint8)


def phrases(name: np.ndarray, first: np.ndarray, label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of the next level, and which begin a text.

    ``first`` marks the symbols that begin a text; ``label`` may give small numbers that tell symbols apart.
    """
    change = first.copy()
    change[1:] |= name[1:] != name[:-1]
    at = np.flatnonzero(change)
    run = np.diff(np.concatenate((at, [len(name)])))
    symbol = name[at]
    symbol = np.where(run > 1, scramble(symbol + run.astype(_U) * _U(0xD6E8FEB86659FD93)), symbol)
    first = first[at]
    coins = symbol if label is None else label[at]
    for _ in range(4 if label is None else 3):
        coins = _toss(coins, first)
    begins = first.copy()
    # the last symbol of a text has nothing after it, wherever the text stands among others
    highest = np.append((coins[:-1] > coins[1:]) | first[1:], True)
    begins[1:] |= highest[1:] & (coins[1:] > coins[:-1])
    start = np.flatnonzero(begins)
    length = np.diff(np.concatenate((start, [len(symbol)])))
    inner = np.arange(len(symbol)) - np.repeat(start, length)
    return scramble(np.add.reduceat(symbol * _POWER[np.minimum(inner, 63)], start) + length.astype(_U)), first[start]


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """One row of ``CLASSES`` bytes per text; zero stands for a class without names."""
    out = np.zeros((len(texts), CLASSES), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    there = np.flatnonzero(sizes)
    if not len(there):
        return out
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    first = np.zeros(len(data), dtype=bool)
    first[np.cumsum(sizes[there]) - sizes[there]] = True
    name, label, keys, values = _BYTE_NAME[data], data, [], []
    for level in range(1, LEVELS + 1):
        name, first = phrases(name, first, label)
        label = None
        if level in KEPT:
            h = scramble(name + _U(level))
            row = there[np.cumsum(first) - 1]
            keys.append(row * CLASSES + (h >> _U(57)).astype(np.int64))
            values.append(h & _U((1 << 57) - 1))
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.lexsort((value, key))
    key, value = key[order], value[order]
    least = np.concatenate(([True], key[1:] != key[:-1]))
    out.ravel()[key[least]] = (value[least] % _U(255) + _U(1)).astype(np.uint8)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of common names, row by row: equal classes among those used, less chance agreement."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    share = np.where(used > 0, same / np.maximum(used, 1), 1.0)
    return np.clip((share - 1 / 255) / (1 - 1 / 255), 0.0, 1.0)


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by the beginning of the next document."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _in_order(documents: DataFrame) -> DataFrame:
    """Rows ``(part, guest, id, text)`` such that each part, by itself, is a stretch of the descending order of ids.

    The last row of a part is a guest, the first document of the next part (after the last part, of the first), so every
    document stands before its next one.  Parts are cut at quantiles of the ids; one guest per part is looked up.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    edges = rows.agg(F.percentile_approx("id", shares, 10 * parts)).first()[0] or []
    edges = np.unique(np.array(edges, dtype=np.int64))

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        return pd.Series(len(edges) - np.searchsorted(edges, ids.to_numpy(), side="left"))

    dealt = rows.withColumn("part", part("id"))
    tops = [tuple(r) for r in dealt.groupBy("part").agg(F.max("id").alias("id")).orderBy("part").collect()]  # one row per part
    follows = [(tops[i][0], tops[(i + 1) % len(tops)][1]) for i in range(len(tops))]
    wanted = F.broadcast(spark.createDataFrame(follows, "part int, id long"))
    guests = rows.select("id", "text").join(wanted, "id").groupBy("part", "id").agg(F.max("text").alias("text"))
    return dealt.select("part", F.lit(0).alias("guest"), "id", "doc_id", "text").union(
        guests.select("part", F.lit(1), "id", F.lit(None).cast("long"), "text"))


def fingerprint_report(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document's."""
    if documents.schema["doc_id"].dataType.typeName() != "long":
        documents = documents.withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = _in_order(documents)
    dealt = rows.repartition("part").sortWithinPartitions("part", "guest", F.desc("id"), F.desc("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[bool]]]:
        """Slices of rows; the last row of each comes again as the first of the next one."""
        held: tuple[list, list[str], list[bool]] = ([], [], [])
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column("text").cast(pa.large_string())).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                stop = int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK_BYTES // 2, side="right"))
                stop = max(stop, at + 1)
                ids, texts, guest = (batch.column(c).slice(at, stop - at).to_pylist() for c in ("doc_id", "text", "guest"))
                held = (held[0] + ids, held[1] + texts, held[2] + [g == 1 for g in guest])
                yield held
                held, at = tuple(x[-1:] for x in held), stop

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for ids, texts, guest in pieces(batches):
            own = [i for i in range(len(ids) - 1) if not guest[i]]
            if not own:
                continue
            print_of = fingerprints([t.encode() for t in texts])
            changed = [edited(texts[i], texts[i + 1]).encode() for i in own]
            of_changed = fingerprints(changed)
            mine, following = print_of[own], print_of[np.array(own) + 1]
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[i] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in changed]),
                pa.array([r.tobytes().hex() for r in mine]), pa.array([r.tobytes().hex() for r in of_changed]),
                pa.array(likeness(mine, of_changed)), pa.array(likeness(mine, following)),
            ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return dealt.mapInArrow(
        report, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
