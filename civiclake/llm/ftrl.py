"""Logistic regression over hashed features, trained with follow-the-regularised-leader updates.

The updates depend on each other, so a sample of at most ``max_rows`` labelled rows is gone through in one order, ``rounds`` times, by one
task: what a row teaches does not depend on the size of the corpus.  Everything before (finding the sample) and after (scoring) is spread
over the cluster.  State and weights have one or two numbers per bucket, a fixed size whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import discard, written
from .tokens import segment_sums, slices, with_text_columns

#: Distinct hashed features of some texts: flat bucket numbers and how many each text has.
Features = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Ftrl:
    """Step size ``alpha``, smoothing ``beta``, penalties ``l1`` and ``l2``; buckets are ``2 ** bits``.

    ``max_rows`` bounds the labelled sample.
    """

    bits: int = 20
    alpha: float = 0.05
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    rounds: int = 2
    max_rows: int = 40_000

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        pull = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, pull)

    def learn(self, z: np.ndarray, n: np.ndarray, active: np.ndarray, label: float) -> None:
        """One row: predict from the active coordinates, then move each at its own rate.

        Active coordinates have value one; coordinate 0 is the intercept and active in every row.
        """
        za, na = z[active], n[active]
        w = self.weights(za, na)
        gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        grown = na + gradient * gradient
        z[active] = za + gradient - (np.sqrt(grown) - np.sqrt(na)) / self.alpha * w
        n[active] = grown


def distinct_buckets(row: np.ndarray, hashes: np.ndarray, rows: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets per text, the intercept's bucket 0 among them."""
    bucket = np.uint64(1) + hashes % np.uint64((1 << bits) - 1)
    key = (row.astype(np.uint64) << np.uint64(bits)) | bucket
    key = np.sort(np.concatenate((key, np.arange(rows, dtype=np.uint64) << np.uint64(bits))))
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    counts = np.bincount((key >> np.uint64(bits)).astype(np.int64), minlength=rows)
    return (key & np.uint64((1 << bits) - 1)).astype(np.int32), counts


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, training: Column, max_rows: int
) -> DataFrame:
    """``(text, label, order)`` of about ``max_rows`` labelled training rows at most, drawn by id hash.

    A document with several label rows gets their majority (ties: 1); null ids and labels count for none; rows of one id and text count once.
    """
    known = (
        labels.filter(training & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg((F.avg(F.col(label)) >= 0.5).cast("double").alias("__label"))
    )
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    total = known.count()
    if total > max_rows:
        known = known.filter(F.pmod(order, F.lit(1_000_000)) < F.lit(max_rows * 1_000_000 // total))
    # at most about max_rows rows of two numbers
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("__text")).join(F.broadcast(known), "doc_id").select(
        "__text", "__label", order.alias("__order")
    ).dropDuplicates(["__order", "__text"])


#: Buckets whose state travels as one row.
PART = 1 << 16


def fit(sample: DataFrame, features: Features, model: Ftrl) -> np.ndarray:
    """Weights by bucket (float32).  An empty sample gives all zeros, a score of one half."""
    # texts are kept, their features are several times as large
    table = rows = written(sample, "sample", "zstd")
    total = table.count()
    if total > model.max_rows:  # ids with several texts
        share = F.pmod(F.xxhash64("__text", "__order"), F.lit(1_000_000))
        rows = rows.filter(share < F.lit(model.max_rows * 1_000_000 // total))
    z, n = np.zeros(1 << model.bits), np.zeros(1 << model.bits)
    for _ in range(model.rounds):
        z, n = _round(rows, features, model, z, n)
    discard(table)
    return model.weights(z, n).astype(np.float32)


def _round(rows: DataFrame, features: Features, model: Ftrl, z0: np.ndarray, n0: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The state after all rows, each seen once."""
    shared = rows.sparkSession.sparkContext.broadcast((z0, n0))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = (x.copy() for x in shared.value)
        for batch in batches:
            labels = batch.column("__label").to_numpy()
            for at, texts in slices(batch.column("__text")):
                active, counts = features(texts)
                ends = np.cumsum(counts)
                for i, end in enumerate(ends):
                    model.learn(z, n, active[end - counts[i]:end], labels[at + i])
        for at in range(0, len(z), PART):
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([z[at:at + PART].tobytes()]), pa.array([n[at:at + PART].tobytes()])], names=["at", "z", "n"])

    ordered = rows.repartition(1).sortWithinPartitions("__order", F.xxhash64("__text"))
    z, n = z0.copy(), n0.copy()
    for part in ordered.mapInArrow(train, "at int, z binary, n binary").collect():  # 16 bytes a bucket
        for state, data in ((z, part.z), (n, part.n)):
            state[part.at:part.at + PART] = np.frombuffer(data)
    shared.unpersist()
    return z, n


def scored(documents: DataFrame, weights: np.ndarray, features: Features) -> DataFrame:
    """``(__row, __score)``: the probability of label 1 of every whole text, a sparse dot product.

    Only the non-zero weights are broadcast, at most one per bucket.
    """
    used = np.flatnonzero(weights).astype(np.int32)
    shared = documents.sparkSession.sparkContext.broadcast((len(weights), used, weights[used]))

    def score(texts: list[bytes]) -> list[pa.Array]:
        size, index, value = shared.value
        table = np.zeros(size, dtype=np.float32)
        table[index] = value
        flat, counts = features(texts)
        margin = segment_sums(table[flat].astype(np.float64), counts)
        return [pa.array(1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))))]

    return with_text_columns(documents, "text", T.StructType().add("__score", T.DoubleType(), False), score)
