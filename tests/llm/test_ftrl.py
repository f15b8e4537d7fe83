"""The learner against a plain version, whatever the number of partitions, and the bound of its sample."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from civiclake.llm import ftrl, toxicity
from civiclake.llm.toxicity import toxic_features
from tests.llm import data

MODEL = ftrl.Ftrl(bits=12, alpha=0.7, beta=1.0, l1=0.4, l2=0.2, rounds=3)


def plain(rows, model):
    """Weights by bucket from ``(order, text, label)`` in order."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= model.l1:
            return 0.0
        return -(z[i] - math.copysign(model.l1, z[i])) / ((model.beta + math.sqrt(n[i])) / model.alpha + model.l2)

    for _ in range(model.rounds):
        for _, text, label in rows:
            active = sorted({int(i) for i in toxic_features([text.encode()], model.bits)[0]})
            w = {i: weight(i) for i in active}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in active:
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(old)) / model.alpha * w[i]
    out = np.zeros(1 << model.bits)
    for i in z:
        out[i] = weight(i)
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_weights_against_plain_python(spark, parts):
    rng = random.Random(8)
    rows = [(i * 7919 % 10_007, data.text(rng, rng.choice(["en", "fr"]), rng.randint(1, 3)), float(i % 3 == 0)) for i in range(150)]
    frame = spark.createDataFrame(rows, "__order long, __text string, __label double").repartition(parts)
    got = ftrl.fit(frame, lambda texts: toxic_features(texts, MODEL.bits), MODEL)
    want = plain(sorted(rows), MODEL)
    assert np.abs(got - want).max() < 1e-5 and 50 < (got != 0).sum() < len(got)


def test_more_evidence_is_never_worth_less(spark):
    """A rare phrase passes the penalty by its own rows, however many others there are."""
    weights = []
    for others in (500, 4000):
        rows = [(i, f"plain words {i % 50} of text {i % 31}", 0.0) for i in range(others)] + [
            (others + i, f"plain vile words {i}", 1.0) for i in range(20)]
        random.Random(1).shuffle(rows)
        frame = spark.createDataFrame([(k, t, y) for k, (_, t, y) in enumerate(rows)], "__order long, __text string, __label double")
        model = toxicity.MODEL
        found = ftrl.fit(frame.repartition(3), lambda texts: toxic_features(texts, model.bits), model)
        weights.append(found[toxic_features([b"vile"], model.bits)[0][1:]].sum())
    assert weights[1] > 0.8 * weights[0] > 0


def test_the_sample_is_bounded_by_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {i % 400}") for i in range(2000)] + [(2, None), (3, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    sample = ftrl.labelled_sample(docs, labels, "toxic", F.lit(True), 100)
    assert sample.count() == 402  # rows of one id and text count once
    seen = []
    monkeypatch.setattr(ftrl, "_round", lambda rows, features, model, z, n: (seen.append(rows.count()), (z, n))[1])
    ftrl.fit(sample, lambda texts: toxic_features(texts, 10), ftrl.Ftrl(bits=10, max_rows=100, rounds=2))
    assert len(seen) == 2 and seen[0] == seen[1] and 60 < seen[0] < 150
