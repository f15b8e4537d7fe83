"""Quality and toxicity classifiers: held-out accuracy and awkward rows."""

import random

import pytest
from pyspark.sql import functions as F

from civiclake.llm import ftrl, quality, toxicity
from tests.llm import data


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(500):
        body, junk, toxic = data.text(rng, "en", 6), i % 4 == 0, i % 5 == 1
        if toxic:
            words = body.split(" ")
            words[len(words) // 2] = rng.choice(["idiot", "moron", "scum"])
            words[len(words) // 3] = rng.choice(["idiot", "moron", "scum"])
            body = " ".join(words)
        if junk:
            body = rng.choice([body.upper().replace(" ", "!! "), body.replace(" ", "$$$ "), " ".join(w for x in body.split() for w in [x] * 8)])
        rows.append((i, body, "en"))
        labels.append((i, int(not junk), int(toxic), "x"))
    labels += [(0, None, None, "x"), (None, 1, 1, "x"), (9999, 1, 0, "x"), (1, 1, 1, "y")]
    return (spark.createDataFrame(rows, "doc_id long, text string, score string").coalesce(2),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"))


@pytest.mark.parametrize("name,model,scores", [
    ("quality", quality.quality_model, quality.quality_scores), ("toxic", toxicity.toxicity_model, toxicity.toxicity_scores)])
def test_held_out_accuracy(labelled, name, model, scores):
    docs, labels = labelled
    weights = model(docs, labels, F.pmod(F.xxhash64("doc_id"), F.lit(5)) != 0)
    assert 0 < (weights != 0).sum() < len(weights) / 4
    out = scores(docs, weights).select("__row.doc_id", "__score")
    held = out.join(labels.filter("text = 'x'").dropna(), "doc_id").filter(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).collect()
    assert len(held) > 60
    assert sum((r["__score"] >= 0.5) == (r[name] == 1) for r in held) / len(held) > 0.9


def test_awkward_rows_and_tables(spark, labelled):
    docs, labels = labelled
    weights = quality.quality_model(docs, labels, F.lit(True))
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "a " * 100_000), (None, "x"), (4, "same"), (4, "same")], "doc_id long, text string")
    for got in (quality.quality_scores(rows, weights).collect(), toxicity.toxicity_scores(rows, weights).collect()):
        by = [(r["__row"].doc_id, r["__score"]) for r in got]
        assert len(by) == 6 and all(0 <= s <= 1 for _, s in by)
        assert dict(by[:2])[1] == dict(by[:2])[2] and by[4] == by[5]
    assert quality.quality_scores(rows.limit(0), weights).count() == 0
    nothing = quality.quality_model(docs, labels.limit(0), F.lit(True))
    assert not nothing.any()
    assert {r["__score"] for r in quality.quality_scores(rows, nothing).collect()} == {0.5}


def test_sample_is_bounded(labelled):
    docs, labels = labelled
    assert ftrl.labelled_sample(docs, labels, "quality", F.lit(True), 100).count() < 160
    assert ftrl.labelled_sample(docs, labels, "quality", F.lit(True), 10_000).count() == 500
