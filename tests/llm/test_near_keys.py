"""The near-copy stage goes through SimHash fingerprints and their popcount grid."""

import random

import corpus_pipeline
import numpy as np
from civiclake.llm import nearsets
from tests.llm import data


def texts():
    rng = random.Random(31)
    rows = []
    for _ in range(12):
        words = data.sentence(rng, rng.choice(["en", "fr", "de"]), rng.randint(300, 900)).split()
        rows.append(" ".join(words))
        for _ in range(6):  # few changes in long texts: some within two bits, some not
            other = list(words)
            for k in rng.sample(range(len(words)), rng.randint(1, 3)):
                other[k] = f"w{rng.random()}"
            rows.append(" ".join(other))
    return rows + ["", "one two", "three"]


def test_points_within_two_bits_share_a_key(spark):
    sets = nearsets.shingle_sets([t.encode() for t in texts()])
    digest, sizes, prints, _, _ = nearsets.sketches(sets)
    for x, word in zip(sets, prints.tolist()):
        assert word == sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in x) > len(x))
    rows = list(zip(digest.view(np.int64).tolist(), sizes.tolist(), prints.view(np.int64).tolist()))
    found = {}
    for at, point in nearsets.simhash_keys(spark.createDataFrame(rows, "digest long, size long, fp long")).collect():
        found.setdefault(at, set()).add(point)
    used = [r for r in rows if r[1]]
    near = {(a[0], b[0]) for a in used for b in used if a[0] < b[0] and ((a[2] ^ b[2]) & (1 << 64) - 1).bit_count() <= 2}
    assert {(a, b) for held in found.values() for a in held for b in held if a < b} == near
    assert 10 < len(near) < len(used) * (len(used) - 1) // 20


def test_copies_within_two_bits_go_without_bands(spark, monkeypatch):
    monkeypatch.setattr(nearsets, "band_keys", lambda points: points.selectExpr("digest at", "digest point").limit(0))
    rows = list(enumerate(texts()))
    kept = corpus_pipeline.dedup_documents(spark, spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "").collect()
    assert 12 + 3 <= len(kept) < len(rows) - 10
