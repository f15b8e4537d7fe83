"""The near-copy stage of the pipeline against all pairs of shingle sets."""

import random

import corpus_pipeline
from tests.llm import data


def shingles(text, words=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def kept_rows(rows, least=0.8):
    """Numbers of the rows that stay."""
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            shared = len(x & y)
            if 5 * shared >= 4 * (len(x) + len(y) - shared):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {}
    for i, g in enumerate(group):
        key = (rows[i][0] is None, rows[i][0] or 0, i)
        first[g] = min(first.get(g, key), key)
    return sorted(k[2] for k in first.values())


def test_near_copies_of_similarity_four_fifths_go(spark):
    rng = random.Random(5)
    rows = []
    for base in range(25):
        words = data.sentence(rng, rng.choice(["en", "fr", "de"]), rng.randint(40, 300)).split()
        rows.append((len(rows), " ".join(words)))
        for edits in range(1, 6):  # similarities on both sides of the limit, chains among them
            words = list(words)
            for k in rng.sample(range(len(words)), min(edits, 1 + base % 5)):
                words[k] = f"w{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    rows += [(900, None), (901, ""), (902, "One two"), (903, "one  TWO"), (904, "one three"), (None, rows[0][1]), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = sorted((rows[i] for i in kept_rows(rows)), key=str)
    got = corpus_pipeline.dedup_documents(spark, docs, "")
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert 25 < len(want) < len(rows) - 30
