"""Near copies by odd sketches against all pairs of shingle sets, and crowded keys."""

import random

import numpy as np
from pyspark.sql import functions as F

from civiclake.llm import crowded, oddsketch
from civiclake.llm.components import components
from tests.llm import data
from tests.llm.test_nearsets import shingles

SCHEMA = "doc_id long, text string, digest long, size long, bands int, point int, `first` string, at int"


def report(rows, percent=85):
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            shared = len(x & sets[j])
            if x and 100 * shared >= percent * (len(x) + len(sets[j]) - shared):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return sorted(((d, len(s), least.get(g), d == least.get(g)) for (d, _), s, g in zip(rows, sets, group)), key=str)


def edited(rng, words, edits):
    words = list(words)
    for k in rng.sample(range(len(words)), edits):
        words[k] = f"w{rng.random()}"
    return words


def cases(seed=9):
    rng = random.Random(seed)
    rows = []
    for base in range(20):
        words = data.sentence(rng, rng.choice(["en", "fr", "de"]), rng.randint(40, 300)).split()
        rows.append((len(rows), " ".join(words)))
        for _ in range(5):  # similarities on both sides of the limit, chains among them
            words = edited(rng, words, rng.randint(1, 1 + base % 4))
            rows.append((len(rows), " ".join(words)))
    template = data.sentence(rng, "en", 120).split()
    rows += [(1000 + i, " ".join(edited(rng, template, rng.randint(1, 5)))) for i in range(60)]
    rows += [(900, None), (901, ""), (902, "One two"), (903, "one  TWO"), (904, "one three"), (905, " \n\t"), (None, rows[0][1]),
             (None, "no one else"), (None, None), rows[3], rows[3], (-5, rows[7][1]), (906, data.sentence(rng, "en", 30_000)), (907, "é É")]
    return rows


def test_report_against_all_pairs(spark):
    rows = cases()
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, "x", 5) for r in rows], SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in oddsketch.near_report(docs).collect()), key=str)
    assert got == report(rows)
    assert 20 < sum(not r[3] for r in got) < len(rows) - 20


def test_empty_table(spark):
    assert oddsketch.near_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketches_estimate_high_similarities_and_never_part_links():
    rng = np.random.default_rng(1)
    limit = oddsketch.most_flips(85)
    whole = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    parts = []
    for share in (1.0, 0.97, 0.92, 0.85, 0.5, 0.2):
        fresh = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
        kept = int(4000 * 2 * share / (1 + share))
        parts.append(np.unique(np.concatenate((whole[:kept], fresh[kept:]))))
    *_, odd = oddsketch.sketches([np.unique(whole), *parts])
    odd = odd.view(np.uint64).reshape(-1, oddsketch.BITS // 64)
    apart = np.bitwise_count(odd[1:] ^ odd[0]).sum(axis=1)
    assert apart[0] == 0 and (apart[:4] <= limit).all() and (apart[4:] > limit).all() and (np.diff(apart.astype(int)) > 0).all()
    n, k = oddsketch.BITS, oddsketch.SAMPLES
    estimate = 1 + n / (4 * k) * np.log(1 - 2 * apart[:4] / n)
    assert np.abs(estimate - [1, 0.97, 0.92, 0.85]).max() < 0.08


def test_crowded_keys_do_not_give_all_pairs(spark):
    """Texts of one template that are just not alike: candidates follow the number of texts, and no link is lost."""
    rng = random.Random(2)
    counts = []
    for size in (100, 200, 400):
        template = [f"t{i}" for i in range(140)]
        rows = [(i, " ".join(edited(rng, template, 3))) for i in range(size)]
        rows += [(size + i, " ".join(edited(rng, rows[i][1].split(), 1))) for i in range(0, size, 10)]
        sets = [sorted(hash(x) for x in shingles(t)) for _, t in rows]
        frame = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "point long, shingles array<long>")
        places = frame.select("point", F.lit(1).alias("at"))
        alone = components(spark.createDataFrame([], "a long, b long"))
        pairs = crowded.rare_pairs(crowded.open_points(places, alone), frame, 0.85)
        found = {tuple(r) for r in pairs.collect()}
        linked = {(i, j) for j in range(len(sets)) for i in range(j)
                  if 100 * len(set(sets[i]) & set(sets[j])) >= 85 * len(set(sets[i]) | set(sets[j]))}
        assert linked <= found and len(linked) >= size // 10
        counts.append(len(found) / len(rows))
    assert max(counts) < 3  # of 50 to 220 pairs a text
