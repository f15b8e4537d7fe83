"""Fusion of language evidence against a plain version; texts of no known language."""

import collections
import math
import random

import pytest

from civiclake.llm import language
from tests.llm import data

SCHEMA = "doc_id long, text string, lang string, source string"
JUNK = [
    "xq zvk wpt jjg qqx vbn kdf zxw plm qaz wsx rfv tgb " * 3,
    "aGVsbG8gd29ybGQgdGhpcyBpcyBh YmFzZTY0IHN0cmluZyB0aGF0IGlz IGxvbmcgZW5vdWdoIHRvIGJlIGp1bms=",
    "Привет мир это русский текст без модели и он довольно длинный чтобы проверить",
]


def grams(text):
    letters = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in text.encode())
    padded = b" " + letters + b" "
    code = [int.from_bytes(padded[i:i + 3], "big") for i in range(len(letters)) if padded[i + 1] != 0x20]
    return [(c * 2654435761 % 2 ** 32) >> (32 - language.BUCKET_BITS) for c in code]


def plain(docs, training):
    """Per row: (language, probability, accepted)."""
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang, _ in training:
        if lang is not None:
            counts[lang].update(grams(text or ""))
    names, size = sorted(counts), 1 << language.BUCKET_BITS
    models = [[math.log((counts[n][b] + 0.1) / (sum(counts[n].values()) + 0.1 * size)) for b in range(size)] for n in names]
    models.append([-math.log(size)] * size)
    k, rows = len(models), []
    for _, text, lang, source in docs:
        g = grams(text or "")
        evidence = [sum(m[b] for b in g) / max(len(g), 1) * min(len(g), language.EVIDENCE) for m in models]
        guess = evidence.index(max(evidence)) if g else None
        rows.append((len(g), evidence, guess, source, lang and lang.lower()))
    sure = [r for r in rows if r[0] >= language.LEAST_TRIGRAMS]

    def tally(some):
        return [sum(r[2] == i for r in some) for i in range(k)]

    def blend(n, prior):
        return [(x + language.PRIOR_ROWS * p) / (sum(n) + language.PRIOR_ROWS) for x, p in zip(n, prior)]

    start = [(1 - language.UNKNOWN) / (k - 1)] * (k - 1) + [language.UNKNOWN]
    overall = blend(tally(sure), start)
    totals = tally([r for r in sure if r[4] is not None])
    values = {r[4] for r in sure if r[4] is not None}
    out = []
    for n, evidence, _, source, declared in rows:
        prior = overall if source is None or source not in {r[3] for r in sure} else blend(tally([r for r in sure if r[3] == source]), overall)
        score = [e + math.log(p) for e, p in zip(evidence, prior)]
        if declared in values:
            seen = tally([r for r in sure if r[4] == declared])
            score = [s + math.log((x + language.UNSEEN) / (t + language.UNSEEN * (len(values) + 1))) for s, x, t in zip(score, seen, totals)]
        top, best = max(score), max(score[:-1])
        share = math.exp(best - top) / sum(math.exp(s - top) for s in score)
        name = (names + [None])[score.index(top)]
        out.append((name, share, best == top and share >= language.LEAST_PROBABILITY) if n else (None, 0.0, False))
    return out


def cases():
    rng = random.Random(6)
    rows = []
    for i in range(90):
        lang = rng.choice(["en", "fr", "de"])
        said = rng.choice([lang, lang, lang, "EN", None, "xx"])
        rows.append((i, data.text(rng, lang, rng.randint(1, 4)), said, rng.choice(["a", "b", None, lang])))
    rows += [(100 + i, text, rng.choice(["en", None, "fr"]), "a") for i, text in enumerate(JUNK)]
    rows += [(200, None, "en", "a"), (201, "", None, None), (202, "1 + 1 = 2", "en", "a"), (203, "é", "fr", "b"), (204, data.text(rng, "de", 400), "de", "c")]
    return rows + rows[:2]


def test_fusion_against_plain_python(spark):
    rows = cases()
    training = [r for r in rows if r[2] in ("en", "fr", "de") and not 100 <= r[0] < 200]
    model = language.fit_text_model(spark.createDataFrame(training, SCHEMA))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    kept = sorted(r[0] for r in language.accepted_documents(docs, model).select("doc_id").collect())
    want = plain(rows, training)
    assert kept == sorted(r[0] for r, w in zip(rows, want) if w[2])
    assert not {100, 101, 102, 200, 201, 202} & set(kept) and 204 in kept and len(kept) > 80


@pytest.mark.parametrize("text", JUNK)
def test_a_declared_language_does_not_save_junk(spark, text):
    rows = cases()
    model = language.fit_text_model(spark.createDataFrame([r for r in rows if r[0] < 90], SCHEMA))
    docs = spark.createDataFrame([*[r for r in rows if r[0] < 90], (500, text, "en", "en")], SCHEMA)
    assert language.accepted_documents(docs, model).filter("doc_id = 500").count() == 0


def test_more_languages_than_models(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    rng = random.Random(3)
    rows = [(i, data.text(rng, ["en", "fr", "de"][i % 3], 6), ["en", "fr", "de"][i % 3], "s") for i in range(30)]
    rows += [(100 + i, f"{chr(0x430 + i) * 2} {chr(0x430 + i)} " * 12, f"l{i}", "s") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language.fit_text_model(docs)
    assert model.languages == ["de", "en", "fr", language.POOLED] and len(model.log_probability) == 5
    assert language.accepted_documents(docs, model).count() == len(rows)


def test_documents_without_language_and_source_columns(spark):
    rows = cases()
    model = language.fit_text_model(spark.createDataFrame([r for r in rows if r[2] in ("en", "fr", "de")], SCHEMA))
    bare = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    assert language.accepted_documents(bare, model).count() > 80
    assert language.accepted_documents(bare.limit(0), model).count() == 0
