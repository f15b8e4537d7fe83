"""Operators on a small fixture against plain Python versions."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from civiclake.llm import decontaminate, fingerprint, language, lines, mixing, perplexity, simhash, suffixes
from tests.llm import brute, data


@pytest.fixture(scope="module")
def rows():
    return data.documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, data.SCHEMA).coalesce(2)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], data.SCHEMA)


def pairs(rows):
    return [r[:2] for r in rows]


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_decontamination_finds_every_window(spark, docs, rows, empty, monkeypatch):
    items = data.benchmark(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute.decontamination(pairs(rows), items)
    same(decontaminate.contamination(docs, bench).select(columns).collect(), want)
    assert decontaminate.contamination(empty, bench).count() == 0
    clean = decontaminate.decontaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not w[-1] for w in want)
    assert decontaminate.decontaminated(docs, bench.limit(0)).count() == len(rows)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    assert len(decontaminate.benchmark_blocks(bench)) > 2
    same(decontaminate.contamination(docs, bench).select(columns).collect(), want)


def test_longest_match_and_its_place(spark):
    words = [f"w{i}" for i in range(40)]
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x y " + " ".join(words[5:25]) + " z " + " ".join(words[0:14]))], "doc_id long, text string")
    row = decontaminate.contamination(docs, bench).first()
    assert (row.longest_match, row.longest_match_at, row.n_hit) == (20, 2, 34)


def test_language_from_text_markup_address_and_host(spark, docs, empty):
    model = language.fit_text_model(docs)
    assert model.languages == ["de", "en", "fr"]
    rng = __import__("random").Random(9)
    pages = [(i, f"http://h{i % 3}.example.{'fr' if lang == 'fr' else 'com'}/x", f'<HTML dir=ltr lang="{lang}-X"><p>{data.text(rng, lang, 6)}</p>')
             for i, lang in enumerate(["en", "fr", "de"] * 20)]
    pages += [(100, None, None), (101, "not a url", ""), (102, "http://h1.example.fr/", "<html lang=fr>ou"), (103, "http://h1.example.fr/", "<p>1234</p>")]
    got = {r.page_id: r for r in language.page_languages(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()}
    assert len(got) == len(pages)
    assert all(got[i].language == lang and got[i].accepted for i, lang in enumerate(["en", "fr", "de"] * 20))
    assert got[102].language == "fr" and got[102].accepted
    for i in (100, 101, 103):
        assert (got[i].language, got[i].probability, got[i].accepted) == (None, 0.0, False)
    kept = language.accepted_documents(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.select("doc_id", "text").collect() if (r.text or "").strip()} == {r.doc_id for r in kept.collect()}
    none = language.fit_text_model(empty)
    assert none.languages == [] and language.accepted_documents(docs, none).count() == 0
    assert language.accepted_documents(empty, model).count() == 0


def test_evidence_beyond_the_text_decides_short_texts(spark, docs):
    model = language.fit_text_model(docs)
    rows = [(i, f"h{i}", "d", "fr", "fr", 50, [-9.0, -9.0, -1.0]) for i in range(30)]
    rows += [(100 + i, f"g{i}", "e", "com", "en", 50, [-9.0, -1.0, -9.0]) for i in range(30)]
    rows += [(200, "h1", "d", "fr", "fr", 1, [-1.0, -1.0, -1.2]), (201, "g1", "e", "com", "en", 1, [-1.0, -1.0, -1.0]),
             (202, None, None, None, None, 1, [-1.0, -1.1, -5.0])]
    frame = spark.createDataFrame(rows, "__rid long, host string, domain string, suffix string, declared string, trigrams long, evidence array<double>")
    got = {r["__rid"]: r.language for r in language.identify(frame, model.languages).collect()}
    assert (got[200], got[201]) == ("fr", "en") and got[202] in ("de", "en")


def test_language_model_base_counts_and_gain(spark, docs, rows, empty):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    model = perplexity.fit(docs.filter(~held_out))
    got = perplexity.scores(docs, model).collect()
    want = brute.base_scores(pairs(rows))
    key = lambda r: (r[0] is not None, r[0], r[1], r[4])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(g)[:4] == w[:4] and g.base_score == pytest.approx(w[4], rel=1e-9)
        assert g.score < 0
    assert perplexity.scores(empty, model).count() == 0
    nothing = perplexity.scores(docs, perplexity.fit(empty)).filter("doc_id = 60").first()
    assert (nothing.n_tokens, nothing.n_known, nothing.train_tokens) == (1, 0, 0)


def test_rare_words_are_joined_with_the_same_result(docs, monkeypatch):
    whole = {r.doc_id: r.base_score for r in perplexity.scores(docs, perplexity.fit(docs, rounds=1)).collect()}
    monkeypatch.setattr(perplexity, "HEAD_WORDS", 40)
    few = perplexity.fit(docs, rounds=1)
    assert 0 < len(few.vocabulary.hashes) <= 40
    assert {r.doc_id: r.base_score for r in perplexity.scores(docs, few).collect()} == pytest.approx(whole)


def test_mix_against_plain_python(docs, rows, empty):
    want = brute.mix([(r[0], r[1], r[3]) for r in rows])
    got = mixing.mix(docs).collect()
    key = lambda r: (r[0] is not None, r[0], r[1], r[2], r[4])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert (g.doc_id, g["size"], g.source_size, g.taken) == (*w[:3], w[4]) and g.target == pytest.approx(w[3])
    assert mixing.mix(empty).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == [*docs.columns, "mix_copies"]
    assert mixed.agg(F.sum(F.col("mix_copies") * mixing.word_count(F.col("text")))).first()[0] == sum(w[4] for w in want)
    assert mixing.mixed_documents(empty).count() == 0


def test_fingerprints(spark, docs, rows, empty):
    got = fingerprint.fingerprint_report(docs).collect()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""), reverse=True)
    want = []
    for at, i in enumerate(order):
        own, following = rows[i][1] or "", rows[order[(at + 1) % len(order)]][1] or ""
        changed = own[:len(own) - len(own) // 3] + following[:len(own) // 3]
        want.append((rows[i][0], len(own), hashlib.sha256(changed.encode()).hexdigest()))
    same([r[:3] for r in got], want)
    texts = {}
    for r in got:
        texts.setdefault(r.doc_id, r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert texts[rows[1][0]] == texts[3] and texts[60] == "00" * fingerprint.CLASSES  # a copy; an empty text
    long = [r for r in got if r.n_chars > 400 and r.doc_id is not None and r.doc_id < 60]
    assert np.median([r.near_edited for r in long]) > 0.3 > np.median([r.near_next for r in long])
    assert fingerprint.fingerprint_report(empty).count() == 0
    alone = fingerprint.fingerprint_report(docs.filter("doc_id = 5")).first()
    assert alone.near_next == 1.0


def test_phrases_do_not_depend_on_offset():
    rng = np.random.default_rng(4)
    shared = rng.integers(97, 123, 3000, dtype=np.uint8).tobytes()
    names = []
    for before in (b"", b"x", b"other beginning "):
        data = np.frombuffer(before + shared, dtype=np.uint8)
        first = np.zeros(len(data), bool)
        first[0] = True
        name, first = fingerprint.phrases(fingerprint._BYTE_NAME[data], first, data)
        for _ in range(2):
            name, first = fingerprint.phrases(name, first)
        names.append(set(name.tolist()))
    assert len(names[0] & names[1] & names[2]) > 0.9 * len(names[0])


def test_simhash_components(docs, rows, empty):
    prints, groups = brute.near_components(pairs(rows))
    least = {}
    for (doc_id, _), g in zip(pairs(rows), groups):
        least[g] = min((x for x in (least.get(g), doc_id) if x is not None), default=None)
    got = simhash.near_duplicates(docs)
    same([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got.collect()],
         [(r[0], p, least[g]) for r, p, g in zip(rows, prints, groups)])
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(groups))


def test_simhash_links_chains_and_all_distances(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = [int(b) for b in base]
    for b in base[:20]:  # chains of steps of two bits, and pairs three bits apart
        x = int(b)
        for _ in range(6):
            x ^= 1 << int(rng.integers(64)) | 1 << int(rng.integers(64))
            prints.append(x)
        prints.append(x ^ 0b111)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in set(prints)]
    found = simhash.components(simhash.near_links(spark.createDataFrame(signed, "fp long"))).collect()
    root = {r.node % (1 << 64): r.root for r in found}
    values = sorted(set(prints))
    group = {p: p for p in values}

    def top(p):
        while group[p] != p:
            p = group[p]
        return p

    for i, p in enumerate(values):
        for q in values[:i]:
            if (p ^ q).bit_count() <= 2:
                group[top(p)] = top(q)
    for p in values:
        for q in values:
            if p < q:
                assert (top(p) == top(q)) == (p in root and root[p] == root.get(q))


def test_line_dedup(docs, rows, empty):
    want = brute.line_dedup(pairs(rows))
    got = lines.without_repeated_lines(docs)
    assert got.columns == docs.columns
    same([(r.doc_id, r.text, r.n_chars) for r in got.collect()],
         [(r[0], t, None if t is None else len(t)) for r, t in zip(rows, want)])
    assert lines.without_repeated_lines(empty).count() == 0 and lines.line_report(empty).count() == 0


def test_repeated_strings(docs, rows, empty):
    same(suffixes.removal_report(docs).collect(), brute.repeated_bytes(pairs(rows)))
    assert suffixes.removal_report(empty).count() == 0


def test_repeated_strings_of_hot_anchors_and_long_texts(docs, rows, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_CONTEXTS", 2)
    monkeypatch.setattr(suffixes, "SORTED_AT_ONCE", 500)
    same(suffixes.removal_report(docs).collect(), brute.repeated_bytes(pairs(rows)))


def test_long_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    text = rng.integers(97, 101, 5000, dtype=np.uint8).tobytes()
    whole = suffixes.anchors_of([text])
    monkeypatch.setattr(suffixes, "PIECE", 700)
    parts = suffixes.anchors_of([text])
    owner = [np.concatenate([[a] * (hi - lo + 1) for a, lo, hi in zip(*x[1:4])]) for x in (whole, parts)]
    assert (owner[0] == owner[1]).all() and len(owner[0]) == 5000 - suffixes.LENGTH + 1
