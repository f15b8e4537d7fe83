"""The pipeline's stages on a small fixture, and its registration."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from civiclake.llm import ORACLES, QUERIES, lines, mixing, simhash
from tests.llm import brute, data
from tests.llm.test_long_lines import long_dedup
from tests.llm.test_nearsets import kept_rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = cases()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, data.SCHEMA).coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(data.benchmark(rows), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows


def cases():
    """The awkward documents, and those that three-word fingerprints or runs of three lines would judge otherwise."""
    rng = random.Random(12)
    rows = data.documents(45, seed=8)
    long_line = data.sentence(rng, "en", 60)
    words = data.sentence(rng, "de", 160).split()
    other = list(words)
    for k in (20, 80, 140):  # 15 of 156 shingles changed
        other[k] = f"w{k}"
    texts = [long_line, data.sentence(rng, "fr", 30) + "\n" + long_line, " ".join(words), " ".join(other), " ".join(words[:70])]
    return rows + [(500 + i, t, "en", "a", len(t), 1.0, 2, 3, 4, "x", "y") for i, t in enumerate(texts)]


def test_pipeline_against_plain_python(spark, folder):
    path, rows = folder
    # every document with letters has a language
    docs = [(r[0], r[1], r[3]) for r in rows if any(c.isalpha() for c in r[1] or "")]
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0, i))
    texts = dict(zip(order, long_dedup([docs[i][:2] for i in order])))
    docs = [(d[0], texts[i], d[2]) for i, d in enumerate(docs)]
    kept = kept_rows([d[:2] for d in docs])
    _, groups = brute.near_components([d[:2] for d in docs])
    assert len(kept) < len(set(groups))  # near copies that lie more than two bits apart
    docs = [docs[i] for i in kept]
    verdict = brute.decontamination([d[:2] for d in docs], data.benchmark(rows))
    docs = [d for d, v in zip(docs, verdict) if not v[-1]]
    want = [(d[0], d[1], m[4]) for d, m in zip(docs, brute.mix(docs)) if m[4]]
    got = corpus_pipeline.run(spark, path)
    assert got.columns == [*spark.read.parquet(f"{path}/documents.parquet").columns, "mix_copies"]
    found = [(r.doc_id, r.text, r.mix_copies * len(brute.SPACED.findall(r.text.encode()))) for r in got.collect() if r.text.strip()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(found, key=key) == sorted(want, key=key)


def test_every_stage_takes_an_empty_table(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        assert out.count() == 0 and set(docs.columns) <= set(out.columns), name


def test_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]
    assert {"pipeline", *QUERIES} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_native_operators_use_no_python(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for frame in (mixing.mix(docs), lines.line_report(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "Arrow" in simhash.with_fingerprint(docs)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    import duckdb

    data_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{data_dir}/{table}.parquet')")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, data_dir).select(*want.columns).collect()

    def plain(rows):
        return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=str)

    assert plain(got) == plain(want.fetchall())


def test_a_result_outlives_another_run(spark, folder):
    path, _ = folder
    first = corpus_pipeline.run(spark, path)
    want = corpus_pipeline.run(spark, path).count()
    assert first.count() == want > 20
