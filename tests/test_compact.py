"""Compaction of ingest folders and of the lists of landed files."""

import json
from datetime import datetime, timedelta, timezone

import pytest

from civiclake.plans import compact as compaction
from civiclake.plans.compact import compact, compact_claims
from civiclake.plans.spec import PipelineSpec, run_pipeline
from civiclake.plans.wap import Ledger
from civiclake.sources.schemas import bronze
from civiclake.streaming.ingest import stream_pipeline

SCHEMA = "id string"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def folders(ledger, ref="main"):
    return {f.rsplit("/", 2)[1] for f in ledger.read_ref("t", SCHEMA, ref).inputFiles()}


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, str(tmp_path / "lake"))


def publish(ledger, name, at=START):
    then = ledger.at(at)
    then.create_branch(name)
    then.stage(ledger.spark.createDataFrame([(name,)], SCHEMA).coalesce(1), "t", name, name)
    then.publish(name)
    then.delete_branch(name)


def test_reads_open_few_folders_and_the_past_stays(spark, ledger):
    want = []
    for k in range(20):
        publish(ledger, f"i{k:02d}", START + timedelta(days=k))
        want.append((f"i{k:02d}", f"i{k:02d}"))
        compact(ledger.at(START + timedelta(days=k, hours=1)), "t", SCHEMA, 3)
        assert len(folders(ledger)) <= 2 * 3
        if k == 10:
            ledger.at(START + timedelta(days=k, hours=2)).tag("ten")
            ledger.at(START + timedelta(days=k, hours=2)).create_branch("side")
    assert rows(ledger.read_ref("t", SCHEMA)) == want
    for k in (0, 5, 13, 19):
        assert rows(ledger.read_as_of("t", SCHEMA, START + timedelta(days=k, minutes=1))) == want[:k + 1]
    assert rows(ledger.read_ref("t", SCHEMA, "ten")) == rows(ledger.read_ref("t", SCHEMA, "side")) == want[:11]
    assert [r["ingest_id"] for r in ledger.history("t").orderBy("seq").collect()] == [w[0] for w in want]
    # what is compacted is published all the same
    ledger.create_branch("again")
    ledger.mark_staged("again", [("t", "i00")])
    assert ledger.publish("again") == []


def test_levels_grow_with_the_logarithm():
    class Fake(Ledger):
        def __init__(self):
            self.ids = [f"i{k}" for k in range(500)]

        def ingest_ids(self, table):
            return self.ids

        def read_ingests(self, table, schema, ids):
            class Frame:
                def withColumnRenamed(self, a, b):
                    return self

                def hint(self, name):
                    return self
            return Frame()

        def write(self, df, table, name):
            pass

        def replace(self, table, old, new):
            self.ids = [i for i in self.ids if i not in old] + [new]
            return True

    fake = Fake()
    compact(fake, "t", SCHEMA, 16)
    assert len(fake.ids) < 3 * 16


def test_two_compactions_at_once(spark, ledger, monkeypatch):
    for k in range(4):
        publish(ledger, f"i{k}")
    whole = Ledger.write

    def write(self, df, table, name):
        monkeypatch.setattr(Ledger, "write", whole)
        assert compact(Ledger(spark, ledger.root), "t", SCHEMA, 4) == 1
        return whole(self, df, table, name)

    monkeypatch.setattr(Ledger, "write", write)
    assert compact(ledger, "t", SCHEMA, 4) == 0
    assert rows(ledger.read_ref("t", SCHEMA)) == [(f"i{k}", f"i{k}") for k in range(4)] and len(folders(ledger)) == 1


def test_a_stream_that_compacts(spark, ledger, tmp_path):
    spec = PipelineSpec(name="s", source=f"{tmp_path}/landing/*.jsonl", table="t", columns=["id"])
    (tmp_path / "landing").mkdir()
    for k in range(7):
        (tmp_path / f"landing/lote_{k}.jsonl").write_text(json.dumps({"id": str(k)}))
    stream_pipeline(spark, spec, ledger, str(tmp_path / "checkpoint"), max_files=1, compact_at=3).awaitTermination()
    assert sorted(r["id"] for r in ledger.read_ref("t", bronze(["id"])).collect()) == [str(k) for k in range(7)]
    assert len(ledger.ingest_ids("t")) == len(ledger.claim_ids()) == 3
    assert ledger.consumed()[0].count() == 7 and run_pipeline(spark, spec, ledger)["tables"] == []
    assert compact_claims(ledger, 2) == 1 and ledger.consumed()[0].count() == 7
    assert {compaction.level(i) for i in ledger.ingest_ids("t")} == {0, 1}
