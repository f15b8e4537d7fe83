"""Every landed file is loaded once, whoever loads it and whenever."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pytest

from civiclake.operators.quality import Rule
from civiclake.plans import spec as spec_module
from civiclake.plans import wap
from civiclake.plans.spec import PipelineSpec, run_pipeline
from civiclake.plans.wap import FilesTaken, Ledger
from civiclake.sources.files import FILE_ID, archive_files, landed_files, list_files
from civiclake.sources.schemas import bronze
from civiclake.streaming.ingest import stream_pipeline


@pytest.fixture
def lake(spark, tmp_path):
    spec = PipelineSpec(name="t", source=f"{tmp_path}/landing/lote_*.jsonl", table="t", columns=["id"], rules=[Rule("t", "id", "not_null")])
    return spec, Ledger(spark, str(tmp_path / "lake"))


def land(tmp_path, name, *ids):
    path = tmp_path / "landing" / f"{name}.jsonl"
    path.parent.mkdir(exist_ok=True)
    path.write_text("".join(json.dumps({"id": i}) + "\n" for i in ids))
    return path


def loaded(ledger):
    return sorted(r["id"] for r in ledger.read_ref("t", bronze(["id"])).collect())


def stream(spark, lake, tmp_path, checkpoint="checkpoint", **options):
    spec, ledger = lake
    stream_pipeline(spark, spec, ledger, str(tmp_path / checkpoint), **options).awaitTermination()


def test_runs_at_the_same_time(spark, lake, tmp_path):
    spec, ledger = lake
    land(tmp_path, "lote_1", "1", "2")
    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(lambda _: run_pipeline(spark, spec, Ledger(spark, ledger.root)), range(4)))
    assert loaded(ledger) == ["1", "2"] and sum(r["published"] for r in results) == 1


def test_a_run_between_the_listing_and_the_commit_of_another(spark, lake, tmp_path, monkeypatch):
    spec, ledger = lake
    land(tmp_path, "lote_1", "1")
    whole = spec_module.audit
    inner = []

    def audit(*args):
        monkeypatch.setattr(spec_module, "audit", whole)
        inner.append(run_pipeline(spark, spec, Ledger(spark, ledger.root)))
        land(tmp_path, "lote_2", "2")
        return whole(*args)

    monkeypatch.setattr(spec_module, "audit", audit)
    outer = run_pipeline(spark, spec, ledger)
    assert inner[0]["published"] and outer["taken"] and not outer["published"]
    assert [r["kind"] for r in ledger.rows().orderBy("seq").collect()].count("reject") == 1
    assert loaded(ledger) == ["1"]
    assert run_pipeline(spark, spec, ledger)["published"] and loaded(ledger) == ["1", "2"]


def test_a_commit_is_refused_only_for_files_that_others_hold(spark, lake, tmp_path):
    _, ledger = lake
    land(tmp_path, "lote_1", "1")
    land(tmp_path, "lote_2", "2")
    first, second = (landed_files(spark, f"{tmp_path}/landing/lote_{i}.jsonl") for i in (1, 2))

    def publish(name, files):
        ledger.create_branch(name)
        ledger.stage(spark.createDataFrame([(name,)], "id string"), "t", name, name)
        return ledger.publish(name, ledger.claim(name, files))

    assert publish("a", first) == [("t", "a")] and publish("b", second) == [("t", "b")]
    with pytest.raises(FilesTaken):
        publish("c", first)
    assert loaded_ids(ledger) == ["a", "b"]
    assert ledger.consumed()[0].count() == 2


def loaded_ids(ledger):
    return sorted(r["id"] for r in ledger.read_ref("t", "id string").collect())


def test_streams_and_batches_share_one_record(spark, lake, tmp_path):
    spec, ledger = lake
    land(tmp_path, "lote 1".replace(" ", "_"), "1")
    land(tmp_path, "lote_é +%20x", "2")  # names that a path may write in several ways
    stream(spark, lake, tmp_path)
    assert run_pipeline(spark, spec, ledger)["tables"] == []
    land(tmp_path, "lote_3", "3")
    assert run_pipeline(spark, spec, ledger)["published"]
    land(tmp_path, "lote_4", "4")
    stream(spark, lake, tmp_path)  # one file of its lot is loaded already
    stream(spark, lake, tmp_path, "another")  # all are
    assert loaded(ledger) == ["1", "2", "3", "4"]
    land(tmp_path, "lote_4", "4 again")  # another file under an old name
    assert run_pipeline(spark, spec, ledger)["published"]
    assert loaded(ledger) == ["1", "2", "3", "4", "4 again"]


def test_a_batch_run_while_a_stream_loads(spark, lake, tmp_path, monkeypatch):
    from civiclake.streaming import ingest

    spec, ledger = lake
    land(tmp_path, "lote_1", "1")
    whole = ingest.audit

    def audit(*args):
        monkeypatch.setattr(ingest, "audit", whole)
        run_pipeline(spark, spec, Ledger(spark, ledger.root))
        return whole(*args)

    monkeypatch.setattr(ingest, "audit", audit)
    land(tmp_path, "lote_2", "2")
    stream(spark, lake, tmp_path)
    assert loaded(ledger) == ["1", "2"]


def test_published_files_are_archived(spark, lake, tmp_path):
    spec, ledger = lake
    good, away = land(tmp_path, "lote_1", "1"), tmp_path / "processed"
    assert run_pipeline(spark, spec, ledger, archive_dir=str(away))["published"]
    assert not good.exists() and (away / str(good)[1:]).exists()
    bad = land(tmp_path, "lote_2", None)
    assert not run_pipeline(spark, spec, ledger, archive_dir=str(away))["published"] and bad.exists()
    again = land(tmp_path, "lote_1", "1b")
    archive_files(spark, [str(again), str(again)], str(away))  # the name is taken: kept beside
    assert not again.exists() and len(list((away / str(tmp_path)[1:] / "landing").glob("lote_1.jsonl*"))) == 2


def test_two_runs_within_a_second(spark, lake, tmp_path):
    spec, ledger = lake
    moment = datetime.now(timezone.utc)
    land(tmp_path, "lote_1", "1")
    first = run_pipeline(spark, spec, ledger)
    land(tmp_path, "lote_2", "2")
    second = run_pipeline(spark, spec, ledger)
    assert first["published"] and second["published"] and not second["repeated"]
    land(tmp_path, "lote_3", "3")
    named = [run_pipeline(spark, spec, ledger, moment) for _ in range(2)]
    assert [r["repeated"] for r in named] in ([False, True], [True, True])
    assert {"1", "2"} <= set(loaded(ledger))


def test_the_ledger_holds_no_files(spark, lake, tmp_path):
    spec, ledger = lake
    for i in range(30):
        land(tmp_path, f"lote_{i}", str(i))
    run_pipeline(spark, spec, ledger)
    text = "".join(p.read_text() for p in (tmp_path / "lake/_ledger").glob("commit-*"))
    assert "lote_" not in text and ledger.consumed()[0].count() == 30


def test_listing(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    for name in ("a/x.EMPRECSV", "a/b/y.EMPRECSV", "a/b/_hidden.EMPRECSV", "a/z.OTHER"):
        (tmp_path / name).write_text("1")
    assert [p.rsplit("/", 1)[1] for p in list_files(spark, str(tmp_path), "*.EMPRECSV")] == ["y.EMPRECSV", "x.EMPRECSV"]
    assert landed_files(spark, str(tmp_path)).columns == ["path", *FILE_ID]
    for path, pattern in ((str(tmp_path), "*.NONE"), (f"{tmp_path}/nowhere", None)):
        with pytest.raises(FileNotFoundError):
            list_files(spark, path, pattern)


class ObjectStore:
    """File system of a store whose streams make the object on closing, if they may."""

    def __init__(self, conditional=True):
        self.objects, self.conditional = {}, conditional

    def getScheme(self):
        return "s3a"

    def createFile(self, path):
        store = self

        class Builder:
            def overwrite(self, flag):
                assert flag is False
                return self

            def recursive(self):
                return self

            def must(self, key, value):
                assert key == "fs.option.create.conditional.overwrite" and value is True
                return self

            def build(self):
                if not store.conditional:
                    raise ValueError("java.lang.IllegalArgumentException: Unknown mandatory key")
                return Stream(path)

        class Stream:
            def __init__(self, name):
                self.name, self.data = name, b""

            def write(self, data):
                self.data += bytes(data)

            def close(self):
                if self.name in store.objects:
                    raise OSError("org.apache.hadoop.fs.s3a.RemoteFileChangedException: 412")
                store.objects[self.name] = self.data

        return Builder()


def test_commits_on_an_object_store_are_exclusive_or_refused():
    files = wap._Files.__new__(wap._Files)
    files._folder, files._fs, files._path = "s3a://lake/_ledger", ObjectStore(), lambda name: name
    assert files.create("commit-1", "a") and not files.create("commit-1", "b")
    assert files._fs.objects == {"commit-1": b"a"}
    files._fs = ObjectStore(conditional=False)
    with pytest.raises(RuntimeError, match="exclusively"):
        files.create("commit-2", "a")


def test_rules_are_counted_while_writing(spark, tmp_path):
    import shutil

    from civiclake.plans.spec import audit, write_observed

    rules = [Rule("t", "id", "not_null"), Rule("t", "data_extracao", "freshness", "warn"), Rule("t", "id", "unique", "warn")]
    spec = PipelineSpec(name="t", source="x", table="t", columns=["id"], rules=rules)
    ledger, now = Ledger(spark, str(tmp_path / "lake")), datetime(2024, 6, 1, tzinfo=timezone.utc)
    for n, (values, want) in enumerate([(["a", None, "a"], (1, 2)), ([], (0, 2)), (["a", "b"], (0, 1))]):
        rows = spark.createDataFrame([(datetime(2024, 5 if n == 2 else 1, 1), v) for v in values], "data_extracao timestamp, id string")
        known = write_observed(spec, ledger, rows, "t", f"i{n}", now)
        counted = audit(spec, ledger, {"t": f"i{n}"}, now, known)
        assert counted == audit(spec, ledger, {"t": f"i{n}"}, now)
        if values:
            assert set(known) == {r.name for r in rules[:2]} and (counted["failed"], counted["warned"]) == (want[0], want[1] if n == 0 else 0)
    only = PipelineSpec(name="t", source="x", table="t", columns=["id"], rules=rules[:2])
    shutil.rmtree(tmp_path / "lake/t")  # nothing is read again for these rules
    assert audit(only, ledger, {"t": "i2"}, now, known)["publish"]
