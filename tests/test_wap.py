import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pytest

from civiclake.operators.quality import Rule
from civiclake.plans import wap
from civiclake.plans.spec import CsvTable, PipelineSpec, run_pipeline
from civiclake.plans.wap import Ledger, RefNotFound
from civiclake.sources.schemas import COMPANIES, bronze
from civiclake.streaming.ingest import LotRejected, stream_pipeline  # noqa: F401

SCHEMA = "id string"


def utc(month, day):
    return datetime(2024, month, day, tzinfo=timezone.utc)


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, str(tmp_path / "lake"))


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], SCHEMA)


def test_isolation_publish_and_time_travel(spark, ledger):
    assert ledger.at(utc(1, 1)).create_branch("b1") and not ledger.create_branch("b1")
    ledger.at(utc(1, 1)).stage(frame(spark, "1", "2", "3"), "t", "i1", "b1")
    assert ids(ledger.read_ref("t", SCHEMA)) == [] and ids(ledger.read_ref("t", SCHEMA, "b1")) == ["1", "2", "3"]
    head = ledger.head("b1")
    assert ledger.at(utc(1, 2)).publish("b1") == [("t", "i1")] and ledger.publish("b1") == []
    assert ledger.head() > head
    assert ledger.at(utc(1, 2)).delete_branch("b1") and not ledger.delete_branch("b1")
    with pytest.raises(RefNotFound):
        ledger.read_ref("t", SCHEMA, "b1")
    ledger.at(utc(1, 3)).tag("v1")
    ledger.at(utc(2, 1)).create_branch("b2")
    ledger.at(utc(2, 1)).stage(frame(spark, "4"), "t", "i2", "b2")
    ledger.at(utc(2, 1)).stage(frame(spark, "x"), "u", "i2", "b2")
    assert ids(ledger.read_ref("t", SCHEMA, "b2")) == ["1", "2", "3", "4"]
    ledger.at(utc(2, 1)).create_branch("b3", from_ref="b2")
    assert ids(ledger.read_ref("t", SCHEMA, "b3")) == ["1", "2", "3", "4"]
    ledger.at(utc(2, 2)).publish("b2")
    assert ids(ledger.read_ref("t", SCHEMA)) == ["1", "2", "3", "4"] and ids(ledger.read_ref("u", SCHEMA)) == ["x"]
    assert ids(ledger.read_as_of("t", SCHEMA, utc(1, 15))) == ["1", "2", "3"] and ids(ledger.read_as_of("t", SCHEMA, datetime(2023, 1, 1))) == []
    assert ids(ledger.read_ref("t", SCHEMA, "v1")) == ["1", "2", "3"]
    assert [(r["ingest_id"], r["branch"]) for r in ledger.history("t").orderBy("seq").collect()] == [("i1", "b1"), ("i2", "b2")]
    ledger.use("v1", {"t": SCHEMA})
    assert spark.sql("SELECT count(*) FROM t").first()[0] == 3
    with pytest.raises(RefNotFound):
        ledger.create_branch("b9", from_ref="nope")


def test_a_written_folder_is_never_replaced(spark, ledger):
    ledger.create_branch("b")
    ledger.stage(frame(spark, "1"), "t", "i", "b")
    with pytest.raises(Exception, match="(?i)exists"):
        ledger.stage(frame(spark, "2"), "t", "i", "b")
    assert ids(ledger.read_ref("t", SCHEMA, "b")) == ["1"]


def test_commits_of_several_writers(spark, ledger, monkeypatch):
    monkeypatch.setattr(wap, "SNAPSHOT_EVERY", 5)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda t: [ledger.create_branch(f"b{t}_{i}") for i in range(8)], range(3)))
    rows = ledger.rows().collect()
    assert len(rows) == 24 and sorted(r["seq"] for r in rows) == list(range(1, 25))
    assert {r["ref"] for r in rows} == {f"b{t}_{i}" for t in range(3) for i in range(8)}


def test_commit_times_never_fall(ledger):
    ledger.at(utc(3, 1)).create_branch("a")
    ledger.at(utc(1, 1)).create_branch("b")
    assert {r["committed_at"] for r in ledger.rows().collect()} == {ledger.rows().first()["committed_at"]}


def test_a_repeated_run_changes_nothing(spark, ledger, tmp_path):
    spec = spec_for(tmp_path)
    jsonl(tmp_path / "landing/lote_1.jsonl", {"id_lattes": "1", "nome": "A"})
    first = run_pipeline(spark, spec, ledger, utc(1, 1))
    jsonl(tmp_path / "landing/lote_2.jsonl", {"nome": "sem id"})
    again = run_pipeline(spark, spec, ledger, utc(1, 1))
    assert again["repeated"] and again["ingest_id"] == first["ingest_id"]
    refused = run_pipeline(spark, spec, ledger, utc(2, 1))
    assert not refused["published"] and not run_pipeline(spark, spec, ledger, utc(2, 1))["published"]
    assert [r["id_lattes"] for r in ledger.read_ref("lattes_raw", bronze(spec.columns)).collect()] == ["1"]
    jsonl(tmp_path / "landing/lote_2.jsonl", {"id_lattes": "2", "nome": "com id"})
    assert run_pipeline(spark, spec, ledger, utc(2, 1))["published"]
    assert run_pipeline(spark, spec, ledger, utc(3, 1))["tables"] == []
    assert sorted(r["id_lattes"] for r in ledger.read_ref("lattes_raw", bronze(spec.columns)).collect()) == ["1", "2"]


def test_a_source_without_files_is_an_error(spark, ledger, tmp_path):
    (tmp_path / "hd").mkdir()
    spec = PipelineSpec(name="rfb", csv_root=str(tmp_path / "hd"), csv_tables=[CsvTable("*.EMPRECSV", "rfb_cnpj_empresas")])
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, spec, ledger, utc(1, 1))
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, spec_for(tmp_path), ledger, utc(1, 1))
    assert ledger.rows().count() == 0


def test_compare_refs(spark, ledger):
    ledger.create_branch("b")
    ledger.stage(frame(spark, "1"), "t", "i1", "b")
    ledger.publish("b")
    ledger.create_branch("c")
    ledger.stage(frame(spark, "2", "3"), "u", "i2", "c")
    assert (ledger.tables(), ledger.tables("c")) == (["t"], ["t", "u"])
    got = sorted(tuple(r) for r in ledger.compare("main", "c").collect())
    assert got == [("t", 1, 1, True), ("u", 0, 2, False)]


def test_branch_name_can_be_reused(spark, ledger):
    ledger.create_branch("b")
    ledger.stage(frame(spark, "1"), "t", "i1", "b")
    ledger.delete_branch("b")
    ledger.create_branch("b")
    assert ids(ledger.read_ref("t", SCHEMA, "b")) == []


def test_read_opens_only_the_folders_of_the_ref(spark, ledger):
    ledger.create_branch("b")
    for i in range(3):
        ledger.write(frame(spark, str(i)), "t", f"i{i}")
    ledger.mark_staged("b", [("t", "i1")])
    files = ledger.read_ref("t", SCHEMA, "b").inputFiles()
    assert files and all("_ingest_id=i1" in f for f in files)


def jsonl(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")


def spec_for(tmp_path, **changes):
    base = dict(
        name="lattes", source=f"{tmp_path}/landing/lote_*.jsonl", table="lattes_raw",
        columns=["id_lattes", "nome", "projetos_pesquisa"], rename={"research_projects": "projetos_pesquisa"},
        rules=[Rule("lattes_raw", "id_lattes", "not_null"), Rule("lattes_raw", "id_lattes", "unique", "warn"),
               Rule("lattes_raw", "nome", "not_null", "warn")])
    return PipelineSpec(**{**base, **changes})


def test_pipeline_passes_and_fails(spark, ledger, tmp_path):
    spec = spec_for(tmp_path)
    jsonl(tmp_path / "landing/lote_1.jsonl", {"id_lattes": "001", "nome": "A", "research_projects": [{"T": 1}]}, {"id_lattes": "002", "nome": None})
    first = run_pipeline(spark, spec, ledger, utc(1, 1))
    assert first["published"] and first["ingest_id"].startswith("ingest_lattes_20240101_000000_")
    rows = ledger.read_ref("lattes_raw", bronze(spec.columns)).orderBy("id_lattes").collect()
    assert [(r["id_lattes"], r["projetos_pesquisa"]) for r in rows] == [("001", '[{"T": 1}]'), ("002", None)]
    jsonl(tmp_path / "landing/lote_1.jsonl", {"nome": "sem id"})
    second = run_pipeline(spark, spec, ledger, utc(2, 1))
    assert not second["published"]
    assert ledger.read_ref("lattes_raw", bronze(spec.columns)).count() == 2
    kinds = [r["kind"] for r in ledger.rows().orderBy("seq").collect()]
    assert kinds == ["branch", "stage", "publish", "delete", "branch", "stage", "reject", "delete"]
    # the refused data are still there for a replay
    assert spark.read.parquet(ledger.location("lattes_raw", second["ingest_id"])).count() == 1


def test_csv_pipeline(spark, ledger, tmp_path):
    folder = tmp_path / "hd/2023-05"
    folder.mkdir(parents=True)
    (folder / "K.EMPRECSV").write_bytes('"1";"AÇÃO";"";"";"1,00";"";""\n;;;;;;\n'.encode("iso-8859-1"))
    (folder / "L.EMPRECSV").write_bytes(b'"2;x\n"3";"";"";"";"";"";"";"too long"\n')
    spec = PipelineSpec(name="rfb", csv_root=str(tmp_path / "hd"), csv_tables=[CsvTable("*.EMPRECSV", "rfb_cnpj_empresas")],
                        rules=[Rule("rfb_cnpj_empresas", "cnpj_basico", "not_null")])
    result = run_pipeline(spark, spec, ledger, utc(1, 1))
    assert result["published"] and result["dead_letters"] == {"rfb_cnpj_empresas_dead_letters": 2}
    assert ledger.read_ref("rfb_cnpj_empresas_dead_letters", "raw string, _file string").count() == 2
    rows = ledger.read_ref("rfb_cnpj_empresas", bronze(COMPANIES)).collect()
    assert [(r["cnpj_basico"], r["razao_social"]) for r in rows] == [("1", "AÇÃO")]


def test_direct_load_and_year_window(spark, ledger, tmp_path):
    jsonl(tmp_path / "landing/lote_1.jsonl", {"codigo": "a", "ano": 2024}, {"codigo": "b", "ano": 2026}, {"codigo": "c"})
    spec = PipelineSpec(name="cgu", source=f"{tmp_path}/landing/lote_*.jsonl", table="t", columns=["codigo", "ano"],
                        branching=False, first_year=2026, last_year=2026)
    assert run_pipeline(spark, spec, ledger, utc(1, 1))["published"]
    assert [r["codigo"] for r in ledger.read_ref("t", bronze(spec.columns)).collect()] == ["b"]


def test_contradictory_specs():
    with pytest.raises(ValueError, match="needs"):
        PipelineSpec(name="x").check()
    with pytest.raises(ValueError, match="isolated"):
        PipelineSpec(name="x", csv_root="/a", branching=False).check()
    with pytest.raises(ValueError, match="columns"):
        PipelineSpec(name="x", source="/a").check()


def test_stream_takes_each_file_once(spark, ledger, tmp_path):
    spec = spec_for(tmp_path, source=str(tmp_path / "landing"))
    checkpoint = str(tmp_path / "checkpoint")
    schema = bronze(spec.columns)

    def run():
        stream_pipeline(spark, spec, ledger, checkpoint, max_files=1, archive_dir=str(tmp_path / "processed"), load_ts=utc(1, 1)).awaitTermination()

    jsonl(tmp_path / "landing/lote_1.jsonl", {"id_lattes": "1", "nome": "A"})
    jsonl(tmp_path / "landing/lote_2.jsonl", {"id_lattes": "2", "nome": "B"})
    run()
    assert sorted(r["id_lattes"] for r in ledger.read_ref("lattes_raw", schema).collect()) == ["1", "2"]
    assert len(ledger.ingest_ids("lattes_raw")) == 2  # one isolated ingest per bounded lot
    run()
    jsonl(tmp_path / "landing/lote_3.jsonl", {"nome": "sem id"})
    jsonl(tmp_path / "landing/lote_4.jsonl", {"id_lattes": "4", "nome": "D"})
    for _ in range(2):  # a refused lot is reported and offered again
        with pytest.raises(Exception, match="LotRejected"):
            run()
    jsonl(tmp_path / "landing/lote_3.jsonl", {"id_lattes": "3", "nome": "com id"})
    run()
    assert sorted(r["id_lattes"] for r in ledger.read_ref("lattes_raw", schema).collect()) == ["1", "2", "3", "4"]


def test_streams_with_other_checkpoints_do_not_collide(spark, ledger, tmp_path):
    for part in ("a", "b"):
        spec = spec_for(tmp_path, source=str(tmp_path / part))
        jsonl(tmp_path / part / "lote.jsonl", {"id_lattes": part, "nome": "x"})
        stream_pipeline(spark, spec, ledger, str(tmp_path / f"checkpoint_{part}")).awaitTermination()
    assert sorted(r["id_lattes"] for r in ledger.read_ref("lattes_raw", bronze(spec.columns)).collect()) == ["a", "b"]
    assert len({i.rsplit("_", 2)[0] for i in ledger.ingest_ids("lattes_raw")}) == 2
