"""Archives read member by member."""

import json
import zipfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from civiclake.operators.quality import Rule
from civiclake.plans.spec import CsvTable, PipelineSpec, run_pipeline
from civiclake.plans.wap import Ledger
from civiclake.sources import archives, zipfiles
from civiclake.sources.schemas import COMPANIES, bronze


def make(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in members.items():
            z.writestr(name, body)
    return str(path)


def test_one_task_per_member(spark, tmp_path):
    big = make(tmp_path / "a b+é.zip", {f"m{k}.csv": f"{k};x\n\n{k};y" for k in range(7)} | {"folder/": ""})
    small = make(tmp_path / "one.zip", {"only.csv": "9;z"})
    lines = zipfiles.member_lines(spark, [f"file:{big}", small])
    assert lines.rdd.getNumPartitions() == 8
    got = sorted(tuple(r) for r in lines.select("archive", "member", "line_no", "line").collect())
    assert got[:2] == [("a b+é.zip", "m0.csv", 0, "0;x"), ("a b+é.zip", "m0.csv", 2, "0;y")] and got[-1] == ("one.zip", "only.csv", 0, "9;z")
    assert len(got) == 15 and lines.filter("error IS NOT NULL").count() == 0


def test_member_lines_equal_those_of_whole_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zipfiles, "LINES_PER_BATCH", 3)
    for k in range(3):
        make(tmp_path / f"{k}.zip", {f"{m}.csv": "\r\n".join(f'"{i};ç";"a\nb"' for i in range(m * 5)).encode("latin-1") for m in range(4)})
    for multi_line in (False, True):
        one = zipfiles.member_lines(spark, archives.list_files(spark, str(tmp_path), "*.zip"), multi_line=multi_line)
        whole = archives.unpack_lines(archives.list_archives(spark, str(tmp_path)), multi_line=multi_line)
        assert one.exceptAll(whole).count() == whole.exceptAll(one).count() == 0 and one.count() == whole.count() > 20


def test_broken_archives_are_rejects_and_what_was_read_is_kept(spark, tmp_path):
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    empty = make(tmp_path / "empty.zip", {})
    torn = tmp_path / "torn.zip"
    make(torn, {"t.csv": "\n".join(f"{i};{'x' * 50}{i * 7919}" for i in range(60_000))})
    data = bytearray(torn.read_bytes())
    data[len(data) // 2] ^= 0xFF  # the checksum or the stream breaks
    torn.write_bytes(data)
    rows, rejects = archives.read_zip_csv(spark, str(tmp_path), ["a", "b"])
    assert sorted(r["archive"] for r in rejects.collect()) == ["bad.zip", "torn.zip"]
    assert {r[0] for r in rows.select("archive").distinct().collect()} <= {"torn.zip"} and empty
    with pytest.raises(FileNotFoundError):
        archives.read_zip_csv(spark, str(tmp_path), ["a"], pattern="*.none")


def test_a_zip_load_is_audited_published_and_archived(spark, tmp_path):
    body = '"1";"AÇÃO";"";"";"1,00";"NA";""\n2;b;c;d;e;f;g;h\n'.encode("latin-1")
    landed = make(tmp_path / "hd/2023-05/Empresas0.zip", {"K1.EMPRECSV": body, "K2.EMPRECSV": body})
    (tmp_path / "hd/2023-05/Empresas1.zip").write_bytes(b"broken")
    target = CsvTable("Empresas*.zip", "empresas", layout="*.EMPRECSV", zipped=True, na_tokens=("NA",))
    spec = PipelineSpec(name="rfb", csv_root=str(tmp_path / "hd"), csv_tables=[target], rules=[Rule("empresas", "cnpj_basico", "not_null")])
    ledger = Ledger(spark, str(tmp_path / "lake"))
    result = run_pipeline(spark, spec, ledger, datetime(2024, 1, 1, tzinfo=timezone.utc), archive_dir=str(tmp_path / "done"))
    assert result["published"] and result["dead_letters"] == {"empresas_dead_letters": 3}
    rows = ledger.read_ref("empresas", bronze(COMPANIES)).collect()
    assert [(r["cnpj_basico"], r["razao_social"], r["porte_empresa"]) for r in rows] == [("1", "AÇÃO", None)] * 2
    dead = ledger.read_ref("empresas_dead_letters", "raw string, _file string").collect()
    assert sorted(r["_file"] for r in dead) == ["Empresas0.zip/K1.EMPRECSV", "Empresas0.zip/K2.EMPRECSV", "Empresas1.zip"]
    assert not (tmp_path / "hd/2023-05/Empresas0.zip").exists() and (tmp_path / "done" / landed[1:]).exists()


def test_node_json(spark):
    node = "struct<attributes: map<string,string>, children: map<string,map<string,string>>>"
    rows = [({"attributes": {"A": 'x"ç', "C": "gone"}, "children": {"C": {"k": "v"}, "D": {}}},),
            ({"attributes": {}, "children": {}},), ({"attributes": {"A": None}, "children": {}},), (None,)]
    df = spark.createDataFrame(rows, f"n {node}").coalesce(1)
    got = [r[0] for r in df.select(archives.node_json(F.col("n"))).collect()]
    assert got[1] == "{}" and json.loads(got[2]) in ({}, {"A": None}) and got[3] is None
    assert json.loads(got[0]) == {"A": 'x"ç', "C": {"k": "v"}, "D": {}}
