"""Incremental Silver against the full rebuild, and joins with repeated registry loads."""

import itertools
from datetime import datetime

import pytest

from civiclake.operators import dedupe, joins
from civiclake.plans.silver import silver_amendments
from civiclake.plans.upsert import partitions, read_silver, update_silver
from civiclake.plans.wap import Ledger

SCHEMA = ("data_extracao timestamp, codigo_emenda string, codigo_documento string, ano string, valor_documento string, "
          "data_documento string, favorecido string")


def row(day, year, key, value):
    return (datetime(2024, 1, day), f"{year}00010001", f"{year}OB{key}", str(year), value, "01/02/2024", "FAVORECIDO COLETIVO")


LOADS = [
    [row(1, 2022, 1, "1,00"), row(1, 2023, 1, "2,00"), row(1, 2023, 2, "-"), (datetime(2024, 1, 1), "S/I", "x", "2022", "9,00", None, None)],
    [row(2, 2023, 1, "3,00"), row(2, 2023, 3, "4,00"), row(2, 2023, 3, "5,00")],  # a tie
    [row(3, 2024, 1, "6,00"), row(1, 2023, 3, "7,00"), row(2, 2023, 3, "4,50")],  # an older and an equally old row of a key
]


def load(spark, ledger, name, rows):
    ledger.create_branch(name)
    ledger.stage(spark.createDataFrame(rows, SCHEMA), "t", name, name)
    ledger.publish(name)
    ledger.delete_branch(name)


def plain(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_any_order_of_loads_equals_the_full_rebuild(spark, tmp_path, order):
    ledger, path = Ledger(spark, str(tmp_path / "lake")), str(tmp_path / "silver")
    for n in order:
        load(spark, ledger, f"i{n}", LOADS[n])
        update_silver(ledger, "t", SCHEMA, path)
    assert update_silver(ledger, "t", SCHEMA, path) == []
    whole = silver_amendments(ledger.read_ref("t", SCHEMA).drop("_ingest_id"))
    assert plain(read_silver(spark, path)) == plain(whole) and whole.count() == 5


def test_an_update_touches_only_the_years_of_its_keys(spark, tmp_path):
    ledger, path = Ledger(spark, str(tmp_path / "lake")), str(tmp_path / "silver")
    load(spark, ledger, "i0", LOADS[0])
    assert update_silver(ledger, "t", SCHEMA, path) == ["2022", "2023"]
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "silver").rglob("*.parquet")}
    load(spark, ledger, "i1", LOADS[1])
    assert update_silver(ledger, "t", SCHEMA, path) == ["2023"]
    old = partitions(spark, path, ["2023"])
    scan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano_emenda" in scan and "ano_emenda" in scan and "2023" in scan
    kept = [p for p in before if p.exists()]
    assert kept and all("ano_emenda=2022" in str(p) and p.stat().st_mtime_ns == before[p] for p in kept)


def test_one_side_of_repeated_loads(spark):
    day = [datetime(2024, m, 1) for m in (1, 2)]
    companies = spark.createDataFrame(
        [(day[0], "1", "old"), (day[1], "1", "new"), (day[0], "2", "only"), (day[1], "1", "new")], "data_extracao timestamp, cnpj_basico string, razao string")
    assert sorted(r["razao"] for r in dedupe.one_per_key(companies, ["cnpj_basico"]).collect()) == ["new", "only"]
    sites = spark.createDataFrame(
        [(day[0], "1", "PE"), (day[0], "1", "BA"), (day[1], "1", "CE"), (day[0], "2", "PE")], "data_extracao timestamp, cnpj_basico string, uf string")
    partners = spark.createDataFrame(
        [(day[0], "1", "a"), (day[0], "1", "b"), (day[1], "1", "b"), (day[0], "2", "c")], "data_extracao timestamp, cnpj_basico string, socio string")
    got = joins.partner_network(companies.drop("data_extracao").distinct().where("razao <> 'old'"), sites, partners)
    assert sorted((r["socio"], r["razao"], r["establishments"]) for r in got.collect()) == [("b", "new", 1), ("c", "only", 1)]
    got = joins.partner_network(companies, sites.drop("data_extracao"), partners.drop("data_extracao"))
    assert sorted((r["socio"], r["razao"], r["establishments"]) for r in got.collect()) == [("a", "new", 3), ("b", "new", 3), ("b", "new", 3), ("c", "only", 1)]
    amendments = spark.createDataFrame([("20240001000001", 1), ("20240001000001", 1), ("20240001000002", 2)], "codigo_emenda string, n int")
    documents = spark.createDataFrame([("20240001000001", "x"), ("20240001000001", "y")], "codigo_emenda string, d string")
    assert joins.amend_documents(amendments, documents).count() == 2
