"""Profiles merged over ingests and differences between refs."""

import re

import pytest

from civiclake.operators.dedupe import snapshot_diff
from civiclake.operators.profiling import completeness
from civiclake.plans.compact import compact
from civiclake.plans.diff import ref_diff
from civiclake.plans.profiles import ref_profile, write_profile
from civiclake.plans.wap import Ledger

SCHEMA = "k string, v string, n int"


def publish(ledger, name, rows, branch=None):
    ledger.create_branch(branch or name)
    ledger.stage(ledger.spark.createDataFrame(rows, SCHEMA), "t", name, branch or name)
    if not branch:
        ledger.publish(name)


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, str(tmp_path / "lake"))


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_diff_equals_the_full_one_and_reads_shared_folders_for_keys(spark, ledger, monkeypatch):
    publish(ledger, "i0", [("a", "1", 1), ("b", "2", 2), (None, "3", 3), ("c", "4", 4), ("c", "4", 4)])
    publish(ledger, "side", [("a", "9", 1), ("x", "1", 1), ("c", "4", 4)], branch="b")
    publish(ledger, "i1", [("b", "2", 2), ("d", "5", 5), (None, "3", 3), ("x", "1", 1)])
    before, after = ledger.ingest_ids("t", "b"), ledger.ingest_ids("t")
    read, whole = [], Ledger.read_ingests
    monkeypatch.setattr(Ledger, "read_ingests", lambda self, table, schema, ids: (read.append(ids), whole(self, table, schema, ids))[1])
    got = ref_diff(ledger, "t", SCHEMA, ["k"], before, after)
    monkeypatch.undo()
    want = snapshot_diff(*[ledger.read_ref("t", SCHEMA, ref).drop("_ingest_id") for ref in ("b", "main")], ["k"])
    assert plain(got) == plain(want) and len(plain(got)) == 5
    scans = re.findall(r"ReadSchema: (\S+)", got._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(tuple, read)) == [("i0",), ("i1",), ("side",)]  # each folder by one frame, the shared one for its key
    assert set(scans) == {"struct<k:string,v:string,n:int>", "struct<k:string>"}
    assert plain(ref_diff(ledger, "t", SCHEMA, ["k"], after, after)) == []
    compact(ledger, "t", SCHEMA, 2)
    assert plain(ref_diff(ledger, "t", SCHEMA, ["k"], before, ledger.ingest_ids("t"))) == plain(want)


def test_profiles_of_a_ref_equal_one_over_its_rows(spark, ledger):
    for i in range(4):
        rows = [(f"k{j % 50}", [None, "", "-", "text", " NA "][j % 5], j * (i + 1)) for j in range(i * 30, i * 30 + 90)]
        publish(ledger, f"i{i}", rows)
        write_profile(ledger, "t", SCHEMA, f"i{i}", ["k", "v", "n"])
        compact(ledger, "t", SCHEMA, 3)
    rows = ledger.read_ref("t", SCHEMA).drop("_ingest_id")
    got = ref_profile(ledger, "t")
    assert plain(got.drop("distinct_estimate", "median_estimate")) == plain(completeness(rows, ["k", "v", "n"]))
    by = {r["column_name"]: r for r in got.collect()}
    distinct = rows.select("n").distinct().count()
    assert by["k"]["distinct_estimate"] == 50 and abs(by["n"]["distinct_estimate"] - distinct) <= 0.03 * distinct
    median = rows.approxQuantile("n", [0.5], 0)[0]
    assert abs(rows.where(f"n <= {by['n']['median_estimate']}").count() / rows.count() - 0.5) < 0.03 and median > 0
    assert by["v"]["median_estimate"] == 4.0
    assert ref_profile(ledger, "nothing").count() == 0
