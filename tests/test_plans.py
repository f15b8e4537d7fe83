"""Shape of the physical plans."""

import os

import pytest

from civiclake.catalogue import QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")

PYTHON_BY_DESIGN = {"zip_csv_unpack", "xml_profile", "xml_profile_json"}  # archives are opened in Python


def plan(spark, name):
    df = QUERIES[name](spark, DATA)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["silver_dedupe_latest", "bronze_latest_by_key", "silver_emendas"])
def test_dedupe_limits_groups_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["execution_rollup", "phase_pivot", "value_counts", "dup_keys", "completeness_profile",
                                  "batch_diff", "truncation_audit", "null_counts"])
def test_aggregations_combine_map_side(spark, name):
    text = plan(spark, name)
    assert "partial_" in text


@pytest.mark.parametrize("name", ["phase_pivot", "execution_rollup", "batch_diff", "dup_keys"])
def test_one_shuffle(spark, name):
    assert plan(spark, name).count("Exchange ") == 1


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "year_window")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<doc_id:bigint,source:string,n_chars:bigint>" in plan(spark, "offset_slice")
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id" in plan(spark, "offset_slice")


def test_profile_is_one_scan_per_table(spark):
    text = plan(spark, "not_null_report")
    assert text.count("FileScan parquet") == 2  # documents and labels


def test_no_python_outside_archives(spark):
    for name, fn in QUERIES.items():
        if name in PYTHON_BY_DESIGN:
            continue
        text = fn(spark, DATA)._jdf.queryExecution().executedPlan().toString()
        for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert operator not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_colocated_registries_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = QUERIES["partner_network_repeats"](spark, DATA)
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and text.count("Join") == 2 and df.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
