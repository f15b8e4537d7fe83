"""Every registered query against its SQL, on the smallest data folder."""

import os
from decimal import Decimal

import pytest

import __spark_entry__ as entry_module
from civiclake.catalogue import ORACLES, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return con


def canonical(rows):
    def text(v):
        if v is None:
            return "\0"
        if isinstance(v, float):
            return repr(round(v, 6))
        if isinstance(v, Decimal):
            return format(v, "f")
        return str(v)

    return sorted(tuple(text(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sql, name):
    df = entry_module.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    relation = sql.sql(entry_module.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    want = canonical(tuple(r[i] for i in order) for r in relation.fetchall())
    assert canonical(tuple(r) for r in df.select(*columns).collect()) == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "valor_documento" in df.columns
