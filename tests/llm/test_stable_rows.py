"""Results do not change if cores come or go between the scans of an operator."""

import pytest

from civiclake.llm import language, lines, mixing, nearsets, oddsketch, simhash, suffixes
from tests.llm import data

OPERATORS = {
    "lines": lines.line_report,
    "long lines": lambda d: lines.without_repeated_lines(d, long_words=50),
    "suffixes": suffixes.removal_report,
    "mixing": mixing.mixed_documents,
    "language": lambda d: language.accepted_documents(d, language.fit_text_model(d)),
    "near": nearsets.drop_near_duplicates,
    "simhash": simhash.drop_near_duplicates,
    "odd": oddsketch.near_report,
}


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("files") / "documents.parquet")
    docs = spark.createDataFrame([(*r, r[0], "s", "k") for r in data.documents(120)], data.SCHEMA + ", __rid long, __size string, __key string")
    docs.repartition(8).write.parquet(folder)
    return folder


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_parallelism_may_change_between_call_and_collect(spark, path, name):
    def run(*parallelism):
        try:
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", parallelism[0])
            out = OPERATORS[name](spark.read.parquet(path))
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", parallelism[1])
            return sorted((tuple(r) for r in out.collect()), key=str), out.columns
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")

    rows, columns = run(1, 8)
    assert (rows, columns) == run(1, 1)
    if name in ("long lines", "mixing", "language", "near", "simhash"):  # columns of any name are kept
        assert {"__rid", "__size", "__key"} <= set(columns) and all(r[columns.index("__size")] == "s" for r in rows)
