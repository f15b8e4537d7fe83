"""Corpus preparation: five stages from raw documents to a weighted mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``; a stage may then delete what the one before has left.  All but the last return the columns of documents; the last one adds ``mix_copies``, how often
the mix takes a document.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from civiclake.llm import decontaminate, language, lines, mixing, nearsets, storage


def _stage(function):
    """A stage begins when the result of the one before is written, so it removes the intermediate tables of that one."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with storage.stage(spark):
            return function(spark, docs, sf_dir)

    return run_stage


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go."""
    return language.accepted_documents(docs, language.fit_text_model(docs))


@_stage
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of three lines, or of over 50 words, that have occurred before are cut out of the texts."""
    return lines.without_repeated_lines(docs, long_words=50)


@_stage
def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity 0.8 or more) stays.

    Candidates come from SimHash fingerprints met on their segment popcounts, those beyond two bits from MinHash bands.
    """
    return nearsets.drop_near_duplicates(docs)


@_stage
def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat benchmark items go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", remove_contaminated),
    ("mixing", mix_sources),
]

#: The near-duplicate and language stages have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    storage.keep_stages()
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        docs = storage.written(stage(spark, docs, sf_dir), name)
        storage.discard(*before)
        before = [docs]
    mixed = STAGES[-1][1](spark, docs, sf_dir)
    storage.keep_stages()
    return mixed
