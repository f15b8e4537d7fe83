"""One query per operator, with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprint, language, lines, merkle, mixing, oddsketch, perplexity, quality, simhash, suffixes, toxicity, trie

QUALITY_THRESHOLD = 0.3
TOXICITY_THRESHOLD = 0.5


def _read(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def _fold(doc_id: Column) -> Column:
    """Checksum of the id as text, modulo five (a null id: that of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def _judged(rows: DataFrame, threshold: float) -> DataFrame:
    doc_id = F.col("__row.doc_id")
    return rows.select(
        doc_id.alias("doc_id"), (_fold(doc_id) == 0).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"))


def op1_quality(spark: SparkSession, data_dir: str) -> DataFrame:
    documents = _read(spark, data_dir, "documents").select("doc_id", "text")
    weights = quality.quality_model(documents, _read(spark, data_dir, "labels"), _fold(F.col("doc_id")) != 0)
    return _judged(quality.quality_scores(documents, weights), QUALITY_THRESHOLD)


def op2_decontaminate(spark: SparkSession, data_dir: str) -> DataFrame:
    return decontaminate.contamination(_read(spark, data_dir, "documents"), _read(spark, data_dir, "benchmark"))


def op3_language(spark: SparkSession, data_dir: str) -> DataFrame:
    model = language.fit_text_model(_read(spark, data_dir, "documents"))
    return language.page_languages(_read(spark, data_dir, "pages"), model)


def op4_perplexity(spark: SparkSession, data_dir: str) -> DataFrame:
    documents = _read(spark, data_dir, "documents").select("doc_id", "text")
    held_out = _fold(F.col("doc_id")) == 1
    rows = perplexity.scores(documents, perplexity.fit(documents.filter(~held_out)))
    return rows.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_mixing(spark: SparkSession, data_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, data_dir, "documents"))


def op6_fingerprint(spark: SparkSession, data_dir: str) -> DataFrame:
    return fingerprint.fingerprint_report(_read(spark, data_dir, "documents"))


def op7_toxicity(spark: SparkSession, data_dir: str) -> DataFrame:
    documents = _read(spark, data_dir, "documents").select("doc_id", "text")
    weights = toxicity.toxicity_model(documents, _read(spark, data_dir, "labels"), _fold(F.col("doc_id")) != 0)
    return _judged(toxicity.toxicity_scores(documents, weights), TOXICITY_THRESHOLD)


def op8_simhash(spark: SparkSession, data_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, data_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    return lines.line_report(_read(spark, data_dir, "documents"))


def op10_suffixes(spark: SparkSession, data_dir: str) -> DataFrame:
    return suffixes.removal_report(_read(spark, data_dir, "documents"))


def op11_trie(spark: SparkSession, data_dir: str) -> DataFrame:
    return trie.trie_report(_read(spark, data_dir, "conversations"))


def op12_minhash(spark: SparkSession, data_dir: str) -> DataFrame:
    return oddsketch.near_report(_read(spark, data_dir, "documents"))


def op13_merkle(spark: SparkSession, data_dir: str) -> DataFrame:
    return merkle.tamper_report(_read(spark, data_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontaminate": op2_decontaminate,
    "op3_language": op3_language,
    "op4_perplexity": op4_perplexity,
    "op5_mixing": op5_mixing,
    "op6_fingerprint": op6_fingerprint,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_lines": op9_lines,
    "op10_suffixes": op10_suffixes,
    "op11_trie": op11_trie,
    "op12_minhash": op12_minhash,
    "op13_merkle": op13_merkle,
}

ORACLES = {"op5_mixing": mixing.ORACLE, "op9_lines": lines.ORACLE, "op11_trie": trie.ORACLE,
           "op12_minhash": oddsketch.ORACLE, "op13_merkle": merkle.ORACLE}
