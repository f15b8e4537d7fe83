"""Language identification by Bayesian fusion of evidence.

The posterior of a language is the product of four parts:
the prior of the host, smoothed towards that of its domain, which is smoothed towards that of all rows;
the likelihood of the text under byte-trigram counts of the language; the likelihood of the declared language;
and that of the address suffix.  The counts behind the last two and the priors are grouped aggregations over all rows,
by the language that the text alone points to.  Trigrams of a text depend on each other, so a text counts as at most
``EVIDENCE`` of them.

Beside the languages stands the unknown, under which every trigram is as likely as any other.  It takes part in the same fusion, counts of
hosts and values included, so a text that no language explains better than that is rejected, whatever it declares.

Defined results: missing evidence (null) counts for nothing; a text without letters has no language, probability zero,
and is rejected; a text of the unknown has none either and the probability of its best language; beyond the ``MOST_LANGUAGES`` with the
most text, languages are one, ``POOLED``; documents without a column ``lang`` or ``source`` have no such evidence; ties go to the first language by code point; repeated rows are judged alike but count once each
in the aggregations; with no labelled training text everything is rejected; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import kept_rows, numbered, unpacked, written
from .tokens import LOWER, NOT_ALNUM, joined, list_array, slices, with_text_columns

BUCKET_BITS = 14
#: Languages with a model of their own, and the name of all others together.
MOST_LANGUAGES, POOLED = 256, "mis"
#: Share of texts that are taken to be of no language before anything is counted.
UNKNOWN = 0.001
EVIDENCE = 40
#: A text with fewer trigrams does not count in the aggregations.
LEAST_TRIGRAMS = 20
#: Weight, in rows, of the level above in a smoothed prior, and of an unseen value in a likelihood.
PRIOR_ROWS, UNSEEN = 20.0, 0.5
LEAST_PROBABILITY = 0.5

_LETTER = np.where(NOT_ALNUM | ((np.arange(256) >= 0x30) & (np.arange(256) <= 0x39)), 0x20, LOWER).astype(np.uint8)


def trigrams(texts: list[bytes], markup: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per byte: trigram bucket and whether it counts; and where each text begins.

    With ``markup``, bytes between ``<`` and ``>`` are no text.
    """
    data, begin = joined(texts)
    letter = _LETTER[data]
    if markup:
        at = np.arange(len(data))
        opened = np.maximum.accumulate(np.where(data == 0x3C, at, -1))
        closed = np.maximum.accumulate(np.where(data == 0x3E, at, -1))
        first = np.repeat(begin[:-1], np.diff(begin))
        letter[(opened >= first) & (opened > closed) | (data == 0x3E)] = 0x20
    padded = np.concatenate(([0x20], letter, [0x20])).astype(np.uint32)
    code = (padded[:-2] << 16) | (padded[1:-1] << 8) | padded[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS), letter != 0x20, begin


@dataclass
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # language (and, last, the unknown), bucket


def fit_text_model(documents: DataFrame, language: str = "lang", text: str = "text") -> LanguageModel:
    """Trigram counts of every text that has a language, summed within tasks and then over the table."""

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0)
            for at, texts in slices(batch.column(1)):
                bucket, used, begin = trigrams(texts)
                group = names.slice(at, len(texts)).dictionary_encode()
                per_byte = np.repeat(group.indices.to_numpy(zero_copy_only=False), np.diff(begin))
                for i, name in enumerate(group.dictionary.to_pylist()):
                    n = np.bincount(bucket[used & (per_byte == i)], minlength=1 << BUCKET_BITS)
                    totals[name] = totals[name] + n if name in totals else n
        for name, n in totals.items():
            there = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(there), pa.string()), pa.array(there.astype(np.int32)), pa.array(n[there])],
                names=["language", "bucket", "n"])

    known = documents.filter(F.col(language).isNotNull()).select(F.col(language).cast("string"), text)
    counts = known.mapInArrow(count, "language string, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    counts = written(counts, "language-counts")
    by_size = counts.groupBy("language").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "language")
    largest = [r[0] for r in by_size.limit(MOST_LANGUAGES).collect()]
    pooled = counts.groupBy(F.when(F.col("language").isin(largest), F.col("language")).otherwise(POOLED).alias("language"), "bucket").agg(
        F.sum("n").alias("n"))
    rows = pooled.toPandas()  # at most a number per bucket and language that is kept
    languages = sorted(set(rows["language"]))
    table = np.full((len(languages) + 1, 1 << BUCKET_BITS), 0.1)
    table[[languages.index(x) for x in rows["language"]], rows["bucket"].to_numpy()] += rows["n"].to_numpy()
    return LanguageModel(languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def with_text_evidence(frame: DataFrame, text: str, model: LanguageModel, markup: bool = False) -> DataFrame:
    """``(__row, __trigrams, __evidence)``: log-likelihood of every whole text by language and under the unknown."""
    shared = frame.sparkSession.sparkContext.broadcast(model.log_probability)

    def score(texts: list[bytes]) -> list[pa.Array]:
        table = shared.value
        bucket, used, begin = trigrams(texts, markup)
        n = np.add.reduceat(used.astype(np.int64), begin[:-1])
        out = np.empty((len(texts), len(table)))
        for i, row in enumerate(table):
            total = np.add.reduceat(np.where(used, row[bucket], np.float32(0)).astype(np.float64), begin[:-1])
            out[:, i] = total / np.maximum(n, 1) * np.minimum(n, EVIDENCE)
        return [pa.array(n), list_array(out.ravel(), np.full(len(texts), len(table)))]

    added = T.StructType().add("__trigrams", T.LongType()).add("__evidence", T.ArrayType(T.DoubleType()))
    return with_text_columns(frame, text, added, score)


def _tally(guess: Column, k: int) -> Column:
    return F.array(*[F.sum((guess == i).cast("double")) for i in range(k)])


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _blend(counts: Column, prior: Column) -> Column:
    """Counts smoothed towards a prior."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x) + PRIOR_ROWS
    return F.zip_with(counts, prior, lambda n, p: (n + PRIOR_ROWS * p) / total)


def _value_evidence(rows: DataFrame, column: str, k: int) -> DataFrame:
    """``(column, log)``: log-likelihood of each value of a column by language."""
    by_value = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(_tally(F.col("guess"), k).alias("n"))
    by_value = written(by_value, f"language-{column}")
    *totals, values = by_value.agg(*[F.coalesce(F.sum(F.col("n")[i]), F.lit(0.0)) for i in range(k)], F.count("*")).first()
    smoothed = [F.log((F.col("n")[i] + UNSEEN) / (t + UNSEEN * (values + 1))) for i, t in enumerate(totals)]
    return by_value.select(column, F.array(*smoothed).alias(f"{column}_log"))


def identify(evidence: DataFrame, languages: list[str]) -> DataFrame:
    """Fuse ``(__rid, host, domain, suffix, declared, trigrams, evidence)``, one narrow row per text.

    Gives ``(__rid, language, probability, text_language, accepted)``.
    """
    k = len(languages) + 1
    if k == 1:
        return evidence.select("__rid", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("probability"),
                               F.lit(None).cast("string").alias("text_language"), F.lit(False).alias("accepted"))
    best = F.array_position(F.col("evidence"), F.array_max("evidence")).cast("int") - 1
    rows = written(evidence.withColumn("guess", F.when(F.col("trigrams") > 0, best)), "language-evidence")
    sure = rows.filter(F.col("trigrams") >= LEAST_TRIGRAMS)

    by_host = written(sure.groupBy("host", "domain").agg(_tally(F.col("guess"), k).alias("n")), "language-hosts")
    counted = by_host.agg(*[F.coalesce(F.sum(F.col("n")[i]), F.lit(0.0)) for i in range(k)]).first()
    expected = [(1 - UNKNOWN) / (k - 1)] * (k - 1) + [UNKNOWN]
    overall = F.array(*[F.lit((n + PRIOR_ROWS * p) / (sum(counted) + PRIOR_ROWS)) for n, p in zip(counted, expected)])
    domains = by_host.groupBy("domain").agg(F.array(*[F.sum(F.col("n")[i]) for i in range(k)]).alias("m"))
    domains = domains.select(F.col("domain").alias("d"), F.when(F.col("domain").isNull(), overall).otherwise(
        _blend(F.col("m"), overall)).alias("above"))
    h = by_host.alias("h").join(domains, F.expr("domain <=> d"))
    hosts = written(h.select(
        F.col("h.host").alias("__host"), F.col("h.domain").alias("__domain"),
        F.when(F.col("h.host").isNull(), F.col("above")).otherwise(_blend(F.col("n"), F.col("above"))).alias("prior")), "language-priors")
    values = {c: _value_evidence(sure, c, k) for c in ("declared", "suffix")}

    fused = rows.join(hosts, F.expr("host <=> __host and domain <=> __domain"), "left")
    for c, table in values.items():
        fused = fused.join(table, c, "left")
    nothing = F.array(*[F.lit(0.0)] * k)
    score = _plus(F.col("evidence"), F.transform(F.coalesce(F.col("prior"), overall), lambda p: F.log(p)))
    for c in values:
        score = _plus(score, F.coalesce(f"{c}_log", nothing))
    fused = fused.select("__rid", "guess", "trigrams", score.alias("score"))
    top, best = F.array_max("score"), F.array_max(F.slice("score", 1, k - 1))
    fused = fused.withColumn("probability", F.exp(best - top) / F.aggregate(
        F.transform("score", lambda s: F.exp(s - top)), F.lit(0.0), lambda a, x: a + x))
    names = F.array(*[F.lit(x) for x in languages], F.lit(None).cast("string"))
    found = F.col("trigrams") > 0
    return fused.select(
        "__rid", F.when(found, names[(F.array_position("score", top) - 1).cast("int")]).alias("language"),
        F.when(found, F.col("probability")).otherwise(0.0).alias("probability"),
        F.when(found, names[F.col("guess")]).alias("text_language"),
        (found & (best == top) & (F.col("probability") >= LEAST_PROBABILITY)).alias("accepted"))


def _host(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def page_languages(pages: DataFrame, model: LanguageModel) -> DataFrame:
    """Language of every page from its text, ``<html lang>``, address suffix and host."""
    host = _host(F.col("url"))
    labels = F.split(host, r"\.")
    declared = F.lower(F.regexp_extract(F.col("html"), r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    frame = numbered(pages.select("page_id", "url", "html")).select(
        "__rid", "page_id", "html", host.alias("host"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("domain"),
        F.element_at(labels, -1).alias("suffix"), F.when(declared != "", declared).alias("declared"))
    evidence = written(with_text_evidence(frame, "html", model, markup=True).select(
        *[F.col("__row")[c].alias(c) for c in ("__rid", "page_id", "host", "domain", "suffix", "declared")],
        F.col("__trigrams").alias("trigrams"), F.col("__evidence").alias("evidence")), "page-evidence")
    found = identify(evidence.drop("page_id"), model.languages)
    return evidence.select("__rid", "page_id", "declared").join(found, "__rid").drop("__rid")


def accepted_documents(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents with an accepted language; ``lang`` counts as declared, ``source`` as the host."""
    frame = kept_rows(documents, "language-documents")
    none = F.lit(None).cast("string")

    def said(name: str) -> Column:
        return F.col("__row")[name].cast("string") if name in documents.columns else none

    narrow = frame.select("__rid", "__row.text", said("source").alias("host"), none.alias("domain"),
                          none.alias("suffix"), F.lower(said("lang")).alias("declared"))
    evidence = with_text_evidence(narrow, "text", model).select(
        *[F.col("__row")[c].alias(c) for c in ("__rid", "host", "domain", "suffix", "declared")],
        F.col("__trigrams").alias("trigrams"), F.col("__evidence").alias("evidence"))
    rejected = written(identify(evidence, model.languages).filter(~F.col("accepted")).select("__rid"), "language-rejected")
    return frame.join(rejected, "__rid", "left_anti").select(*unpacked(documents))
