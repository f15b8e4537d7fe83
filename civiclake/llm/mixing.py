"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis).

Everything is DataFrame operations.  A document gets an exponential key ``-ln(u) / weight`` with ``u`` from a digest
of its id, so reruns agree.  A source's target is filled by complete epochs first; the rest goes to the documents
with the smallest keys, up to the word budget.  Prefix sums do not sort a source: sizes are summed per bin of the
logarithm of the key (1024 bins per doubling hold under 0.1 % of a source each, whatever the weights),
bins are prefix-summed, and only the bin in which the budget ends is sorted row by row.

Defined results: a null or empty text has size 0 and takes part with 0 words; a null source is a source of its own, the
last; repeated rows are separate documents; a null id counts as an empty one in the key; an empty
table gives no rows; a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import discard, kept_rows, numbered, unpacked, written

EPOCHS = 3
BINS_PER_DOUBLING = 1024
#: Characters that lower a document's quality weight, and the least weight.
SYMBOLS = "!$%&#*|"
LEAST_WEIGHT = 0.25


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """One less four times the share of symbols among the characters, ``LEAST_WEIGHT`` at least (no text: 1)."""
    plain = F.length(F.translate(text, SYMBOLS, "")).cast("double")
    total = F.length(text).cast("double")
    share = F.when(total > 0, (total - plain) / total).otherwise(F.lit(0.0))
    return F.greatest(F.lit(1.0) - F.lit(4.0) * F.coalesce(share, F.lit(0.0)), F.lit(LEAST_WEIGHT))


def sampling_key(doc_id: Column, weight: Column) -> Column:
    """Exponential variate of rate ``weight``: 52 bits of the id's MD5 make the uniform variate."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(uniform) / weight


def keyed(rows: DataFrame) -> DataFrame:
    """``rows (__rid, doc_id, source, text)`` with size, sampling key and bin of the key."""
    out = rows.withColumns(
        {"__size": word_count(F.col("text")), "__key": sampling_key(F.col("doc_id"), quality_weight(F.col("text")))})
    return out.withColumn("__bin", F.floor(F.log2("__key") * BINS_PER_DOUBLING).cast("long"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets of ``(source, source_size)``, one row per source.

    Weights 1, 2, 3 repeat over the sources in code point order.  Sources are capped in the order in which a
    rising level of words per weight reaches their caps, so one pass over the sorted sources finds the level.
    The windows hold one small row per source.
    """
    ranked = sizes.withColumn(
        "weight", 1 + (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3)
    ranked = ranked.withColumn("cap", F.col("source_size") * EPOCHS)
    by_ratio = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = ranked.withColumn("level", left.cast("double") / weights.cast("double"))
    capped = F.col("level") > F.col("cap").cast("double") / F.col("weight")
    level = F.max(F.when(~capped, F.col("level"))).over(whole)
    return levels.select(
        "source", "source_size",
        F.when(capped, F.col("cap").cast("double")).otherwise(level * F.col("weight")).alias("target"))


def mixing_plan(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``(__rid, doc_id, source, __size, __key, __bin)``: a row per source, and the rows chosen in its last bin.

    A source has ``source_size``, ``target``, complete ``epochs`` and the bin ``cut`` in which the rest of its budget
    ends; all documents of smaller bins are taken once more.
    """
    bins = rows.groupBy("source", "__bin").agg(F.sum("__size").alias("bin_size"))
    targets = source_targets(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")))
    targets = targets.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    running = bins.withColumn("upto", F.sum("bin_size").over(
        Window.partitionBy("source").orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)))
    t, b = targets.alias("t"), running.alias("b")
    crossing = t.join(b, F.expr("t.source <=> b.source and b.upto - b.bin_size <= t.rest and b.upto > t.rest"), "left")
    plan = written(crossing.select(
        "t.source", "t.source_size", "t.target", "t.epochs", "t.rest", F.col("b.__bin").alias("cut"),
        (F.col("b.upto") - F.col("b.bin_size")).alias("before")), "mix-plan")
    r, p = rows.alias("r"), plan.alias("p")
    last = r.join(p, F.expr("r.source <=> p.source and r.__bin = p.cut")).select("r.*", "p.rest", "p.before")
    prior = F.col("before") + F.coalesce(F.sum("__size").over(
        Window.partitionBy("source").orderBy("__key", "doc_id", "__rid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = last.withColumn("prior", prior).filter(2 * F.col("prior") + F.col("__size") <= 2 * F.col("rest"))
    return plan, written(chosen.select("__rid"), "mix-cut")


def with_copies(rows: DataFrame, plan: DataFrame, chosen: DataFrame) -> DataFrame:
    """Keyed rows with their source's plan and ``copies``, how often the mix takes the document."""
    r, p = rows.alias("r"), plan.alias("p")
    joined = r.join(p, F.expr("r.source <=> p.source")).select("r.*", "p.source_size", "p.target", "p.epochs", "p.cut")
    joined = joined.join(chosen.withColumn("__chosen", F.lit(1)), "__rid", "left")
    again = (F.col("__bin") < F.col("cut")) | F.col("__chosen").isNotNull()
    return joined.withColumn("copies", F.col("epochs") + F.when(again, 1).otherwise(0))


def mix(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    rows = written(keyed(numbered(documents.select("doc_id", "source", "text"))).drop("text"), "mix-rows")
    out = with_copies(rows, *mixing_plan(rows))
    return out.select(
        "doc_id", F.col("__size").alias("size"), "source_size", "target",
        (F.col("copies") * F.col("__size")).alias("taken"))


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The documents that the mix takes, each with ``mix_copies``, the number of its copies."""
    documents = documents.select(*[F.col(f"`{c}`") for c in documents.columns if c.lower() != "mix_copies"])
    frame = kept_rows(documents, "mix-documents")
    rows = written(keyed(frame.select("__rid", "__row.doc_id", "__row.source", "__row.text")).drop("text"), "mix-rows")
    copies = with_copies(rows, *mixing_plan(rows)).filter("copies > 0")
    copies = written(copies.select("__rid", F.col("copies").alias("mix_copies")), "mix-copies")
    discard(rows)
    return frame.join(copies.hint("merge"), "__rid").select(*unpacked(documents), "mix_copies")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         -ln((CAST(CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))
           / greatest(CAST(1 AS DOUBLE) - CAST(4 AS DOUBLE) * coalesce(CASE WHEN length(text) > 0 THEN
               (CAST(length(text) AS DOUBLE) - CAST(length(translate(text, '{SYMBOLS}', '')) AS DOUBLE)) / CAST(length(text) AS DOUBLE)
               ELSE CAST(0 AS DOUBLE) END, CAST(0 AS DOUBLE)), CAST({LEAST_WEIGHT} AS DOUBLE)) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, source_size * {EPOCHS} AS cap FROM s),
l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM w WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, CASE WHEN level > CAST(cap AS DOUBLE) / weight THEN CAST(cap AS DOUBLE)
    ELSE max(CASE WHEN level <= CAST(cap AS DOUBLE) / weight THEN level END) OVER () * weight END AS target
  FROM l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
p AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN 2 * prior + size <= 2 * rest AND source_size > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""
