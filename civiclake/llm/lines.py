"""Line dedup by winnowing over line hashes, in DataFrame operations only.

A document is the sequence of its lines that are not blank.  Of every ``RUN`` neighbouring lines the one with
the smallest hash (the last of equal ones) is a fingerprint, so two places that share ``RUN`` lines share a fingerprint
at the same distance.  Fingerprints that occur once end here.  The others are joined by hash and extended both ways to the
runs of ``RUN`` lines around them; a run that has occurred before, in an earlier document or further up in the same
one, is a later repeat, and all lines that later repeats cover are deleted.  Groups are reduced to their first occurrence
before they are joined, so nothing grows with the square of a group.

With ``long_words`` a later repeat of one or two lines counts too if it has more words than that: such lines and pairs of lines join
the same first-occurrence aggregation.  ``line_report`` follows its SQL, which knows runs of ``RUN`` lines only.

Documents count in the order of their ids (null first), repeated rows in the order of the table.
Defined results: blank lines are never deleted; texts of fewer than ``RUN`` lines (without ``long_words``), null and
empty texts stay as they are; a text may become empty; all columns are kept, extra ones too, and ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import discard, kept_rows, written

RUN = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _filled(lines: Column) -> Column:
    """Numbers of the lines that are not blank."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: lines[i].rlike(r"[^\x20\x09-\x0D]"))


def fingerprint_rows(documents: DataFrame) -> DataFrame:
    """``(__rid, doc_id, hash, lines, around)``: winnowed fingerprints with the lines around each.

    ``lines`` and ``around`` have the numbers and hashes of the lines that are not blank, ``RUN - 1`` to each side as far as
    the document reaches.
    """
    rows = documents.select("__rid", "doc_id", _lines(F.col("text")).alias("l"))
    rows = rows.select("__rid", "doc_id", "l", _filled(F.col("l")).alias("i")).filter(F.size("i") >= RUN)
    rows = rows.select("__rid", "doc_id", "i", F.transform("i", lambda i: F.xxhash64(F.col("l")[i])).alias("h"))
    windows = F.sequence(F.lit(0), F.size("h") - RUN)
    lowest = F.transform(windows, lambda s: F.array_min(F.transform(
        F.sequence(s, s + RUN - 1), lambda k: F.struct(F.col("h")[k].alias("hash"), (-k).alias("back")))))
    rows = rows.select("__rid", "doc_id", "i", "h", F.explode(F.array_distinct(lowest)).alias("f"))
    first = F.greatest(-F.col("f.back") - (RUN - 1), F.lit(0))
    length = -F.col("f.back") + RUN - first
    return rows.select("__rid", "doc_id", F.col("f.hash").alias("hash"),
                       F.slice("i", first + 1, length).alias("lines"), F.slice("h", first + 1, length).alias("around"))


def long_runs(documents: DataFrame, words: int) -> DataFrame:
    """``(__rid, doc_id, lines, run)``: runs of fewer than ``RUN`` lines that are not blank, with more than ``words`` words."""
    rows = documents.select("__rid", "doc_id", _lines(F.col("text")).alias("l"))
    rows = rows.select("__rid", "doc_id", "l", _filled(F.col("l")).alias("i")).filter(F.size("i") > 0)
    rows = rows.select("__rid", "doc_id", "i", F.transform("i", lambda i: F.xxhash64(F.col("l")[i])).alias("h"),
                       F.transform("i", lambda i: F.regexp_count(F.col("l")[i], F.lit(r"[^\x20\x09-\x0D]+"))).alias("n"))

    def runs(size: int) -> Column:
        def total(s: Column) -> Column:  # null where the run would end beyond the text
            return sum((F.get("n", s + k) for k in range(1, size)), F.get("n", s))

        starts = F.filter(F.sequence(F.lit(0), F.size("i") - 1), lambda s: total(s) > words)
        return F.transform(starts, lambda s: F.struct(s.alias("s"), F.lit(size).alias("size")))

    rows = rows.select("__rid", "doc_id", "i", "h", F.explode_outer(F.concat(*[runs(k) for k in range(1, RUN)])).alias("r"))
    return rows.filter("r IS NOT NULL").select(
        "__rid", "doc_id", F.slice("i", F.col("r.s") + 1, F.col("r.size")).alias("lines"),
        F.xxhash64(F.slice("h", F.col("r.s") + 1, F.col("r.size"))).alias("run"))


def later_repeats(documents: DataFrame, long_words: int | None = None) -> DataFrame:
    """``(__rid, gone)``: the lines of each document that runs cover which have occurred before."""
    rows = written(fingerprint_rows(documents), "line-fingerprints")
    several = rows.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    found = rows.join(several, "hash", "left_semi")
    starts = F.sequence(F.lit(0), F.size("around") - RUN)
    runs = found.select("__rid", "doc_id", "lines", "around", F.explode(starts).alias("s")).select(
        "__rid", "doc_id", F.slice("lines", F.col("s") + 1, RUN).alias("lines"),
        F.xxhash64(F.slice("around", F.col("s") + 1, RUN)).alias("run")).distinct()
    if long_words is not None:
        runs = runs.union(long_runs(documents, long_words))
    runs = written(runs, "line-runs")
    discard(rows)
    place = F.struct("doc_id", "__rid", F.col("lines")[0])
    origin = runs.groupBy("run").agg(F.min(place).alias("origin"), F.count("*").alias("n")).filter("n > 1")
    later = runs.join(origin.select("run", "origin"), "run").filter(place > F.col("origin"))
    repeats = written(later.groupBy("__rid").agg(
        F.array_distinct(F.flatten(F.collect_list("lines"))).alias("gone")), "line-repeats")
    discard(runs)
    return repeats


def dedup_lines(documents: DataFrame, long_words: int | None = None) -> DataFrame:
    """``(__row, __text, __lines, __deleted)``: the documents, each text without its later repeated runs, line counts."""
    frame = kept_rows(documents, "line-documents")
    repeats = later_repeats(frame.select("__rid", "__row.doc_id", "__row.text"), long_words)
    packed = frame.select("__rid", "__row.text", "__row")
    # the lines are a layer of their own, so that a text is split once and not for each of its lines
    # always a merge join, so that the plan (and what it moves) is the same at every size
    rows = packed.join(repeats.hint("merge"), "__rid", "left").select("__row", "text", "gone", _lines(F.col("text")).alias("l"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("l") - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.col("l")[i]), "\n"))
    return rows.select(
        "__row", text.alias("__text"), F.when(F.col("text").isNull(), 0).otherwise(F.size("l")).cast("long").alias("__lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("__deleted"))


def without_repeated_lines(documents: DataFrame, long_words: int | None = None) -> DataFrame:
    """The documents with the columns they had, ``text`` (and ``n_chars``) after line dedup."""
    out = dedup_lines(documents, long_words)

    def column(name: str) -> Column:
        if name.lower() == "text":
            return F.col("__text").alias(name)
        old = F.col("__row")[name]
        if name.lower() == "n_chars":
            kind = documents.schema[name].dataType
            return F.when(F.col("__deleted") > 0, F.length("__text").cast(kind)).otherwise(old).alias(name)
        return old.alias(name)

    return out.select(*[column(c) for c in documents.columns])


def line_report(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_lines, n_deleted, kept_sha256`` (of the remaining text; a null text counts as empty)."""
    return dedup_lines(documents.select("doc_id", "text")).select(
        F.col("__row.doc_id").alias("doc_id"), F.col("__lines").alias("n_lines"), F.col("__deleted").alias("n_deleted"),
        F.sha2(F.coalesce("__text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
f AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS o
  FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
w AS (
  SELECT doc_id, o, [line, lead(line, 1) OVER x, lead(line, 2) OVER x] AS run, lead(o, {RUN - 1}) OVER x AS last
  FROM f WINDOW x AS (PARTITION BY doc_id ORDER BY o)),
r AS (
  SELECT doc_id, o, row_number() OVER (PARTITION BY run ORDER BY doc_id, o) AS nth FROM w WHERE last IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, o + k AS o FROM r, generate_series(0, {RUN - 1}) AS g(k) WHERE nth > 1),
kept AS (
  SELECT l.doc_id, l.line, l.i, gone.o IS NOT NULL AS deleted
  FROM l LEFT JOIN f ON f.doc_id = l.doc_id AND f.i = l.i LEFT JOIN gone ON gone.doc_id = f.doc_id AND gone.o = f.o),
t AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE deleted) AS n_deleted,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT deleted), '') AS text
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_deleted, 0) AS n_deleted,
       sha256(coalesce(t.text, '')) AS kept_sha256
FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id
"""
