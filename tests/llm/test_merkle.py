"""Merkle manifests against a plain version, for runs of three and of two, and positions in groups of any size."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from civiclake.llm import merkle, ranks

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, pos long, n long, hash string, steps string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def tree(hashes, arity=3):
    """The root, and the steps (before, behind) of every leaf."""
    steps, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for i in range(len(hashes)):
            run = at[i] - at[i] % arity
            steps[i].append(("".join(level[run:at[i]]), "".join(level[at[i] + 1:run + arity])))
        level = [h(*level[k:k + arity]) for k in range(0, len(level), arity)]
        at = [x // arity for x in at]
    return level[0], steps


def report(rows, arity=3):
    out, groups = [], {}
    for source, members in itertools.groupby(sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode())), lambda r: r[1]):
        def order(r):
            return r[0] is not None, r[0] or 0, leaf(r), leaf(now(r))
        members = sorted(members, key=order)
        groups[source] = members, *tree([leaf(r) for r in members], arity)
    root, above = tree([g[1] for g in groups.values()], arity)
    for (members, subroot, steps), top in zip(groups.values(), above):
        for row, own in zip(members, steps):
            end = leaf(now(row))
            for left, right in own + top:
                end = h(left, end, right)
            out.append((row[0], leaf(row), subroot, root, h(*(x for s in own + top for x in s)), end, end == root))
    return sorted(out, key=str)


def now(row):
    even = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 2 == 0
    text = row[4].replace("\n", "") if even and row[4] is not None else row[4]
    return (*row[:4], text)


def rows_of(count, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        text = rng.choice([None, "", "é\nb", f"line {i}\nmore", f"plain {i}", "x\n" * 3000])
        source = rng.choice([None, "", "a", "a", "a", "b", "Z", "ü", f"only {i}" if i % 9 == 0 else "a"])
        rows.append((rng.choice([i, i, i, None, -i]), source, rng.choice(["en", None]), rng.choice([None, len(text or "")]), text,
                     7, 8, 9, "h", "s"))
    return rows + rows[:3]


@pytest.mark.parametrize("count", [1, 2, 60])
def test_report_against_plain_python(spark, count):
    rows = rows_of(count)
    got = merkle.tamper_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == report(rows)
    if count > 2:
        assert 0 < sum(r.verified for r in got) < len(got)


def test_runs_of_two_flip_the_last_bit(spark):
    rows = [(i, "ab"[i % 7 > 2], None, None, f"t{i}") for i in range(23)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    values = {c: F.col(c) for c in merkle.FIELDS}
    found = merkle.manifest(frame, {"leaf": merkle.leaf_of(values)}, arity=2)
    got = found.select("doc_id", "subroot", "root", merkle.proof(F.col("steps")), merkle.folded(F.col("leaf"), F.col("steps")) == F.col("root"))
    want = [(r[0], r[2], r[3], r[4], True) for r in report(rows, 2)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_empty_table_and_size_of_plans(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert merkle.tamper_report(frame).count() == 0
    plan = merkle.with_siblings(spark.createDataFrame([(0, 0, 2, "x")], "tree long, pos long, n long, hash string"), 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Window" not in text and "Cartesian" not in text


def test_positions_across_ranges(spark):
    rows = [(None if i % 10 == 0 else "hot" if i % 3 else f"g{i % 7}", (i * 37) % 1000) for i in range(1000)]
    got = ranks.positions(spark.createDataFrame(rows, "g string, v int").repartition(7), "g", [F.col("v")], "t").collect()
    want = []
    for g in {r[0] for r in rows}:
        values = sorted(v for k, v in rows if k == g)
        want += [(g, v, i, len(values)) for i, v in enumerate(values)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
