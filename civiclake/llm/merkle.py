"""Merkle manifest of a table: a tree per group of rows, and one over the groups' roots.

Every level is made by sibling-shift self-joins: a node is joined with the nodes at its computed sibling indices (the index with
its last bit flipped for runs of two, the other slots of its run otherwise), and the rows in slot zero emit the parents.
Proofs come back down: a node's steps are the siblings of its own level before the steps of its parent, so a level is joined with
the one above it, a third of its size, and no leaf is carried through all levels.  All hashing is done by built-in functions, on
rows of a few digests; texts are read once, for the leaves.

Defined results: a null field is hashed as ``-``, an empty one as ``0:``; a null group is a tree of its own, the first; rows of
one key are ordered by their leaf, so repeated rows are neighbouring leaves with proofs of their own; a null key comes first;
a tree of one row is its leaf; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import positions
from .sqltext import CRC32
from .storage import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3

_STEP = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def sibling(pos: Column, shift: int, arity: int) -> Column:
    """Index of another node of the run, ``shift`` slots on and around."""
    if arity == 2:
        return pos.bitwiseXOR(F.lit(1).cast("long"))
    slot = pos % arity
    return pos - slot + (slot + shift) % arity


def with_siblings(level: DataFrame, arity: int) -> DataFrame:
    """``(tree, pos, n, hash, left, right)`` of a level ``(tree, pos, n, hash)``: the digests before and behind in the run."""
    out, left, right = level, F.lit(""), F.lit("")
    # merge joins at every size, so that a plan does not change with the number of rows
    for shift in range(1, arity):
        other = level.select(F.col("tree").alias("__tree"), F.col("pos").alias(f"__pos{shift}"), F.col("hash").alias(f"__hash{shift}"))
        at = sibling(F.col("pos"), shift, arity)
        out = out.join(other.hint("merge"), (F.col("tree") == F.col("__tree")) & (at == F.col(f"__pos{shift}")), "left").drop("__tree")
    slots = F.array(*[F.struct(F.col(f"__pos{s}").alias("at"), F.col(f"__hash{s}").alias("hash")) for s in range(1, arity)])
    ordered = F.array_sort(F.filter(slots, lambda s: s["at"].isNotNull()))

    def side(test) -> Column:
        return F.array_join(F.transform(F.filter(ordered, test), lambda s: s["hash"]), "")

    left, right = side(lambda s: s["at"] < F.col("pos")), side(lambda s: s["at"] > F.col("pos"))
    return out.select("tree", "pos", "n", "hash", left.alias("left"), right.alias("right"))


def climb(leaves: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """From leaves ``(tree, pos, n, hash)`` up: the levels with siblings, and ``(tree, level, hash)`` of every tree's root."""
    levels, roots, level = [], [], leaves
    most = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(level.filter("n = 1").select("tree", F.lit(len(levels)).alias("level"), "hash"))
        if most <= 1:
            break
        most = -(-most // arity)
        whole = written(with_siblings(level.filter("n > 1"), arity), f"{name}-level")
        levels.append(whole)
        level = whole.filter(F.col("pos") % arity == 0).select(
            "tree", F.floor(F.col("pos") / arity).alias("pos"), F.ceil(F.col("n") / arity).alias("n"),
            digest(F.col("hash"), F.col("right")).alias("hash"))
    return levels, written(reduce(DataFrame.union, roots), f"{name}-roots")


def descend(levels: list[DataFrame], above: DataFrame, arity: int, name: str) -> DataFrame:
    """``(tree, pos, steps, *carried)`` of every leaf, from ``above (tree, level, steps, *carried)`` of every tree's root.

    ``steps`` lists the digests beside the path, ``left`` and ``right`` of each level, up to the top.
    """
    carried = [c for c in above.columns if c not in ("tree", "level")]
    known = above.filter(F.col("level") == len(levels)).select("tree", F.lit(0).cast("long").alias("pos"), *carried)
    for number in range(len(levels) - 1, -1, -1):
        level = levels[number].alias("c").join(
            known.alias("p").hint("merge"), F.expr(f"c.tree = p.tree AND floor(c.pos / {arity}) = p.pos"))
        step = F.array(F.struct(F.col("c.left").alias("left"), F.col("c.right").alias("right")))
        steps = F.concat(step, F.col("p.steps")).alias("steps")
        down = level.select("c.tree", "c.pos", *[steps if c == "steps" else F.col(f"p.{c}") for c in carried])
        single = above.filter(F.col("level") == number).select("tree", F.lit(0).cast("long").alias("pos"), *carried)
        known = written(down.union(single), f"{name}-steps")
    return known


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the digests beside its path lead to."""
    return F.aggregate(steps, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def proof(steps: Column) -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(rows: DataFrame, leaves: dict[str, Column], key: str = "doc_id", group: str = "source", arity: int = ARITY) -> DataFrame:
    """``(key, *leaves, subroot, root, steps)`` of every row; the tree is built over the first of the ``leaves`` expressions."""
    first = next(iter(leaves))
    narrow = rows.select(F.col(key).alias("__key"), F.col(group).alias("__source"), *[c.alias(f"__l_{n}") for n, c in leaves.items()])
    order = [F.col("__key").asc_nulls_first(), *[F.col(f"__l_{n}") for n in leaves]]
    placed = positions(narrow, "__source", order, "merkle-leaves")
    placed = placed.withColumnRenamed("n", "__n").withColumnRenamed("pos", "__pos")
    groups = placed.filter("__pos = 0").select("__source", F.lit(0).alias("__one"))
    trees = positions(groups, "__one", [F.col("__source").asc_nulls_first()], "merkle-groups").select(
        F.col("__source").alias("__s"), F.col("pos").alias("tree"))
    known = written(placed.join(trees, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s", "__source"), "merkle-rows")

    leaf_nodes = known.select("tree", F.col("__pos").alias("pos"), F.col("__n").alias("n"), F.col(f"__l_{first}").alias("hash"))
    levels, subroots = climb(leaf_nodes, arity, "merkle")
    top = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("hash"))
    total = subroots.count()
    over, roots = climb(top.withColumn("n", F.lit(total).cast("long")), arity, "merkle-top")
    none = F.array().cast(_STEP).alias("steps")
    ends = descend(over, roots.select("tree", "level", none, F.col("hash").alias("root")), arity, "merkle-top")
    above = subroots.alias("t").join(ends.alias("e"), F.expr("t.tree = e.pos")).select(
        "t.tree", "t.level", "e.steps", F.col("t.hash").alias("subroot"), "e.root")
    steps = descend(levels, written(above, "merkle-above"), arity, "merkle")
    out = known.alias("k").join(steps.alias("s").hint("merge"), F.expr("k.tree = s.tree AND k.__pos = s.pos"))
    return out.select(F.col("k.__key").alias(key), *[F.col(f"k.__l_{n}").alias(n) for n in leaves], "s.subroot", "s.root", "s.steps")


def leaf_of(fields: dict[str, Column]) -> Column:
    return digest(*[field(c) for c in fields.values()])


def tamper_report(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Ids with an even CRC-32 (a null id counts as the empty text) have their text's line feeds deleted before the path is folded again.
    """
    values = {c: F.col(c) for c in FIELDS}
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    changed = F.when(checksum % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(documents, {"leaf": leaf_of(values), "__now": leaf_of({**values, "text": changed})})
    again = folded(F.col("__now"), F.col("steps"))
    out = found.select("doc_id", "leaf", "subroot", "root", proof(F.col("steps")).alias("proof_sha256"), again.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(text if c == "text" else c) for c in FIELDS) + ")"


def _sql_tree(name: str, leaves: str) -> str:
    """Levels ``(tree, level, pos, n, hash)`` over leaves of level 0."""
    return f"""{name}(tree, level, pos, n, hash) AS (
  SELECT tree, 0::BIGINT, pos::BIGINT, n::BIGINT, hash FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos)) FROM {name}
  WHERE n > 1 GROUP BY tree, level, pos // 3, n)"""


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_sql_leaf("text")} AS leaf,
         {_sql_leaf("replace(text, chr(10), CASE WHEN " + CRC32.format("coalesce(doc_id::VARCHAR, '')") + " % 2 = 0 THEN '' ELSE chr(10) END)")} AS now
  FROM documents),
p AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS pos FROM d),
leaves AS (SELECT tree, pos, n, leaf AS hash FROM p),
{_sql_tree("low", "leaves")},
tops AS (SELECT 0::BIGINT AS tree, tree AS pos, count(*) OVER () AS n, hash FROM low WHERE n = 1),
{_sql_tree("high", "tops")},
depth AS (SELECT tree, max(level) AS up, arg_max(hash, level) AS subroot FROM low GROUP BY tree),
nodes AS (
  SELECT tree, level, pos, hash FROM low WHERE n > 1
  UNION ALL SELECT d.tree, d.up + h.level, h.pos, h.hash
  FROM depth d JOIN high h ON h.n > 1 AND h.pos // 3 = (d.tree // (3 ** h.level)::BIGINT) // 3),
path AS (
  SELECT p.tree, p.pos AS leaf, n.level, n.pos, n.hash,
         CASE WHEN n.level < d.up THEN p.pos // (3 ** n.level)::BIGINT ELSE p.tree // (3 ** (n.level - d.up))::BIGINT END AS own
  FROM p JOIN depth d ON d.tree = p.tree JOIN nodes n ON n.tree = p.tree
   AND (n.level >= d.up OR n.pos // 3 = (p.pos // (3 ** n.level)::BIGINT) // 3)),
steps AS (
  SELECT tree, leaf, level, coalesce(string_agg(hash, '' ORDER BY pos) FILTER (WHERE pos < own), '') AS l,
         coalesce(string_agg(hash, '' ORDER BY pos) FILTER (WHERE pos > own), '') AS r FROM path GROUP BY tree, leaf, level),
proofs AS (SELECT tree, leaf, sha256(string_agg(l || r, '' ORDER BY level)) AS proof, max(level) + 1 AS n_levels FROM steps GROUP BY tree, leaf),
folds(tree, leaf, level, hash) AS (
  SELECT tree, pos::BIGINT, 0::BIGINT, now FROM p
  UNION ALL
  SELECT f.tree, f.leaf, f.level + 1, sha256(s.l || f.hash || s.r) FROM folds f
  JOIN steps s ON s.tree = f.tree AND s.leaf = f.leaf AND s.level = f.level),
ends AS (SELECT tree, leaf, arg_max(hash, level) AS folded_root FROM folds GROUP BY tree, leaf)
SELECT p.doc_id, p.leaf, d.subroot, r.hash AS root, coalesce(x.proof, sha256('')) AS proof_sha256, e.folded_root,
       e.folded_root = r.hash AS verified
FROM p JOIN depth d ON d.tree = p.tree JOIN ends e ON e.tree = p.tree AND e.leaf = p.pos
LEFT JOIN proofs x ON x.tree = p.tree AND x.leaf = p.pos CROSS JOIN (SELECT hash FROM high WHERE n = 1) r
"""
