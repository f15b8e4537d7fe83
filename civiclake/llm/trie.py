"""Prefix trie of conversations by whole-sequence collapse.

Identical conversations are first grouped into one weighted sequence, known by its digest, with a list of the ids that end there; only one
conversation of each group is looked at turn by turn.  Sequences that are proper prefixes of others go by an anti-join,
the rest are the leaves.  Everything else is aggregated over the weighted prefixes of the sequences, one row per turn:

* a prefix is known by its length and the exclusive or of two 64-bit hashes of its numbered turns, so prefixes come from running totals
  over blocks of ``BLOCK`` turns and over the blocks of a conversation, however long it is;
* what a node's subtree saves is ``members * bytes`` less ``bytes`` of every node below, and both are sums over the sequences
  through the node: the first of weights times the bytes that follow, the second of the bytes of those nodes that a sequence owns.
  A node is owned by its sequence of the smallest id, so each sequence owns the end of its own path from some depth on.

So rows grow with the turns of distinct conversations, and never with pairs or with the square of a conversation's length.  Texts are
read once and leave as digests.

Defined results: turns of one number (or none) are taken in the order of their digests; repeated rows are turns of their own;
rows without ``conv_id`` belong to no conversation and are left out; an empty table has no nodes, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import positions
from .sqltext import CRC32
from .storage import written

#: Turns that the running totals of one window go over.
BLOCK = 1024
#: Decimal ids that one piece of an end list holds at most.
PIECE_IDS = 4096
REBUILD, SHARED_TURNS = 5, 9

_NODE = ["depth", "x", "y"]


def own_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, n, digest, bytes)``: every turn with its place in its conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    return written(positions(turns, "conv_id", order, "trie-turns").drop("turn"), "trie-placed")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are rebuilt: ``(conv_id, pos, digest, bytes)`` of their turns, and all ``conv_id``.

    A conversation begins with the first turns of the first one of its group of five, as many as a checksum of its id
    says, and goes on with its own behind as many.
    """
    convs = turns.filter("pos = 0").select("conv_id", F.col("n").alias("own"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS).alias("shared")
    convs = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % REBUILD).alias("base"), shared)
    bases = turns.filter("pos = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("base_turns"))
    convs = written(convs.join(bases.hint("merge"), "base", "left").withColumn(
        "head", F.least("shared", F.coalesce("base_turns", F.lit(0)))), "trie-conversations")
    heads = turns.filter(F.col("pos") < SHARED_TURNS - 1).select(F.col("conv_id").alias("base"), "pos", "digest", "bytes")
    first = convs.select("conv_id", "base", "head").join(heads.hint("merge"), "base").filter("pos < head")
    rest = turns.drop("n").join(convs.select("conv_id", "shared", "head").hint("merge"), "conv_id").filter("pos >= shared")
    both = first.select("conv_id", "pos", "digest", "bytes").union(
        rest.select("conv_id", (F.col("pos") - F.col("shared") + F.col("head")).alias("pos"), "digest", "bytes"))
    return both, convs.select("conv_id")


def _turn_hash(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "pos", "digest")


def sequences(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """``(conv_id, depth, x, y)`` of every conversation: number of turns and digest of the whole sequence."""
    whole = turns.groupBy("conv_id").agg(
        F.count("*").alias("depth"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    zero = F.lit(0).cast("long")
    return conversations.join(whole.hint("merge"), "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in _NODE])


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, depth, x, y, px, py, bytes, before)`` for every turn: its prefix, the one before, bytes of the turn and before it."""
    block = F.floor(F.col("pos") / BLOCK)
    rows = turns.withColumn("block", block)
    blocks = rows.groupBy("conv_id", "block").agg(
        F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"), F.sum("bytes").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = blocks.select("conv_id", "block", *[
        F.coalesce(f(c).over(earlier), zero).alias(c) for f, c in ((F.bit_xor, "bx"), (F.bit_xor, "by"), (F.sum, "b"))])
    upto = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("conv_id", "block", "pos", "bytes", F.col("x").alias("tx"), F.col("y").alias("ty"),
                       F.bit_xor("x").over(upto).alias("x"), F.bit_xor("y").over(upto).alias("y"), F.sum("bytes").over(upto).alias("sum"))
    rows = rows.join(blocks.hint("merge"), ["conv_id", "block"])
    x, y = F.col("x").bitwiseXOR(F.col("bx")), F.col("y").bitwiseXOR(F.col("by"))
    return rows.select(
        "conv_id", (F.col("pos") + 1).alias("depth"), x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("tx")).alias("px"),
        y.bitwiseXOR(F.col("ty")).alias("py"), "bytes", (F.col("sum") + F.col("b") - F.col("bytes")).alias("before"))


def _pieces(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Sorted ``(depth, x, y, conv_id, at)`` to comma-joined pieces; a piece ends with its node, its size or its task."""
    key, ids, first = None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k]) for k in (*key, first, ",".join(ids))], names=[*_NODE, "at", "ids"])

    for batch in batches:
        for d, x, y, c, at in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if key != (d, x, y) or len(ids) >= limit:
                if ids:
                    yield piece()
                key, ids, first = (d, x, y), [], at
            ids.append(str(c))
    if ids:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces, node by node and in order, to one digest per node."""
    key, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k]) for k in (*key, state.hexdigest())], names=[*_NODE, "ends_sha256"])

    for batch in batches:
        for d, x, y, ids in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if key != (d, x, y):
                if state:
                    yield done()
                key, state = (d, x, y), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state:
        yield done()


def _small_batches(run: Callable) -> Callable:
    """The few rows of ``run`` in larger batches."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in run(batches):
            held.append(b)
            size += b.nbytes
            if len(held) >= 2048 or size > 1 << 22:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return merged


def end_lists(of: DataFrame) -> DataFrame:
    """``(depth, x, y, ends_sha256)`` from ``(conv_id, depth, x, y)``: digest of the sorted, comma-joined ids of each sequence.

    Ids are dealt by ranges of sequence and id and joined to pieces there, so the task that hashes a sequence's list in order,
    as the digest asks, streams one row per ``PIECE_IDS`` ids.
    """
    keys = [*_NODE, "conv_id"]
    sorted_ids = of.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    pieces = sorted_ids.mapInArrow(_small_batches(partial(_pieces, limit=PIECE_IDS)), "depth long, x long, y long, at long, ids string")
    dealt = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "at").select(*_NODE, "ids")
    return dealt.mapInArrow(_small_batches(_hashed), "depth long, x long, y long, ends_sha256 string")


def prefix_nodes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns (conv_id, pos, digest, bytes)``: the columns of ``trie_report`` and the node's key."""
    turns = written(turns.select("conv_id", "pos", "bytes", _turn_hash(1).alias("x"), _turn_hash(2).alias("y")), "trie-rebuilt")
    of = written(sequences(turns, conversations), "trie-sequence-of")
    groups = written(of.groupBy(*_NODE).agg(F.min("conv_id").alias("first"), F.count("*").alias("weight")), "trie-sequences")
    ends = end_lists(of)

    speakers = groups.select(F.col("first").alias("conv_id"), "weight")
    mine = written(prefixes(turns.join(speakers.hint("merge"), "conv_id", "left_semi")), "trie-prefixes")
    # a sequence that another one goes on from is the prefix before some turn
    inner = mine.select((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).distinct()
    leaf = groups.join(inner.hint("merge"), _NODE, "left_anti").select(F.col("first").alias("leaf"))
    length = mine.groupBy("conv_id").agg(F.sum("bytes").alias("total"))
    paths = speakers.join(leaf.hint("merge"), F.col("conv_id") == F.col("leaf"), "left").join(length.hint("merge"), "conv_id", "left").select(
        "conv_id", "weight", F.col("leaf").isNotNull().cast("long").alias("leaf"), F.coalesce("total", F.lit(0)).alias("total"))
    paths = written(paths, "trie-paths")
    zero = F.lit(0).cast("long")
    below = mine.join(paths.hint("merge"), "conv_id")
    start = paths.select(
        "conv_id", *[zero.alias(c) for c in (*_NODE, "px", "py", "bytes", "before")], "weight", "leaf", "total")
    rows = written(below.union(start), "trie-rows")

    nodes = written(rows.groupBy(*_NODE).agg(
        F.min("conv_id").alias("node_conv"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.first("px").alias("px"), F.first("py").alias("py")), "trie-nodes")
    # bytes before the part of its path that a sequence owns
    owned = rows.filter("depth > 0").join(
        nodes.select(*_NODE, "node_conv").hint("merge"), _NODE).filter("conv_id = node_conv").groupBy("conv_id").agg(
        F.min("before").alias("owned"))
    shares = rows.join(owned.hint("merge"), "conv_id", "left")
    mine_below = F.col("total") - F.greatest("before", F.coalesce("owned", "total"))
    saved = shares.groupBy(*_NODE).agg(F.sum(
        F.col("weight") * (F.col("total") - F.col("before")) - mine_below).alias("saved_tokens"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.count("*").alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("node_conv").alias("parent_conv_id"))
    out = nodes.join(saved.hint("merge"), _NODE).join(children.hint("merge"), _NODE, "left").join(
        ends.hint("merge"), _NODE, "left").join(parents.hint("merge"), ["depth", "px", "py"], "left")
    return out.select(
        F.col("node_conv").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "x", "y")


def trie_report(conversations: DataFrame) -> DataFrame:
    """Per node of the rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    return prefix_nodes(*rebuilt(own_turns(conversations))).drop("x", "y")


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id, {{'role': role, 'text': text}} AS said, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) - 1 AS pos FROM t),
a AS (SELECT conv_id, list(said ORDER BY pos) AS own FROM o GROUP BY conv_id),
h AS (SELECT conv_id, own, conv_id - conv_id % {REBUILD} AS base, {CRC32.format("conv_id::VARCHAR")} % {SHARED_TURNS} AS shared FROM a),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h.shared], h.own[h.shared + 1:]) AS turns
  FROM h LEFT JOIN a b ON b.conv_id = h.base),
p AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM r),
n AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth), '')) AS ends_sha256
  FROM p GROUP BY ALL),
c AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
         CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * strlen(n.path[n.depth].text) ELSE 0 END AS saved FROM n LEFT JOIN c ON c.path = n.path),
u AS (SELECT path, n_children, saved, unnest(range(depth + 1)) AS up FROM v),
s AS (
  SELECT path[1:up] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM u GROUP BY ALL)
SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM v JOIN s ON s.path = v.path LEFT JOIN n q ON v.depth > 0 AND q.path = v.path[1:v.depth - 1]
"""
