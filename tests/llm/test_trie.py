"""The prefix trie of conversations against a plain version."""

import collections
import hashlib
import random
import zlib

from civiclake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, weight long, pos int, x string, `at` int"


def rebuilt(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: tuple(t[3] for t in sorted(v)) for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        shared = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5)), ())
        out[c] = base[:shared] + turns[shared:]
    return out


def report(rows):
    convs = rebuilt(rows)
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in convs.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, ids in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(ids) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, ids in members.items()), key=str)


def check(spark, rows):
    got = trie.trie_report(spark.createDataFrame([(*r, 1, 2, 3, "x", 5) for r in rows], SCHEMA).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == report(rows)


def test_report_against_plain_python(spark):
    rng = random.Random(4)
    rows, previous = [], [("user", "hello")]
    for c in range(-12, 90):
        if c % 7 == 3:
            continue  # ids that are not there, bases among them
        turns = [(rng.choice(["user", "bot", None]), rng.choice([None, "", "é", "a", "b", f"t{c}"])) for _ in range(rng.randint(1, 14))]
        if c % 2:
            turns = previous[:rng.randint(0, len(previous))] + turns[:rng.randint(0, 2)]
        if c % 11 == 0:
            turns = [("user", "same"), ("bot", "same")]
        rows += [(c, rng.choice([i, i, i, None, 2]), role, text) for i, (role, text) in enumerate(turns)]
        previous = turns
    check(spark, rows + rows[5:9] + [(None, 1, "user", "nobody"), (None, None, None, None)])


def test_long_conversations_go_over_blocks_and_lists_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    monkeypatch.setattr(trie, "PIECE_IDS", 3)
    rows = [(c, i, "user", f"{i}") for c in (0, 1, 5, 10, 15, 20, 25, 30, 35) for i in range(21 if c < 30 else 33)]
    rows += [(100, i, "bot", "x" * 70_000) for i in range(3)]
    check(spark, rows)


def test_a_conversation_without_turns_left_ends_at_the_root(spark):
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    check(spark, [(c, 0, "user", "gone"), (500, 0, "user", "stays")])


def test_empty_table(spark):
    assert trie.trie_report(spark.createDataFrame([], SCHEMA)).count() == 0
