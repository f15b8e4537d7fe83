"""Plain Python versions of the operators, for small fixtures."""

import collections
import hashlib
import math
import re
import zlib

import xxhash

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def decontamination(docs, items, window=13):
    """Per row: words, hit words, digest of item ids, verdict."""
    windows = collections.defaultdict(set)
    for name, text in items:
        words = ALNUM.findall(lowered(text))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[k:k + window])].add("" if name is None else str(name))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, found = ALNUM.findall(lowered(text)), set()
        hit = [False] * len(words)
        for n in lengths:
            for p in range(len(words) - n + 1):
                key = tuple(words[p:p + n])
                if key in windows:
                    found |= windows[key]
                    hit[p:p + n] = [True] * n
        n = sum(hit)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), n, len(found), digest, n > 0 and 20 * n >= len(words)))
    return out


def base_scores(docs):
    def tokens(text):
        return [*SPACED.findall((text or "").encode().lower()), None]

    counts = collections.Counter()
    for doc_id, text in docs:
        if fold(doc_id) != 1:
            counts.update(tokens(text))
    total = sum(counts.values())
    mass = total + 0.5 * (len(counts) + 1)
    return [(doc_id, len(tokens(text)), sum(counts[w] > 0 for w in tokens(text)), total,
             sum(math.log10((counts[w] + 0.5) / mass) for w in tokens(text))) for doc_id, text in docs]


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(docs):
    """Per row: fingerprint and component number."""
    prints = [fingerprint(text) for _, text in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                group[root(i)] = root(j)
    return prints, [root(i) for i in range(len(docs))]


def line_dedup(docs, run=3):
    """Texts without later repeated runs, for rows in table order; documents count by id, null first."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0, i))
    seen, gone = set(), [set() for _ in docs]
    for i in order:
        lines = (docs[i][1] or "").split("\n")
        filled = [k for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line)]
        for s in range(len(filled) - run + 1):
            key = tuple(lines[k] for k in filled[s:s + run])
            if key in seen:
                gone[i].update(filled[s:s + run])
            seen.add(key)
    return [text if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[i])
            for i, (_, text) in enumerate(docs)]


def repeated_bytes(docs, length=200):
    """Per row: bytes, removed bytes, removed runs, digest of the rest."""
    data = [(text or "").encode() for _, text in docs]
    times = collections.Counter(b[p:p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(docs, data):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if times[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        runs = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(gone)))
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def mix(docs, symbols="!$%&#*|", least=0.25):
    """Per row of (id, text, source): size, source size, target, taken."""
    sizes = [len(SPACED.findall((t or "").encode())) for _, t, _ in docs]
    sources = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(sources)}
    total = {s: sum(n for n, d in zip(sizes, docs) if d[2] == s) for s in sources}
    left, open_, target = float(sum(sizes)), set(sources), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * total[s]}
        if not over:
            target.update({s: level * weight[s] for s in open_})
            break
        target.update({s: 3.0 * total[s] for s in over})
        left -= sum(3 * total[s] for s in over)
        open_ -= over
    out = [None] * len(docs)
    for s in sources:
        rows = [i for i, d in enumerate(docs) if d[2] == s]

        def key(i):
            doc_id, text, _ = docs[i]
            u = (int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:13], 16) + 0.5) / 2.0 ** 52
            share = sum(c in symbols for c in text or "") / len(text) if text else 0.0
            return -math.log(u) / max(1 - 4 * share, least), doc_id is not None, doc_id or 0, i

        epochs = int(target[s] // total[s]) if total[s] else 0
        rest, prior = target[s] - epochs * total[s], 0
        for i in sorted(rows, key=key):
            taken = epochs + (total[s] > 0 and 2 * prior + sizes[i] <= 2 * rest)
            out[i] = (docs[i][0], sizes[i], total[s], target[s], taken * sizes[i])
            prior += sizes[i]
    return out
