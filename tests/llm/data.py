"""Small documents with every awkward case: nulls, empty and long texts, copies, near copies, repeated rows, clashing columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, hash long, copies int, "
          "rid long, `lines` string, `word` string")
SYLLABLES = {
    "en": ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"],
    "fr": ["eau", "oi", "que", "é", "è", "ment", "ai", "elle", "tre", "ou"],
    "de": ["sch", "ung", "ein", "ü", "ß", "ich", "tz", "au", "keit", "ver"],
}


def sentence(rng, lang="en", words=12):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(words)).capitalize() + "."


def text(rng, lang="en", lines=8):
    return "\n".join(sentence(rng, lang, rng.randint(4, 20)) for _ in range(lines))


def documents(n=60, seed=3):
    """Rows of ``SCHEMA``."""
    rng = random.Random(seed)
    rows = []

    def add(doc_id, body, lang="en", source="a"):
        rows.append((doc_id, body, lang, source, None if body is None else len(body), 1.0, 2, 3, 4, "x", "y"))

    passage = text(rng, "en", 5)
    for i in range(n):
        lang = rng.choice(["en", "en", "fr", "de"])
        body = text(rng, lang, rng.randint(1, 12))
        if i % 5 == 0:
            body += "\n" + passage + "\n" + sentence(rng, lang)
        if i % 7 == 3:
            body = rows[i - 2][1]  # a copy
        if i % 11 == 6:
            words = rows[i - 3][1].split(" ")
            words[len(words) // 2] = "changed"
            body = " ".join(words)
        add(i, body, lang, rng.choice(["a", "b", "c", "é"]) if i % 3 else "a")
    add(n, "")
    add(n + 1, None)
    add(n + 2, "   \n\t \n", source=None)
    add(n + 3, "One", "en", None)
    add(n + 4, "ab ab ab ab " * 200)
    add(n + 5, text(rng, "en", 900))
    add(n + 6, "\n".join(["same line again"] * 9))
    add(None, text(rng, "fr", 4), None, "b")
    add(None, None, None, None)
    rows.append(rows[2])  # a repeated row
    rows.append(rows[2])
    return rows


def benchmark(rows):
    words = rows[10][1].split()
    return [(1, " ".join(words[3:30])), (2, "Words that are Nowhere"), (3, None), (4, ""), (5, " ".join(words[5:9])),
            (None, " ".join(rows[4][1].split()[:20])), (1, " ".join(words[3:30]))]
