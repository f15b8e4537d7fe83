"""The line stage of the pipeline deletes long passages of one or two lines too."""

import random

import corpus_pipeline
from tests.llm import brute, data


def long_dedup(rows, least=50):
    """Texts without later repeats of three lines, or of one or two with more words than ``least``; ids in order."""
    seen, out = set(), []
    for _, text in rows:
        lines = (text or "").split("\n")
        filled = [k for k, line in enumerate(lines) if brute.SPACED.search(line.encode())]
        gone = set()
        for size in (1, 2, 3):
            for s in range(len(filled) - size + 1):
                run = tuple(lines[k] for k in filled[s:s + size])
                if size == 3 or sum(len(brute.SPACED.findall(x.encode())) for x in run) > least:
                    if run in seen:
                        gone.update(filled[s:s + size])
                    seen.add(run)
        out.append(text if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_long_passages_of_one_or_two_lines(spark):
    rng = random.Random(2)
    line, first, second, at_limit = (data.sentence(rng, "en", n) for n in (51, 30, 21, 50))
    own = iter([data.sentence(rng, "fr", 9) for _ in range(20)])
    texts = [
        line, f"{next(own)}\n{line}", f"{line}\n\n{line}\n{next(own)}",
        f"{first}\n{second}", f"{next(own)}\n{first}\n \n{second}\n{next(own)}", f"{first}\n{next(own)}\n{second}",
        at_limit, f"{at_limit}\n{next(own)}", f"{next(own)}\n{at_limit}\n", None, "", " \n", line + " ",
        "\n".join([line, first, second]), data.text(rng, "de", 9)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [r.text for r in corpus_pipeline.dedup_lines(spark, docs, "").orderBy("doc_id").collect()]
    want = long_dedup(rows)
    assert got == want
    assert want[1].count("\n") == 0 and want[6:9] == texts[6:9] and want != brute.line_dedup(rows)
