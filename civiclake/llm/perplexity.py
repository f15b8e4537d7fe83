"""Language model scores of whole documents: a gated recurrent network with a class-factored output.

Word counts cover every training text.  The most frequent words are the network's vocabulary; all others are
one class, in which a word has its smoothed share of the counts, so every text has a probability.
The network is trained by Spark tasks, each on the documents of its partition from a shared start; the mean over tasks, weighted by
the tokens learned from, starts the next round, which uses other documents.  ``HEAD_WORDS`` counts are
broadcast; the counts of rarer words are joined.

Words are named by 64-bit hashes.  Defined results: a null or empty text is its end token alone; repeated rows get equal
scores and count in training once each; with no training text the counts are zero; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import recurrent as net
from .storage import numbered, written
from .tokens import list_array, map_texts, slices, with_text_columns, words_of

#: Most words whose counts are broadcast.
HEAD_WORDS = 1 << 18
BUCKET_BITS = 20
ROUNDS = 2
END_HASH = np.uint64(1)
END_WORD = net.WORDS - 1
LEARNING_STREAMS, SCORING_STREAMS = 32, 256
#: Text that is packed into streams at a time; it is tokenised in smaller slices.
PACKED_BYTES = 6 << 20
_PART = 8192
_LN10 = math.log(10)


@dataclass
class Vocabulary:
    """Hashes of frequent words in order, their counts and network ids; totals over all training tokens."""

    hashes: np.ndarray
    buckets: np.ndarray  # where the hashes with each leading ``BUCKET_BITS`` begin
    counts: np.ndarray
    ids: np.ndarray
    ends: int
    tokens: int
    distinct: int

    @classmethod
    def of(cls, words: np.ndarray, counts: np.ndarray, ends: int, tokens: int, distinct: int) -> Vocabulary:
        rank = np.empty(len(counts), np.int32)
        rank[np.lexsort((words, -counts))] = np.arange(len(counts), dtype=np.int32)
        order = np.argsort(words)
        leading = np.arange((1 << BUCKET_BITS) + 1, dtype=np.int64)
        buckets = np.searchsorted((words[order] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), leading).astype(np.int32)
        ids = np.where(rank < END_WORD, rank, net.WORDS).astype(np.int32)
        return cls(words[order], buckets, counts[order], ids[order], ends, tokens, distinct)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word, and whether it is there; a bucket holds a few words at most."""
        bucket = (words >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        at, end = self.buckets[bucket].astype(np.int64), self.buckets[1:][bucket]
        # an equal hash is the word, whichever bucket the place is in
        found = self.hashes.take(at, mode="clip") == words if len(self.hashes) else np.zeros(len(words), bool)
        left = np.flatnonzero(~found & (at + 1 < end))
        while len(left):
            at[left] += 1
            hit = self.hashes[at[left]] == words[left]
            found[left[hit]] = True
            left = left[~hit]
            left = left[at[left] + 1 < end[left]]
        return np.minimum(at, max(len(self.hashes) - 1, 0)), found

    @property
    def mass(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    def network_counts(self) -> np.ndarray:
        out = np.zeros(net.WORDS)
        known = self.ids < net.WORDS
        out[self.ids[known]] = self.counts[known]
        out[END_WORD] = self.ends
        return out

    @property
    def other_mass(self) -> float:
        """Smoothed count of all words beyond the network's vocabulary."""
        return max(self.mass - self.counts[self.ids < net.WORDS].sum() - self.ends
                   - 0.5 * ((self.ids < net.WORDS).sum() + 1), 0.5)


@dataclass
class Encoded:
    """Tokens of some texts, each text's end included."""

    targets: np.ndarray
    inputs: np.ndarray
    counts: np.ndarray  # smoothed later; zero for words beyond the head
    tail: np.ndarray  # hashes of those words
    tail_sizes: np.ndarray
    sizes: np.ndarray


def encode(texts: list[bytes], vocabulary: Vocabulary) -> Encoded:
    parts = []
    for _, piece in slices(pa.array(texts, pa.large_binary())):
        words = words_of(piece)
        hashed, sizes = words.hashes(), words.counts()
        at, head = vocabulary.find(hashed)
        target = np.full(len(hashed), net.WORDS, np.int32)
        target[head] = vocabulary.ids[at[head]]
        inputs = np.where(target < net.WORDS, target, net.WORDS + (hashed % np.uint64(net.OTHER_INPUTS)).astype(np.int32))
        count = np.zeros(len(hashed))
        count[head] = vocabulary.counts[at[head]]
        ends = np.cumsum(sizes)
        parts.append(Encoded(
            np.insert(target, ends, END_WORD), np.insert(inputs, ends, END_WORD).astype(np.int32),
            np.insert(count, ends, vocabulary.ends), hashed[~head],
            np.bincount(words.row[~head], minlength=len(piece)), sizes + 1))
    return Encoded(*[np.concatenate([getattr(p, f) for p in parts]) for f in Encoded.__dataclass_fields__])


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)`` over all whole texts, words by hash, the end token among them."""

    def count(piece: list[bytes]) -> list[np.ndarray]:
        word, n = np.unique(words_of(piece).hashes(), return_counts=True)
        return [np.append(word, END_HASH).view(np.int64), np.append(n, len(piece))]

    return map_texts(texts, "text", "word long, n long", count).groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    """The most frequent words, at most ``HEAD_WORDS``: those above a count level that few enough words reach."""
    end = int(END_HASH)
    totals = counts.agg(F.sum("n"), F.count("*"), F.max(F.when(F.col("word") == end, F.col("n")))).first()
    words = counts.filter(F.col("word") != end)
    level = F.floor(F.log2(F.col("n")) * 16)
    levels = words.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # at most 16 per doubling
    lowest, held = None, 0
    for row in levels:
        held += row["count"]
        if held > HEAD_WORDS:
            break
        lowest = row["level"]
    head = words.filter(level >= lowest).toPandas() if lowest is not None else words.limit(0).toPandas()
    return Vocabulary.of(head["word"].to_numpy(np.int64).view(np.uint64), head["n"].to_numpy(np.int64),
                         int(totals[2] or 0), int(totals[0] or 0), totals[1])


def _train_round(texts: DataFrame, vocabulary: Vocabulary, start: net.Parameters) -> net.Parameters:
    shared = texts.sparkSession.sparkContext.broadcast((vars(vocabulary), [a for a in start.arrays()]))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, arrays = shared.value
        words = Vocabulary(**held)
        learner = net.Learner(net.Parameters(*[a.copy() for a in arrays]))
        for batch in batches:
            for _, piece in slices(batch.column(0), PACKED_BYTES):
                tokens = encode(piece, words)
                learner.learn(net.pack(tokens.targets, tokens.inputs, tokens.sizes, LEARNING_STREAMS, END_WORD))
        if learner.learned:
            flat = learner.p.flat().astype(np.float64) * learner.learned
            parts = np.split(flat, range(_PART, len(flat), _PART))
            branch = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_arrays(
                [pa.array([branch] * len(parts), pa.int32()), pa.array(np.arange(len(parts), dtype=np.int32)),
                 pa.array([float(learner.learned)] * len(parts)), list_array(flat, np.array([len(p) for p in parts]))],
                names=["branch", "part", "weight", "total"])

    def add(table: pa.Table) -> pa.Table:
        lists = table.column("total").combine_chunks()
        total = np.asarray(lists.flatten()).reshape(table.num_rows, -1).sum(axis=0)
        return pa.table({"branch": table.column("branch")[:1].cast(pa.int32()), "part": table.column("part")[:1],
                         "weight": pa.array([table.column("weight").to_numpy().sum()]), "total": list_array(total, np.array([len(total)]))})

    schema = "branch int, part int, weight double, total array<double>"
    # two levels, so that no group holds more than a share of the tasks' parts
    sums = texts.select("text").mapInArrow(train, schema).groupBy("branch", "part").applyInArrow(add, schema)
    rows = sums.groupBy("part").applyInArrow(add, schema).orderBy("part").collect()  # the network's parameters
    if not rows:
        return start
    return start.refilled(np.concatenate([np.array(r.total) / r.weight for r in rows]))


@dataclass
class Model:
    vocabulary: Vocabulary
    parameters: net.Parameters
    counts: DataFrame


def fit(texts: DataFrame, rounds: int = ROUNDS) -> Model:
    """Counts of all training texts and a network trained on them, each round on the texts of one residue of their hash."""
    counts = written(word_counts(texts), "word-counts")
    vocabulary = vocabulary_of(counts)
    parameters = net.Parameters.initial(vocabulary.network_counts(), vocabulary.other_mass)
    for i in range(rounds):
        share = texts.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == i)
        parameters = _train_round(share, vocabulary, parameters)
    return Model(vocabulary, parameters, counts)


def scores(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every whole text of ``documents``."""
    words = model.vocabulary
    shared = documents.sparkSession.sparkContext.broadcast((vars(words), model.parameters.arrays()))

    def score(texts: list[bytes]) -> list[pa.Array]:
        held, arrays = shared.value
        vocabulary, parameters = Vocabulary(**held), net.Parameters(*arrays)
        tokens = encode(texts, vocabulary)
        row = np.repeat(np.arange(len(texts)), tokens.sizes)
        packed = net.pack(tokens.targets, tokens.inputs, tokens.sizes, SCORING_STREAMS, END_WORD)
        network = net.log_likelihood(parameters, packed, len(texts)) / _LN10
        end = tokens.targets == END_WORD
        head = (tokens.counts > 0) | end
        smoothed = np.where(head, np.log10(tokens.counts + 0.5), 0.0)
        other = tokens.targets == net.WORDS
        local = network + np.bincount(row, np.where(other, smoothed - math.log10(vocabulary.other_mass), 0.0), len(texts))
        return [pa.array(tokens.sizes.astype(np.int64)),
                pa.array(np.bincount(row, tokens.counts > 0, len(texts)).astype(np.int64)),
                pa.array(np.bincount(row, smoothed, len(texts))), pa.array(local),
                list_array(tokens.tail.view(np.int64), tokens.tail_sizes)]

    added = (T.StructType().add("n_tokens", T.LongType()).add("known", T.LongType()).add("head", T.DoubleType())
             .add("local", T.DoubleType()).add("tail", T.ArrayType(T.LongType())))
    narrow = numbered(documents.select("doc_id", "text")).select("__rid", "doc_id", "text")
    rows = with_text_columns(narrow, "text", added, score, PACKED_BYTES)
    rows = written(rows.select("__row.__rid", "__row.doc_id", "n_tokens", "known", "head", "local", "tail"), "scored")
    tail = rows.select("__rid", F.explode("tail").alias("word")).join(model.counts, "word", "left")
    n = F.coalesce("n", F.lit(0))
    tail = tail.groupBy("__rid").agg(F.sum(F.log10(n + 0.5)).alias("rare"), F.sum((n > 0).cast("long")).alias("rare_known"))
    rare = F.coalesce("rare", F.lit(0.0))
    return rows.drop("tail").join(tail, "__rid", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("head") + rare - F.col("n_tokens") * math.log10(words.mass)).alias("base_score"),
        (F.col("local") + rare).alias("score"))
