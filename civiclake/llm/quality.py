"""Quality classifier: hashed word n-gram logistic regression with follow-the-regularised-leader updates.

Defined results: a null or empty text has only the intercept; repeated rows get equal scores;
without labelled training rows every score is one half; extra columns of the documents are ignored by
``quality_model`` and kept in ``__row`` by ``ftrl.scored``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from .ftrl import Ftrl, distinct_buckets, fit, labelled_sample, scored
from .tokens import NOT_ALNUM, SPACE, RollingHash, joined, scramble

MODEL = Ftrl(bits=18, alpha=0.1, l1=0.5, l2=1.0, rounds=4)

_KIND = np.full(256, 2, dtype=np.uint8)  # 0 space, 1 letters and digits, 2 symbols
_KIND[SPACE] = 0
_KIND[~NOT_ALNUM] = 1
_SMALL = np.zeros(256, dtype=bool)
_SMALL[0x61:0x7B] = True
_LARGE = np.zeros(256, dtype=bool)
_LARGE[0x41:0x5B] = True
_U = np.uint64


def quality_features(texts: list[bytes], bits: int = MODEL.bits) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and word pairs, and n-grams of word shapes.

    Words are runs of letters and digits, and runs of symbols by themselves.  A shape says how a word is
    written (small, capital, all capitals, digits, the symbols themselves) or that it repeats the word before it.
    """
    data, begin = joined(texts)
    kind = np.concatenate(([0], _KIND[data], [0])).astype(np.uint8)
    edge = np.flatnonzero(kind[1:] != kind[:-1])
    start, end = edge[:-1], edge[1:]
    real = kind[start + 1] != 0 if len(edge) else np.zeros(0, bool)
    start, end = start[real], end[real]
    row = np.searchsorted(begin, start, side="right") - 1
    if not len(start):
        return distinct_buckets(row, np.empty(0, _U), len(texts), bits)
    word = RollingHash(data).slices(start, end)
    small = np.concatenate(([0], np.cumsum(_SMALL[data], dtype=np.int32)))
    large = np.concatenate(([0], np.cumsum(_LARGE[data], dtype=np.int32)))
    has_small, n_large = small[end] > small[start], large[end] - large[start]
    shape = np.where(n_large == 0, np.where(has_small, 1, 2), np.where(has_small | (n_large == 1), 3, 4)).astype(_U)
    symbol = kind[start + 1] == 2
    shape[symbol] = word[symbol]
    follows = np.concatenate(([False], row[1:] == row[:-1]))
    shape[follows & np.concatenate(([False], word[1:] == word[:-1]))] = 5
    pair, third = follows, follows & np.concatenate(([False], follows[:-1]))

    def gram(values: np.ndarray, salt: int) -> np.ndarray:
        return scramble(values * _U(0x9FB21C651E98DF25) + _U(salt))

    def chained(values: np.ndarray, back: int) -> np.ndarray:
        out = values[back:].copy()
        for i in range(1, back + 1):
            out = out * _U(0x2545F4914F6CDD1D) + values[back - i:len(values) - i]
        return out

    parts = [
        (row, gram(word, 1)), (row[1:][pair[1:]], gram(chained(word, 1), 2)[pair[1:]]),
        (row, gram(shape, 3)), (row[1:][pair[1:]], gram(chained(shape, 1), 4)[pair[1:]]),
        (row[2:][third[2:]], gram(chained(shape, 2), 5)[third[2:]]),
    ]
    return distinct_buckets(np.concatenate([r for r, _ in parts]), np.concatenate([h for _, h in parts]), len(texts), bits)


def quality_model(documents: DataFrame, labels: DataFrame, training: Column, model: Ftrl = MODEL) -> np.ndarray:
    """Weights learned from the labelled documents for which ``training`` (over ``labels``) holds."""
    sample = labelled_sample(documents, labels, "quality", training, model.max_rows)
    return fit(sample, lambda texts: quality_features(texts, model.bits), model)


def quality_scores(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(__row, __score)`` for all documents."""
    bits = len(weights).bit_length() - 1
    return scored(documents, weights, lambda texts: quality_features(texts, bits))
