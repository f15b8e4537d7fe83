"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Per-coordinate rates follow from the summed squared gradients; the L1 penalty leaves most weights
at zero, so what is broadcast is a short list of (bucket, weight).

Defined results: as for the quality classifier (``quality.py``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from .ftrl import Ftrl, distinct_buckets, fit, labelled_sample, scored
from .tokens import NOT_ALNUM, scramble, words_of

#: Chosen on one of the training folds against the others (README).
MODEL = Ftrl(bits=20, alpha=3.0, l1=3.0, l2=0.1, rounds=2)
#: Distances between the two words of a pair: one is a bigram, more are skip-grams.
REACH = (1, 2, 3)


def toxic_features(texts: list[bytes], bits: int = MODEL.bits) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, and pairs of words one to three apart, without case and punctuation."""
    words = words_of(texts, NOT_ALNUM)
    word, row = words.hashes(), words.row
    rows, hashes = [row], [word]
    for gap in REACH:
        same = row[gap:] == row[:-gap]
        pair = word[:-gap] * np.uint64(0x9FB21C651E98DF25) + word[gap:] + np.uint64(min(gap, 2))
        rows.append(row[gap:][same])
        hashes.append(scramble(pair[same]))
    return distinct_buckets(np.concatenate(rows), np.concatenate(hashes), len(texts), bits)


def toxicity_model(documents: DataFrame, labels: DataFrame, training: Column, model: Ftrl = MODEL) -> np.ndarray:
    """Weights learned from the labelled documents for which ``training`` (over ``labels``) holds."""
    sample = labelled_sample(documents, labels, "toxic", training, model.max_rows)
    return fit(sample, lambda texts: toxic_features(texts, model.bits), model)


def toxicity_scores(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(__row, __score)`` for all documents."""
    bits = len(weights).bit_length() - 1
    return scored(documents, weights, lambda texts: toxic_features(texts, bits))
