"""Operators for training-data pipelines over large text corpora, and the queries that apply them."""

from .queries import ORACLES, QUERIES  # noqa: F401
