"""Bounded samples of labelled rows, and sparse rows of hashed features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold_of(key: Column) -> Column:
    """Fold 0 is held out."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(FOLDS)


def text_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and text only, so that no other column can reach a score or clash with one; null text is empty."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def learning_keys(labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """Keys outside the held-out fold with one label each; keys without a label or with two different ones are left out."""
    rows = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).where(fold_of(F.col("doc_id")) != 0)
    kept = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    return kept.where(F.col("label") == F.col("most")).select("doc_id", "label")


def least_by_hash(rows: DataFrame, count: int, seed: int = 0) -> DataFrame:
    """At most ``count`` rows: those whose keys have the least hash, so the choice is the same in every run."""
    return rows.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(count)


class Rows:
    """Sparse rows: ``ids`` and ``values`` of all rows in turn, and where each row begins."""

    def __init__(self, ids: list[np.ndarray], values: list[np.ndarray] | None = None):
        counts = np.array([len(row) for row in ids], np.int64)
        self.edges = np.concatenate([[0], np.cumsum(counts)])
        self.counts = counts
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        self.values = np.concatenate(values) if values else np.ones(len(self.ids))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return row_sums(weights[self.ids] * self.values, self.edges)

    def gradient(self, errors: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.ids, self.values * np.repeat(errors, self.counts), size)


def row_sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[edges[1:]] - total[edges[:-1]]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))
