"""Quality scores by hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

Words are runs of letters and digits, and runs of other visible characters; a word that repeats the one before it is
written as one fixed word. Words and pairs of words are hashed into ``BUCKETS`` weights. A row is scored as a sparse dot
product of its n-gram shares with the weights, whatever its length.

Bound: at most ``SAMPLE_ROWS`` labelled rows are learnt from, chosen by a hash of their keys. Every row is scored.

Defined cases: null and empty texts have no n-gram and get the score of the offset alone; repeated rows are scored each;
rows whose label is null, or that have both labels, teach nothing; without labels every score is 0.5; labels, lang,
source and the key never enter a score; rows without a key are in no fold, so the query's ``held_out`` is null for them; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.labelled import fold_of, learning_keys, least_by_hash, row_sums, sigmoid, text_rows
from fleetlens.llm.words import PLAIN, mixed_words, mix, row_chunks, text_column, word_names

SAMPLE_ROWS = 8_000
BUCKETS = 1 << 18
THRESHOLD = 0.3
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.5, 1.0
# Shares of n-grams are small; this brings them to the size of ordinary features.
SCALE = 16.0
_CLASSES = mixed_words()
_REPEAT = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every word, bucket of every pair (the first word of a text has none and repeats itself), word counts."""
    names, counts = word_names(texts, _CLASSES, PLAIN)
    first = np.cumsum(counts) - counts
    first = first[counts > 0]
    same = np.zeros(len(names), bool)
    same[1:] = names[1:] == names[:-1]
    same[first] = False
    names = np.where(same, _REPEAT, names)
    mask = np.uint64(BUCKETS - 1)
    single = (mix(names) & mask).astype(np.int64)
    pair = np.empty_like(names)
    pair[1:] = mix(names[:-1] * _PAIR + names[1:])
    pair = (pair & mask).astype(np.int64)
    pair[first] = single[first]
    return single, pair, counts


def row_features(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text and their shares."""
    single, pair, counts = ngrams(texts)
    out, begin = [], 0
    for count in counts:
        both = np.concatenate([single[begin:begin + count], pair[begin:begin + count]])
        found, times = np.unique(both, return_counts=True)
        out.append((found.astype(np.int32), (times * (SCALE / max(len(both), 1))).astype(np.float32)))
        begin += int(count)
    return out


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for logistic loss; the last coordinate is the offset."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, ids: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(ids)
        gradient = (sigmoid(np.array(weights @ values)) - label) * values
        squares = self.n[ids] + gradient**2
        self.z[ids] += gradient - (np.sqrt(squares) - np.sqrt(self.n[ids])) / ALPHA * weights
        self.n[ids] = squares


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Weights after EPOCHS passes over the rows in the order given."""
    learner = Ftrl(BUCKETS)
    for _ in range(EPOCHS):
        for ids, values, label in rows:
            learner.update(np.append(ids, BUCKETS), np.append(values, 1.0), label)
    return learner.weights().astype(np.float32)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Features are made where the texts are; one task then takes the bounded sample through the updates."""
    keys = least_by_hash(learning_keys(labels, "quality"), sample_rows)
    rows = text_rows(docs).join(F.broadcast(keys), "doc_id")

    def features(batches):
        for batch in batches:
            for part in row_chunks(batch, "text"):
                found = row_features(text_column(part.column(1)))
                yield pa.record_batch([
                    part.column(0), part.column(2), pa.array([i.tobytes() for i, _ in found], pa.binary()),
                    pa.array([v.tobytes() for _, v in found], pa.binary()),
                ], names=["doc_id", "label", "ids", "shares"])

    def trained(batches):
        sample = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32), y) for batch in batches
                  for y, i, v in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)]
        yield pa.record_batch([pa.array([fit(sample).tobytes()], pa.binary())], names=["weights"])

    made = rows.select("doc_id", "text", "label").mapInArrow(features, "doc_id long, label int, ids binary, shares binary")
    found = least_by_hash(made, sample_rows).repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "ids")
    weights = [np.frombuffer(r["weights"], np.float32) for r in found.mapInArrow(trained, "weights binary").collect()]
    return sum(weights, np.zeros(BUCKETS + 1, np.float32))


def text_scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    single, pair, counts = ngrams(texts)
    edges = np.concatenate([[0], np.cumsum(counts)])
    total = row_sums(weights[single].astype(np.float64) + weights[pair], edges)
    return sigmoid(total * (SCALE / np.maximum(2 * counts, 1)) + weights[-1])


def batch_scores(texts: pa.Array, weights: np.ndarray) -> pa.Array:
    """Scores of a batch of any size, a megabyte of text at a time."""
    batch = pa.record_batch([text_column(texts)], names=["text"])
    found = [text_scores(part.column(0), weights) for part in row_chunks(batch, "text")]
    return pa.array(np.concatenate(found) if found else np.zeros(0))


def score_quality(docs: DataFrame, weights: np.ndarray, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its key and a score from 0 to 1."""

    def score(batches):
        for batch in batches:
            for part in row_chunks(batch, "text"):
                found = text_scores(text_column(part.column(1)), weights)
                yield pa.record_batch([part.column(0), pa.array(found)], names=["doc_id", "score"])

    return text_rows(docs, text, key).mapInArrow(score, "doc_id long, score double")


def keep_good(docs: DataFrame, weights: np.ndarray, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` with a score of ``threshold`` or more, all columns as they were."""

    # Texts stay in Arrow; as pandas strings a batch would be held several times over.
    @F.arrow_udf("double")
    def score(values: pa.Array) -> pa.Array:
        return batch_scores(values, weights)

    return docs.where(score(F.coalesce(F.col(text), F.lit(""))) >= threshold)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score_quality(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
