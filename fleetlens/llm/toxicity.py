"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic rows and unlabelled rows train a linear classifier in numpy over the words of a text and their first
letters (which catch inflected and compounded forms). The risk is the one of positive-unlabelled learning,
``prior * loss(P, +) + max(0, loss(U, -) - prior * loss(P, -))``: negatives are never told, the class prior corrects for
the positives among the unlabelled rows, and the bound at zero keeps the correction from being over-fitted. Where the
second term turns negative the step goes back up its gradient.

Bounds: at most ``POSITIVES`` confirmed rows and ``UNLABELLED`` rows are learnt from, chosen by a hash of their keys; the
vocabulary keeps features that are commoner among the confirmed rows by ``MIN_Z`` standard errors and ``MIN_LIFT`` times and
are in at least ``MIN_ROWS`` of them, however small a share that is: rare kinds of toxic text keep their words. Every row is
scored.

Defined cases: null and empty texts get the score of a text without features; repeated rows are scored each; rows whose
label is null, or that have both labels, teach nothing; without any confirmed row all scores are the prior 0; labels,
lang, source and the key never enter a score; rows without a key are in no fold and not held out, and teach nothing; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.labelled import Rows, fold_of, learning_keys, least_by_hash, row_sums, sigmoid, text_rows
from fleetlens.llm.words import FOLD, _buffer, alnum_words, located_words, mix, row_chunks, text_column

POSITIVES = 3_000
UNLABELLED = 9_000
BUCKETS = 1 << 18
MIN_Z = 4.0
MIN_LIFT = 3.0
MIN_ROWS = 4
STARTS = (4, 5, 6)
EPOCHS = 150
RATE = 0.1
_CLASSES = alnum_words()


def text_features(texts: pa.Array) -> list[np.ndarray]:
    """Distinct feature numbers of each text: hashed words, and hashed first bytes of words."""
    names, starts, ends, counts = located_words(texts, _CLASSES, FOLD)
    data, edges = _buffer(texts)
    data = np.concatenate([FOLD[data], np.zeros(8, np.uint8)])
    at = starts + np.repeat(edges[:-1], counts)
    sizes = ends - starts
    begin, out = 0, []
    mask = np.uint64(BUCKETS - 1)
    for count in counts:
        _, first = np.unique(names[begin:begin + count], return_index=True)
        place, size = at[begin:begin + count][first], sizes[begin:begin + count][first]
        columns = [mix(names[begin:begin + count][first])]
        packed = np.zeros(len(place), np.uint64)
        # A word that is shorter ends in zeros, whatever follows it.
        for k in range(max(STARTS)):
            packed |= np.where(k < size, data[place + k], 0).astype(np.uint64) << np.uint64(8 * k)
            if k + 1 in STARTS:
                columns.append(mix(packed + (np.uint64(k) << np.uint64(56))))
        out.append(np.unique(np.concatenate(columns) & mask).astype(np.int32))
        begin += int(count)
    return out


def _sampled(docs: DataFrame, keys: DataFrame, count: int, seed: int) -> list[np.ndarray]:
    """Features of the texts of at most ``count`` chosen keys."""
    rows = text_rows(docs).join(F.broadcast(keys), "doc_id", "left_semi")

    def features(batches):
        for batch in batches:
            for part in row_chunks(batch, "text"):
                found = text_features(text_column(part.column(1)))
                yield pa.record_batch([part.column(0), pa.array([f.tobytes() for f in found], pa.binary())],
                                      names=["doc_id", "features"])

    return least_by_hash(rows.mapInArrow(features, "doc_id long, features binary"), count, seed)


def _logistic(margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss log(1 + exp(-margin)) and its derivative."""
    return np.logaddexp(0, -margin), -sigmoid(-margin)


def risk_gradient(positive: Rows, unlabelled: Rows, theta: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk at weights and offset ``theta``, and the direction to step against: the gradient of the whole
    risk or, where the second term is below zero, that of the term turned round."""
    score_p, score_u = (rows.dot(theta[:-1]) + theta[-1] for rows in (positive, unlabelled))
    n_p, n_u = len(score_p), max(len(score_u), 1)
    plus, d_plus = _logistic(score_p)
    minus_p, d_minus_p = _logistic(-score_p)
    minus_u, d_minus_u = _logistic(-score_u)
    rest = minus_u.sum() / n_u - prior * minus_p.mean()
    if rest >= 0:
        on_p, on_u = prior * (d_plus + d_minus_p) / n_p, -d_minus_u / n_u
    else:
        on_p, on_u = -prior * d_minus_p / n_p, d_minus_u / n_u
    size = len(theta) - 1
    weights = positive.gradient(on_p, size) + unlabelled.gradient(on_u, size)
    return prior * plus.mean() + max(rest, 0.0), np.append(weights, on_p.sum() + on_u.sum())


def nn_pu(positive: Rows, unlabelled: Rows, prior: float, size: int) -> tuple[np.ndarray, float]:
    """Weights and offset that minimise the non-negative risk, by full-batch Adam."""
    theta = np.zeros(size + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, EPOCHS + 1):
        _, gradient = risk_gradient(positive, unlabelled, theta, prior)
        gradient[:-1] += 1e-5 * theta[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta - RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _telling(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> np.ndarray:
    """Features that tell: clearly commoner among positives than among unlabelled rows, and MIN_LIFT times as common there
    as among negatives, whose share follows from the other two and the prior."""
    n_p, n_u = len(positive), max(len(unlabelled), 1)
    in_p = np.bincount(np.concatenate(positive), minlength=BUCKETS)
    in_u = np.bincount(np.concatenate(unlabelled), minlength=BUCKETS) if unlabelled else np.zeros(BUCKETS)
    pooled = (in_p + in_u + 1) / (n_p + n_u + 2)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u))
    share_n = np.maximum(in_u / n_u - prior * in_p / n_p, 0) / (1 - prior) + 1 / n_u
    return (z >= MIN_Z) & (in_p / n_p >= MIN_LIFT * share_n) & (in_p >= MIN_ROWS)


class Model:
    def __init__(self, weights: np.ndarray, offset: float):
        self.weights, self.offset = weights.astype(np.float32), offset

    def scores(self, texts: pa.Array) -> np.ndarray:
        rows = Rows(text_features(texts))
        return sigmoid(row_sums(self.weights[rows.ids], rows.edges) + self.offset)


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    if not positive or not prior:
        return Model(np.zeros(BUCKETS), -500.0)
    prior = min(prior, 0.95)
    slot = np.flatnonzero(_telling(positive, unlabelled, prior))
    number = np.full(BUCKETS, -1)
    number[slot] = np.arange(len(slot))

    def rows(features):
        return Rows([found[found >= 0] for found in (number[f] for f in features)])

    found, offset = nn_pu(rows(positive), rows(unlabelled), prior, len(slot))
    weights = np.zeros(BUCKETS)
    weights[slot] = found
    return Model(weights, offset)


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          prior: float | None = None) -> Model:
    """``prior``: share of toxic texts; by default that of the labelled rows outside the held-out fold."""
    keys = learning_keys(labels, "toxic")
    if prior is None:
        prior = keys.agg(F.avg("label").alias("p")).first()["p"] or 0.0
    toxic = least_by_hash(keys.where("label = 1").select("doc_id"), positives)
    others = text_rows(docs).select("doc_id").where(F.col("doc_id").isNotNull()).where(fold_of(F.col("doc_id")) != 0)
    chosen = [_sampled(docs, toxic, positives, 0), _sampled(docs, least_by_hash(others, unlabelled, 1), unlabelled, 1)]
    sets = [[np.frombuffer(r["features"], np.int32) for r in rows.collect()] for rows in chosen]
    return fit(*sets, prior)


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its key and a score from 0 to 1."""

    def score(batches):
        for batch in batches:
            for part in row_chunks(batch, "text"):
                found = model.scores(text_column(part.column(1)))
                yield pa.record_batch([part.column(0), pa.array(found)], names=["doc_id", "score"])

    return text_rows(docs, text, key).mapInArrow(score, "doc_id long, score double")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score_toxicity(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
