"""Whitening of embeddings: their leading principal components, each scaled to unit variance.

Entries become integers (``floor(64 c) + 1000000``), and the model is fitted on every distinct vector once. Spark finds the
distinct vectors, their number and exact sums, and then the covariance: every task centres its vectors before it multiplies
them and hands on one matrix, and matrices are added row by row in the order of the tasks, so a run repeats to the bit. The
driver only ever holds one matrix of the width of a vector. There it is brought to tridiagonal form by mirrors, its largest
eigenvalues are found by bisection on Sturm counts and its components by inverse iteration (``eigen.py``). The components,
a few rows as wide as a vector, go to all tasks, which project every row in one scan.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are dropped; repeated rows and null keys
are returned each; components whose eigenvalue is zero but for rounding cannot be scaled and are left out, so a table of
equal vectors gives no row; vectors of different widths raise a ``ValueError``, and entries whose integers do not fit a long
an arithmetic error of Spark; other columns are ignored, whatever their names; an empty table gives no row.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.eigen import EPS, leading_pairs
from fleetlens.llm.stored import written

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
# Rows handled at once.
BLOCK = 8192


class Model(NamedTuple):
    count: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def integer_vectors(table: DataFrame, scale: int, offset: int, key: str, vector: str, *others: str) -> DataFrame:
    """``vec_id`` and ``x``, the entries as integers, of the rows that take part; ``others`` stay as they are."""
    entries = F.col(vector).cast("array<double>")
    rows = table.select(F.col(key).cast("long").alias("vec_id"), entries.alias("x"), *others)
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("x").isNotNull() & (F.size("x") > 0)).where(finite)
    return rows.withColumn("x", F.transform("x", lambda c: F.floor(c * scale) + F.lit(offset).cast("long")))


def common_width(rows: DataFrame) -> int:
    """Width of all vectors of ``x``; 0 if there are none."""
    least, most = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != most:
        raise ValueError(f"vectors are {least} to {most} wide")
    return least or 0


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _blocks(batches, column: str, width: int):
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            some = batch.slice(begin, BLOCK)
            yield some, matrix_of(some.column(some.schema.get_field_index(column)), width)


def column_sums(rows: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact sum of every entry of ``x``."""

    def partial(batches):
        count, sums = 0, np.zeros(width, object)
        for _, x in _blocks(batches, "x", width):
            # Sums of a block fit in a long unless its entries are huge.
            fits = int(np.abs(x).max(initial=0)) * max(len(x), 1) < 1 << 62
            sums += (x if fits else x.astype(object)).sum(0)
            count += len(x)
        if count:
            yield pa.record_batch([pa.array([count] * width, pa.int64()), pa.array(range(width), pa.int32()),
                                   pa.array([str(int(s)) for s in sums])], names=["n", "place", "total"])

    parts = rows.select("x").mapInArrow(partial, "n long, place int, total string")
    summed = parts.groupBy("place").agg(F.sum("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums = np.zeros(width, object)
    for place, _, total in summed:
        sums[place] = int(total)
    return (summed[0][1] if summed else 0), sums


def centred(x: np.ndarray, count: int, sums: np.ndarray) -> np.ndarray:
    """``count * x - sums``, exact: as longs, or as Python integers where those could overflow."""
    bound = count * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0)
    if bound < 1 << 62:
        return x * np.int64(count) - sums.astype(np.int64)
    return x.astype(object) * count - sums


def _added(parts: DataFrame, width: int) -> np.ndarray:
    """Sum of the matrices that tasks handed on as ``task``, ``place`` (the row) and ``entries``."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(frame.sort_values("task")["entries"].tolist(), axis=0)
        return pd.DataFrame({"place": frame["place"].iloc[:1], "entries": [total]})

    out = np.zeros((width, width))
    for place, entries in parts.groupBy("place").applyInPandas(add, "place int, entries array<double>").collect():
        out[place] = entries
    return out


def second_moments(rows: DataFrame, width: int, out_width: int, change) -> np.ndarray:
    """Sum over all rows of the outer product of ``change(x)`` with itself."""

    def partial(batches):
        total = np.zeros((out_width, out_width))
        for _, x in _blocks(batches, "x", width):
            moved = change(x)
            total += moved.T @ moved
        task = TaskContext.get().partitionId()
        yield pa.record_batch([pa.array([task] * out_width, pa.int32()), pa.array(range(out_width), pa.int32()),
                               pa.array(list(total), pa.list_(pa.float64()))], names=["task", "place", "entries"])

    return _added(rows.select("x").mapInArrow(partial, "task int, place int, entries array<double>"), out_width)


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Model:
    """The leading components of vectors ``x`` that are given once each."""
    count, sums = column_sums(distinct, width)
    if not count:
        return Model(0, sums, np.zeros(0), np.zeros((width, 0)), 0.0)
    covariance = second_moments(distinct, width, width, lambda x: (centred(x, count, sums) / count).astype(np.float64)) / count
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_pairs(covariance, components)
    some = values > width * EPS * max(values.max(), 0.0)
    return Model(count, sums, values[some], vectors[:, some], float(np.trace(covariance)))


def project(x: np.ndarray, model: Model) -> np.ndarray:
    return (centred(x, model.count, model.sums) / model.count).astype(np.float64) @ (model.vectors / np.sqrt(model.values))


def identity_error(distinct: DataFrame, width: int, model: Model) -> float:
    """Largest absolute entry of the covariance of the projected fit vectors minus the identity. Their mean is zero."""
    size = len(model.values)
    moments = second_moments(distinct, width, size, lambda x: project(x, model)) / max(model.count, 1)
    return float(np.abs(moments - np.eye(size)).max(initial=0.0))


def _deviations(centre: np.ndarray) -> np.ndarray:
    """Exact sums of squares of the rows; beyond a long Arrow refuses them."""
    if centre.dtype != object and int(np.abs(centre).max(initial=0)) ** 2 * centre.shape[1] < 1 << 63:
        return (centre * centre).sum(1)
    whole = centre.astype(object)
    return (whole * whole).sum(1)


def whiten(table: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row per row that takes part: ``vec_id``, ``deviation`` and ``whitened`` (an array), with the model's ``n``,
    ``explained`` (an array) and ``identity_error``."""
    rows = integer_vectors(table, SCALE, OFFSET, key, vector)
    width = common_width(rows)
    distinct = written(rows.select("x").distinct(), "distinct")
    model = fit(distinct, width, components)
    size = len(model.values)
    error = identity_error(distinct, width, model) if size else 0.0

    def projected(batches):
        for some, x in _blocks(batches, "x", width):
            deviation = _deviations(centred(x, model.count, model.sums))
            white = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * size, pa.array(project(x, model).ravel()))
            yield pa.record_batch([some.column(0), pa.array(deviation.tolist(), pa.int64()), white],
                                  names=["vec_id", "deviation", "whitened"])

    found = rows.select("vec_id", "x").mapInArrow(projected, "vec_id long, deviation long, whitened array<double>")
    explained = [float(v) / model.trace for v in model.values]
    return found.withColumns({
        "n": F.lit(model.count).cast("long"), "identity_error": F.lit(error),
        "explained": F.array(*[F.lit(e) for e in explained]) if explained else F.array().cast("array<double>")})


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    each = found.select("vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("whitened").alias("place", "whitened"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened",
                       F.element_at("explained", F.col("place") + 1).alias("explained"), "identity_error")
