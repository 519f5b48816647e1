"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector is centred, rotated at random and stored as the signs of its coordinates, packed into bytes, with a correction
scalar that makes the signs stand for it. What they leave over is rotated and coded in the same way, ``LAYERS`` times, so
that a code of ``LAYERS`` bits a component estimates inner products closely; a last scalar bounds the error of the estimate.

1. Every row is coded once, and codes and vectors are stored.
2. Codes meet queries in pairs of blocks, each a small task. It returns for each query the ``k`` best lower bounds of the
   products there; the k-th best of those of *all* blocks is what a neighbour has to reach.
3. The same pairs of blocks list the rows whose upper bound reaches it.
4. Only these rows' vectors are fetched, by row number, once for each block of queries that lists them, and reranked by
   exact products in double precision.

So what crosses the cluster for every block of queries are codes; vectors do where a bound leaves them. No task holds more
than two blocks, blocks are dealt by hash, and no group of equal vectors meets in one. The centre comes from a bounded
sample (``SAMPLE_ROWS``); every row is coded. ``SIGMAS`` sets the bound: at 3.5 an estimate is too low by more than it
about once in ten thousand. Work is queries times vectors, as a search over a stated set against all rows is.

Defined cases: vectors that are null, empty, zero or hold null or non-finite numbers take no part, nor rows without an id;
a query meets only vectors of its own dimension; ties go to the smaller id; rows with a repeated id are candidates each,
but none of a query's own id; equal query rows count once, and different ones of one id share a ranking; numbers too large
for an estimate are reranked; other columns are ignored, whatever their names; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from fleetlens.llm.stored import written

K = 20
QUERY_STEP = 20
SAMPLE_ROWS = 10_000
QUERY_BLOCK, VECTOR_BLOCK = 4_096, 16_384
LAYERS = 5
SIGMAS = 3.5
# Queries whose estimates are held at once; pairs whose products are.
TOGETHER = 64
PAIRS = 1 << 17
SEED = 17


def rotation(dimension: int) -> np.ndarray:
    """Random orthogonal matrix, the same in every task."""
    made, upper = np.linalg.qr(np.random.default_rng(SEED + dimension).standard_normal((dimension, dimension)))
    return made * np.sign(np.diag(upper))


def encode(vectors: np.ndarray, centre: np.ndarray, layers: int = LAYERS) -> np.ndarray:
    """Codes of the rows of ``vectors`` around ``centre``, as rows of bytes: the signs of every layer, then in single
    precision the factors of the layers, the distance to the centre and the reach of the error."""
    size = vectors.shape[1]
    turn, width = rotation(size), np.sqrt(size)
    bits, scalars = [], []
    with np.errstate(over="ignore", invalid="ignore"):
        rest = (vectors - centre) @ turn
        whole = np.linalg.norm(rest, axis=1)
        for layer in range(layers):
            norms = np.linalg.norm(rest, axis=1)
            signs = rest >= 0
            bits.append(np.packbits(signs, axis=1))
            # Cosine between a direction and its signs.
            fit = np.abs(rest).sum(1) / np.maximum(norms, 1e-300) / width
            fit[norms == 0] = 1.0
            if layer + 1 < layers:
                # The factor that leaves the least; the last layer's makes the estimate unbiased instead.
                factor = norms * fit / width
                rest = (rest - np.where(signs, 1.0, -1.0) * factor[:, None]) @ turn
            else:
                factor = norms / fit / width
                reach = norms * np.sqrt(np.maximum(1 - fit**2, 0)) / fit / np.sqrt(max(size - 1, 1))
            scalars.append(factor)
        packed = np.stack([*scalars, whole, reach], axis=1).astype("<f4")
    return np.concatenate([*bits, packed.view(np.uint8).reshape(len(vectors), -1)], axis=1)


class Codes:
    """Codes of a block of rows, made from ``vectors`` or given as ``packed`` rows of bytes."""

    def __init__(self, vectors: np.ndarray | None, centre: np.ndarray, packed: np.ndarray | None = None):
        codes = encode(vectors, centre) if packed is None else packed
        size = len(centre)
        wide = -(-size // 8)
        layers = (codes.shape[1] - 8) // (wide + 4)
        scalars = np.ascontiguousarray(codes[:, layers * wide:]).view("<f4")
        self.norms, self.reach = scalars[:, layers], scalars[:, layers + 1]
        self.centre, turned = centre, rotation(size).T.astype(np.float32)
        # Estimates are linear in the signs: the layers of a row add up to one vector, turned back from the last on.
        with np.errstate(over="ignore", invalid="ignore"):
            about = np.zeros((len(codes), size), np.float32)
            for layer in reversed(range(layers)):
                signs = np.unpackbits(codes[:, layer * wide:(layer + 1) * wide], axis=1, count=size).astype(np.float32) * 2 - 1
                about = (about + signs * scalars[:, layer:layer + 1]) @ turned
        self.about = about

    def estimates(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products (queries by rows) in single precision, and the bounds of their errors."""
        with np.errstate(over="ignore", invalid="ignore"):
            apart = queries @ self.centre
            lengths = np.linalg.norm(queries, axis=1).astype(np.float32)
            guess = queries.astype(np.float32) @ self.about.T
            guess += apart.astype(np.float32)[:, None]
            error = lengths[:, None] * (SIGMAS * self.reach + 1e-5 * self.norms)
            error += (1e-5 * np.abs(apart)).astype(np.float32)[:, None]
        unknown = ~np.isfinite(guess) | ~np.isfinite(error)
        if unknown.any():
            guess[unknown], error[unknown] = 0, np.inf
        return guess, error


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed in the order of the components; ``query`` is one, or one for each row."""
    total = np.zeros(len(vectors))
    for k in range(query.shape[-1]):
        total += vectors[:, k] * query[..., k]
    return total


def valid_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """Id, vector as doubles, and dimension of the rows that take part."""
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(whole & some).withColumn(
        "size", F.size("vector"))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64)


def _numbered(rows: DataFrame, number: str, narrow: bool) -> DataFrame:
    """``rows`` with a number for each; vectors that came in single precision are kept in it."""
    vector = F.col("vector").cast("array<float>") if narrow else F.col("vector")
    return rows.select("size", "vec_id", vector.alias("vector"), F.monotonically_increasing_id().alias(number))


def _is_single(table: DataFrame, vector: str) -> bool:
    kind = table.schema[vector].dataType
    return isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)


def _coded(rows: DataFrame, centre: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with the column ``code``."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                vectors = part.column("vector").flatten().to_numpy().astype(np.float64).reshape(-1, size)
                codes = encode(vectors, centre[int(size)])
                yield part.append_column("code", pa.array([c.tobytes() for c in codes], pa.binary()))

    kind = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(code, f"size int, vec_id long, vector {kind}, row long, code binary")


def _blocks(counts: dict[int, int], number: str, per_block: int) -> tuple[Column, Column]:
    """Block of a row among those of its dimension, and their number."""
    parts = F.lit(1)
    for dimension, count in counts.items():
        parts = F.when(F.col("size") == dimension, -(-count // per_block)).otherwise(parts)
    return F.pmod(F.xxhash64(number), parts).cast("int"), parts.cast("int")


def _bounds(held: pd.DataFrame, wanted: pd.DataFrame, centre: dict[int, np.ndarray]):
    """For some queries at a time: their first row in ``wanted``, estimates and errors; a query's own id is ruled out."""
    packed = np.frombuffer(b"".join(held["code"]), np.uint8).reshape(len(held), -1)
    codes = Codes(None, centre[int(held["size"].iloc[0])], packed)
    ids, names, queries = held["vec_id"].to_numpy(), wanted["vec_id"].to_numpy(), _matrix(wanted["vector"])
    for begin in range(0, len(queries), TOGETHER):
        guess, error = codes.estimates(queries[begin:begin + TOGETHER])
        own = names[begin:begin + TOGETHER, None] == ids
        error[own] = 0
        guess[own] = -np.inf
        yield begin, guess, error


def _lowest(centre: dict[int, np.ndarray], k: int):
    """The ``k`` best lower bounds of every query in a pair of blocks."""

    def lowest(held: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        asks, lows = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
        if len(held) and len(wanted):
            names = wanted["ask"].to_numpy()
            for begin, guess, error in _bounds(held, wanted, centre):
                low = guess - error
                if low.shape[1] > k:
                    low = np.partition(low, -k, axis=1)[:, -k:]
                asks.append(np.repeat(names[begin:begin + len(low)], low.shape[1]))
                lows.append(low.ravel())
        ask, low = np.concatenate(asks), np.concatenate(lows)
        return pd.DataFrame({"ask": ask[low > -np.inf], "low": low[low > -np.inf]})

    return lowest


def _reaching(centre: dict[int, np.ndarray]):
    """Queries of a pair of blocks with the rows whose upper bound reaches ``least``."""

    def reaching(held: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        near: list[np.ndarray] = []
        if len(held) and len(wanted):
            rows, least = held["row"].to_numpy(), wanted["least"].to_numpy(np.float64)
            for begin, guess, error in _bounds(held, wanted, centre):
                reach = (guess + error >= least[begin:begin + len(guess), None]) & (guess > -np.inf)
                near += [rows[some] for some in reach]
        else:
            wanted = wanted.iloc[:0]
        found = wanted[["size", "row_block", "query_block", "vec_id", "vector"]].assign(rows=near)
        return found[[len(r) > 0 for r in near]]

    return reaching


def _reranked(k: int):
    """Exact products of the listed rows; the best ``k`` of every query, ties to the smaller id."""

    def rerank(held: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(held) and len(wanted):
            held = held.sort_values("row")
            rows, ids, vectors = held["row"].to_numpy(), held["vec_id"].to_numpy(), _matrix(held["vector"])
            names, queries = wanted["vec_id"].to_numpy(), _matrix(wanted["vector"])
            lists = wanted["rows"].tolist()
            ends = np.cumsum([len(some) for some in lists])
            begin = 0
            while begin < len(lists):
                # Whole queries, as many as make up PAIRS pairs, one at least.
                before = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + PAIRS, "right")))
                at = np.searchsorted(rows, np.concatenate(lists[begin:end]))
                query = np.repeat(np.arange(begin, end), [len(some) for some in lists[begin:end]])
                products = exact_products(vectors[at], queries[query])
                order = np.lexsort((ids[at], -products, query))
                query = query[order]
                first = np.searchsorted(query, query)
                best = order[np.arange(len(order)) - first < k]
                query = query[np.arange(len(order)) - first < k]
                out.append(pd.DataFrame({"query_id": names[query], "vec_id": ids[at[best]], "score": products[best]}))
                begin = end
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return rerank


PAIR = ("size", "row_block", "query_block")


def candidates(coded: DataFrame, asked: DataFrame, centre: dict[int, np.ndarray], k: int) -> DataFrame:
    """``asked`` once for each block of rows that may hold a neighbour, with the ``rows`` whose bounds reach the k-th best
    lower bound of all blocks."""
    counts = {r["size"]: r["count"] for r in coded.groupBy("size").count().collect()}
    asked_counts = {r["size"]: r["count"] for r in asked.groupBy("size").count().collect()}
    row_block, row_blocks = _blocks(counts, "row", VECTOR_BLOCK)
    query_block, query_blocks = _blocks(asked_counts, "ask", QUERY_BLOCK)
    # Codes and queries go once to every block of the other side, of their own dimension.
    left = coded.where(F.col("size").isin(*asked_counts) if asked_counts else F.lit(False)).select(
        "size", "row", "vec_id", "code", row_block.alias("row_block"),
        F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("query_block"))
    met = F.explode(F.sequence(F.lit(0), row_blocks - 1)).alias("row_block")
    right = asked.select("size", "ask", "vec_id", "vector", query_block.alias("query_block"), met)
    lows = left.groupBy(*PAIR).cogroup(right.groupBy(*PAIR)).applyInPandas(_lowest(centre, k), "ask long, low float")
    order = Window.partitionBy("ask").orderBy(F.desc("low"))
    least = lows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("ask", F.col("low").alias("least"))
    bounded = asked.join(least, "ask", "left").select(
        "size", "vec_id", "vector", F.coalesce("least", F.lit(float("-inf"))).alias("least"), query_block.alias("query_block"), met)
    kind = asked.schema["vector"].dataType.simpleString()
    return left.groupBy(*PAIR).cogroup(bounded.groupBy(*PAIR)).applyInPandas(
        _reaching(centre), f"size int, row_block int, query_block int, vec_id long, vector {kind}, rows array<long>")


def _centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """Mean vector of a bounded sample, by dimension."""
    counts = {r["size"]: r["count"] for r in rows.groupBy("size").count().collect()}
    share = min(1.0, SAMPLE_ROWS / max(sum(counts.values()), 1))
    sample = rows if share == 1.0 else rows.sample(share, seed=SEED)
    means = sample.select("size", F.posexplode("vector")).groupBy("size", "pos").agg(F.avg("col").alias("mean")).collect()
    centre = {size: np.zeros(size) for size in counts}
    for r in means:
        centre[r["size"]][r["pos"]] = r["mean"]
    return centre


def nearest(table: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the best ``k`` rows of ``table`` for each query row."""
    rows = valid_vectors(table, key, vector)
    centre = _centres(rows)
    coded = written(_coded(_numbered(rows, "row", _is_single(table, vector)), centre), "codes")
    wanted = valid_vectors(queries, key, vector).dropDuplicates(["vec_id", "vector"])
    asked = written(_numbered(wanted, "ask", _is_single(queries, vector)), "queries")
    near = written(candidates(coded, asked, centre, k), "candidates")
    # Vectors travel only to the blocks of queries that list them.
    listed = near.select(*[F.col(c).alias(c) for c in PAIR], F.explode("rows").alias("row")).distinct()
    fetched = listed.join(coded.select("row", "vec_id", "vector"), "row")
    best = fetched.groupBy(*PAIR).cogroup(near.groupBy(*PAIR)).applyInPandas(
        _reranked(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op9_nearest_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(table, table.where(F.col("vec_id") % QUERY_STEP == 0))


ORACLE = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (SELECT q.vec_id AS query_id, v.vec_id,
    list_reduce(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e) WHERE q.vec_id % {QUERY_STEP} = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
