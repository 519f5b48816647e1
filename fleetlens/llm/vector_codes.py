"""Compression of vectors to one byte a part: exact integer k-means over Hilbert-sorted flat blocks.

Entries become integers (``floor(1024 c)``) and a vector is cut into equal parts, each with a codebook of its own. The
parts are sorted along a Hilbert curve through their (folded) entries and cut into flat blocks of ``BLOCK`` neighbours; a
block stores its integers packed, the least and greatest value of every entry (its box) and the sums of its entries. The
blocks are written once, and each round reads them:

* Distances between a block's box and the codebook entries leave a shortlist for the block. An entry whose nearest point
  of the box is further than the furthest point of the box is from some other entry cannot be nearest to anything in it.
* A block with one entry left adds its stored sums. Otherwise a small kernel compares its rows with the shortlist. All
  arithmetic is on integers: in doubles where every sum stays below 2^53, in longs or Python integers beyond.
* Tasks add counts and sums up by entry before anything is shuffled; a codebook is all that reaches the driver.

Ties go to the entry with the lower number, which the shortlist keeps in order. No bound drops an entry or a row, so the
codes are those of the plain method.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are dropped; repeated rows and null
keys are coded each; null keys come last where a codebook starts, and equal keys go by their vectors; fewer rows than entries give a shorter
codebook; vectors of different widths, or of a width that the number of parts does not divide, raise a ``ValueError``,
and errors that do not fit a long an ``OverflowError``; other columns are ignored, whatever their names; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.packing import hilbert
from fleetlens.llm.stored import written
from fleetlens.llm.whitening import common_width, integer_vectors, matrix_of

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
BLOCK = 256
# Dimensions of the curve, and bits of each; wider parts are folded into as many sums.
CURVE_DIMENSIONS, CURVE_BITS = 16, 3
# Copies of the table of label errors, and lanes that a label's rows are dealt to.
LANES = 32


class Shape(NamedTuple):
    """Width of a part, integer type of its packed entries, and mean and spread of every entry of a vector."""

    width: int
    kind: str
    means: np.ndarray
    spreads: np.ndarray


def _shape(rows: DataFrame, parts: int) -> Shape | None:
    width = common_width(rows)
    if not width:
        return None
    if width % parts:
        raise ValueError(f"vectors of {width} entries have no {parts} equal parts")

    def partial(batches):
        count, total, squares, most = 0, np.zeros(width), np.zeros(width), 0
        for batch in batches:
            x = matrix_of(batch.column(0), width)
            count += len(x)
            most = max(most, int(np.abs(x).max(initial=0)))
            total += x.sum(0, dtype=np.float64)
            squares += (x.astype(np.float64) ** 2).sum(0)
        yield pa.record_batch([pa.array(range(width), pa.int32()), pa.array([count] * width, pa.int64()), pa.array(total),
                               pa.array(squares), pa.array([most] * width, pa.int64())],
                              names=["place", "n", "total", "squares", "most"])

    found = rows.select("x").mapInArrow(partial, "place int, n long, total double, squares double, most long")
    sums = found.groupBy("place").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")], F.max("most").alias("most"))
    sums = sorted(sums.collect())
    n, most = sums[0]["n"], sums[0]["most"]
    means = np.array([r["total"] for r in sums]) / n
    spreads = np.sqrt(np.maximum(np.array([r["squares"] for r in sums]) / n - means**2, 0))
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return Shape(width // parts, kind, means, spreads)


def curve_keys(x: np.ndarray, means: np.ndarray, spreads: np.ndarray) -> np.ndarray:
    """Places on the Hilbert curve of rows of part entries: two spreads to either side of the mean are its range."""
    scaled = (x - means) / np.where(spreads > 0, spreads, 1.0)
    if scaled.shape[1] > CURVE_DIMENSIONS:
        edges = np.arange(CURVE_DIMENSIONS) * scaled.shape[1] // CURVE_DIMENSIONS
        sizes = np.diff(np.append(edges, scaled.shape[1]))
        scaled = np.add.reduceat(scaled, edges, axis=1) / np.sqrt(sizes)
    levels = 1 << CURVE_BITS
    cells = np.clip(np.floor((scaled + 2) * (levels / 4)), 0, levels - 1)
    return hilbert(cells.astype(np.int64), CURVE_BITS).astype(np.int64)


BLOCK_SCHEMA = "part int, rows array<long>, entries binary, low array<long>, high array<long>, sums array<decimal(38,0)>"


def flat_blocks(rows: DataFrame, shape: Shape, parts: int = PARTS, size: int = BLOCK) -> DataFrame:
    """Blocks of neighbours along the curve of every part, as ``BLOCK_SCHEMA``; ``rows`` have ``row`` and ``x``."""
    width, kind = shape.width, np.dtype(shape.kind)

    def cut(batches):
        for batch in batches:
            x = matrix_of(batch.column(1), width * parts)
            for part in range(parts):
                at = slice(part * width, (part + 1) * width)
                keys = curve_keys(x[:, at], shape.means[at], shape.spreads[at])
                packed = np.ascontiguousarray(x[:, at].astype(kind))
                edges = np.arange(len(x) + 1, dtype=np.int32) * (width * kind.itemsize)
                entries = pa.BinaryArray.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(edges), pa.py_buffer(packed)])
                yield pa.record_batch([pa.array(np.full(len(x), part, np.int32)), pa.array(keys), batch.column(0), entries],
                                      names=["part", "curve", "row", "entries"])

    def block(part, names, entries):
        x = np.frombuffer(entries, kind).reshape(len(names), width).astype(np.int64)
        total = x.astype(object).sum(0) if kind.itemsize == 8 else x.sum(0)
        return part, names, entries, x.min(0).tolist(), x.max(0).tolist(), [int(t) for t in total]

    def gather(batches):
        part, names, held = None, [], []

        def made():
            columns = [[value] for value in block(part, names, b"".join(held))]
            types = (pa.int32(), pa.list_(pa.int64()), pa.binary(), *[pa.list_(pa.int64())] * 2, pa.list_(pa.decimal128(38, 0)))
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                   names=["part", "rows", "entries", "low", "high", "sums"])

        for batch in batches:
            for at, name, entries in zip(*[batch.column(c).to_pylist() for c in (0, 2, 3)], strict=True):
                if names and (at != part or len(names) == size):
                    yield made()
                    names, held = [], []
                part = at
                names.append(name)
                held.append(entries)
        if names:
            yield made()

    order = ["part", "curve", "row"]
    spread = rows.select("row", "x").mapInArrow(cut, "part int, curve long, row long, entries binary")
    return written(spread.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(gather, BLOCK_SCHEMA), "blocks")


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Numbers, rising, of the entries that can be nearest to a point of a box. Exact for integers of any type."""
    nearest = np.maximum(np.maximum(low - book, book - high), 0)
    furthest = np.maximum(np.abs(book - low), np.abs(high - book))
    least = (nearest * nearest).sum(1)
    return np.flatnonzero(least <= (furthest * furthest).sum(1).min())


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest row of ``book``, the lower on ties, and the squared distance. Exact."""
    bound = 4 * x.shape[1] * max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0))) ** 2
    if bound < 1 << 53:
        wide, few = x.astype(np.float64), book.astype(np.float64)
        distances = (few * few).sum(1) - 2 * (wide @ few.T)
        at = distances.argmin(1)
        return at, ((wide * wide).sum(1) + distances[np.arange(len(x)), at]).astype(np.int64)
    kind = np.int64 if bound < 1 << 62 else object
    distances = np.stack([((x.astype(kind) - entry) ** 2).sum(1) for entry in book.astype(kind)], axis=1)
    at = distances.argmin(1)
    return at, distances[np.arange(len(x)), at]


class Blocks:
    """Reads block rows of Arrow batches against codebooks (parts, entries, width)."""

    def __init__(self, shape: Shape, books: np.ndarray):
        self.shape, self.books = shape, books
        self.wide = object if np.dtype(shape.kind).itemsize == 8 else np.int64

    def read(self, batch: pa.RecordBatch):
        for part, rows, entries, low, high, sums in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            x = np.frombuffer(entries, self.shape.kind).reshape(len(rows), self.shape.width)
            book = self.books[part].astype(self.wide)
            near = shortlist(np.array(low, self.wide), np.array(high, self.wide), book)
            yield part, np.array(rows, np.int64), x.astype(np.int64), near, sums


def _sums_by_entry(x: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    if len(x) * int(np.abs(x).max(initial=0)) < 1 << 53:
        chosen = (at[None, :] == np.arange(count)[:, None]).astype(np.float64)
        return (chosen @ x.astype(np.float64)).astype(np.int64).astype(object)
    out = np.zeros((count, x.shape[1]), object)
    np.add.at(out, at, x.astype(object))
    return out


def round_sums(blocks: DataFrame, shape: Shape, books: np.ndarray) -> DataFrame:
    """``part``, ``entry``, ``place``, ``n`` and ``total`` of the parts assigned to each entry."""
    parts, entries, width = books.shape

    def add(batches):
        reader = Blocks(shape, books)
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), object)
        for batch in batches:
            for part, _, x, near, sums in reader.read(batch):
                if len(near) == 1:
                    counts[part, near[0]] += len(x)
                    totals[part, near[0]] += [int(s) for s in sums]
                    continue
                at, _ = nearest_entries(x, books[part][near])
                counts[part, near] += np.bincount(at, minlength=len(near))
                totals[part, near] += _sums_by_entry(x, at, len(near))
        part, entry = np.nonzero(counts)
        if len(part):
            yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
                                   pa.array([[int(t) for t in row] for row in totals[part, entry]], pa.list_(pa.decimal128(38, 0)))],
                                  names=["part", "entry", "n", "sums"])

    partial = blocks.mapInArrow(add, "part int, entry int, n long, sums array<decimal(38,0)>")
    each = partial.select("part", "entry", "n", F.posexplode("sums").alias("place", "total"))
    return each.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The parts of the vectors with the least keys."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    x = np.array([r["x"] for r in least], np.int64)
    return x.reshape(len(x), parts, -1).transpose(1, 0, 2).copy()


def fit_books(blocks: DataFrame, shape: Shape, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    for _ in range(rounds):
        books = books.copy()
        for part, entry, place, n, total in round_sums(blocks, shape, books).collect():
            books[part, entry, place] = int(total) // n
    return books


def assigned(blocks: DataFrame, shape: Shape, books: np.ndarray) -> DataFrame:
    """``row``, ``part``, ``code`` and ``error`` of every part against its codebook."""

    def code(batches):
        reader = Blocks(shape, books)
        for batch in batches:
            for part, rows, x, near, _ in reader.read(batch):
                at, error = nearest_entries(x, books[part][near])
                yield pa.record_batch([pa.array(rows), pa.array(np.full(len(x), part, np.int32)), pa.array(near[at].astype(np.int32)),
                                       pa.array(error.tolist(), pa.int64())], names=["row", "part", "code", "error"])

    return blocks.mapInArrow(code, "row long, part int, code int, error long")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id``, ``code`` (two hex digits a part), ``error``, ``label_error`` and ``codebooks_sha256`` of every row that
    takes part."""
    given = integer_vectors(table, SCALE, 0, key, vector, F.col(label).alias("label"))
    rows = written(given.withColumn("row", F.monotonically_increasing_id()), "vectors")
    shape = _shape(rows, parts)
    digest = F.lit(None).cast("string")
    if shape is None:
        codes = rows.select("row", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        blocks = flat_blocks(rows, shape, parts)
        books = fit_books(blocks, shape, first_books(rows, parts, entries), rounds)
        digest = F.lit(books_digest(books))
        of_part = [F.max(F.when(F.col("part") == p, F.col("code"))) for p in range(parts)]
        codes = assigned(blocks, shape, books).groupBy("row").agg(
            F.concat(*[F.lower(F.lpad(F.hex(code), 2, "0")) for code in of_part]).alias("code"), F.sum("error").alias("error"))
    coded = written(rows.select("row", "vec_id", "label").join(codes, "row"), "codes")
    # A label may hold any share of the rows: its sum is copied to lanes, and its rows are dealt to them.
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumn(
        "lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
    dealt = coded.withColumn("lane", F.pmod(F.hash("row"), F.lit(LANES)))
    both = dealt.alias("a").join(sums.alias("b"), (F.col("a.lane") == F.col("b.lane")) & F.col("a.label").eqNullSafe(F.col("b.label")))
    return both.select("a.vec_id", "a.code", "a.error", "b.label_error", digest.alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle() -> str:
    distance = "list_sum(list_transform(list_zip(p.x, c.x), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
    steps = [f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
    list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
p AS MATERIALIZED (SELECT r, part, x[part * len(x) // {PARTS} + 1 : (part + 1) * len(x) // {PARTS}] AS x
  FROM v, range({PARTS}) AS parts(part)),
c0 AS MATERIALIZED (SELECT part, r AS entry, x FROM p WHERE r < {ENTRIES})"""]
    for k in range(1, ROUNDS + 2):
        steps.append(f"""
a{k} AS MATERIALIZED (SELECT p.r, p.part, min({{'d': {distance}, 'entry': c.entry}}) AS best
  FROM p JOIN c{k - 1} c ON c.part = p.part GROUP BY ALL)""")
        if k <= ROUNDS:
            steps.append(f"""
s{k} AS (SELECT a.part, a.best.entry AS entry, place, CAST(sum(p.x[place]) AS BIGINT) AS total, count(*) AS n
  FROM a{k} a JOIN p ON p.r = a.r AND p.part = a.part, LATERAL (SELECT unnest(range(1, len(p.x) + 1)) AS place) GROUP BY ALL),
m{k} AS (SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY place) AS x FROM s{k} GROUP BY ALL),
c{k} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x
  FROM c{k - 1} c LEFT JOIN m{k} m ON m.part = c.part AND m.entry = c.entry)""")
    last = ROUNDS + 1
    return ",".join(steps) + f""",
coded AS (SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{last} GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT v.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (r), books"""


ORACLE = _oracle()
