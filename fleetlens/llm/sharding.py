"""Shards along a Hilbert curve through metadata, so that files can be skipped by any of several columns.

Each metadata dimension is cut into levels that hold about equally many rows (quantiles of numbers, running counts of the
values of strings, both over all rows; level 0 is null). A row's levels are a cell of a grid, and its place on the Hilbert
curve through that grid is its sort key. Shards are runs of that order, so a shard is a compact region: its least and
greatest value of *every* dimension are close, and a filter on any of them, or on several, skips most shards.

Runs are cut by one of two laws: ``rows`` (counts at most one apart) or ``bytes`` (sizes equal to within a row). The order
is found by ranges and running totals on narrow rows without texts; only ``write_shards`` moves texts, once. No group of
equal rows has to meet in one task: rows with equal keys are dealt over ranges by where they are read.

The method has no groups of its own: equal texts of equal metadata are neighbours on the curve (ties go by the checksum of
the text, then the key), and both laws cut through a group of copies where a shard is full.

Defined cases: null text counts no bytes and has the checksum of no bytes, 0; null metadata and null keys are a level of
their own; repeated rows are placed each; other columns are ignored or, by ``write_shards``, kept whatever their names; an
empty table gives no rows; fewer rows than shards leave shards empty.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.packing import hilbert
from fleetlens.llm.stored import ROW, in_ranges, running_total

SHARDS = 24
DIMENSIONS = ("lang", "source", "size", "doc_id")
BITS = 6
ROW_BYTES = 8
# Rank error of the quantiles of numbers: one in so many rows.
ACCURACY = 10_000


def _sized(docs: DataFrame, text: str, key: str, dimensions: Sequence[str], keep: bool) -> DataFrame:
    """Key, size, checksum, the dimensions ``d0``, ``d1``, ... and, where asked for, the whole row."""
    raw = F.col(text).cast("binary")
    made = {"size": F.coalesce(F.octet_length(raw), F.lit(0)).cast("long") + ROW_BYTES,
            "text_crc32": F.coalesce(F.crc32(raw), F.lit(0)).cast("long"), "doc_id": F.col(key).cast("long")}
    places = [(made[name] if name in made else F.col(name)).alias(f"d{i}") for i, name in enumerate(dimensions)]
    whole = [F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if keep else []
    return docs.select(*[column.alias(name) for name, column in made.items()], *places, *whole)


def _string_edges(rows: DataFrame, column: str, levels: int) -> list[str]:
    """The values at which the running count of rows, in the order of values, enters another level."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ranged = running_total(in_ranges(counts, [column], "values"), "n", "before")
    total = ranged.agg(F.sum("n")).first()[0]
    if not total:
        return []
    level = F.floor(F.col("before") * levels / F.lit(total))
    return sorted(r[0] for r in ranged.groupBy(level).agg(F.min(column)).select(F.col(f"min({column})")).collect())


def level_edges(rows: DataFrame, dimensions: int, bits: int = BITS) -> list[list]:
    """First values of the levels of each dimension: at most ``2 ** bits - 1`` values, from all rows."""
    levels = (1 << bits) - 1
    texts = [rows.schema[f"d{i}"].dataType.typeName() == "string" for i in range(dimensions)]
    shares = F.array(*[F.lit(k / levels) for k in range(levels)])
    numbers = [F.percentile_approx(f"d{i}", shares, ACCURACY).alias(f"d{i}") for i in range(dimensions) if not texts[i]]
    found = rows.agg(*numbers).first() if numbers else {}
    return [_string_edges(rows, f"d{i}", levels) if texts[i] else sorted(set(found[f"d{i}"] or [])) for i in range(dimensions)]


def _level(column: Column, edges: list) -> Column:
    """0 for null, else one more than the number of later levels that have begun."""
    if len(edges) < 2:
        return F.when(column.isNull(), 0).otherwise(1)
    begun = F.size(F.filter(F.array(*[F.lit(e) for e in edges[1:]]), lambda e: e <= column))
    return F.when(column.isNull(), 0).otherwise(begun + 1)


def on_curve(rows: DataFrame, dimensions: int, bits: int = BITS) -> DataFrame:
    """``rows`` with ``curve``, the place of their levels on the Hilbert curve."""
    edges = level_edges(rows, dimensions, bits)

    @F.pandas_udf("long")
    def place(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert(cells.to_numpy(np.int64), bits).astype(np.int64))

    cells = F.struct(*[_level(F.col(f"d{i}"), edges[i]).cast("int").alias(f"c{i}") for i in range(dimensions)])
    return rows.withColumn("curve", place(cells))


def ordered_rows(docs: DataFrame, text: str = "text", key: str = "doc_id", dimensions: Sequence[str] = DIMENSIONS,
                 bits: int = BITS, keep: bool = False) -> DataFrame:
    """A stored table of all rows along the curve; with ``keep`` each has its whole row in ``row``."""
    placed = on_curve(_sized(docs, text, key, dimensions, keep), len(dimensions), bits)
    return in_ranges(placed, ["curve", "text_crc32", "doc_id"], "curve")


def assign(ordered: DataFrame, shards: int = SHARDS, law: str = "rows") -> DataFrame:
    """``ordered`` with ``shard`` and ``slot``, the place in the shard from 0."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law {law}")
    numbered = running_total(ordered.withColumn("_one", F.lit(1).cast("long")), "_one", "_rank")
    total = ordered.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    if law == "rows":
        shard = F.expr(f"(_rank * {shards}) div {max(total['n'], 1)}")
    else:
        # The shard that a row's middle byte falls into.
        numbered = running_total(numbered, "size", "_bytes")
        shard = F.expr(f"((2 * _bytes + size) * {shards}) div {2 * max(total['bytes'] or 0, 1)}")
    placed = numbered.withColumn("shard", shard.cast("int"))
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("_rank") - F.col("_first")).drop(
        "_one", "_rank", "_bytes", "_first")


def shard_boxes(assigned: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One row per shard: rows, bytes, and for each dimension the least and greatest value and the number of nulls."""
    bounds = [column for i, name in enumerate(dimensions) for column in (
        F.min(f"d{i}").alias(f"{name}_low"), F.max(f"d{i}").alias(f"{name}_high"), F.count_if(F.col(f"d{i}").isNull()).alias(f"{name}_nulls"))]
    return assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *bounds)


def shards_within(boxes: DataFrame, wanted: dict[str, tuple]) -> DataFrame:
    """Boxes of the shards that can hold rows with every named dimension between two values, both included."""
    for name, (low, high) in wanted.items():
        boxes = boxes.where((F.col(f"{name}_high") >= F.lit(low)) & (F.col(f"{name}_low") <= F.lit(high)))
    return boxes


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, law: str = "rows", text: str = "text", key: str = "doc_id",
                 dimensions: Sequence[str] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """Write ``docs`` in folders ``shard=<n>`` below ``path``, each in curve order, and return the boxes of the shards.

    Texts are shuffled once, into ranges of the curve; every range then writes the few shards that it reaches into. A shard
    column of ``docs`` keeps its values: the folders' column gets an underscore.
    """
    ordered = ordered_rows(docs, text, key, dimensions, bits, keep=True)
    assigned = assign(ordered.drop("row"), shards, law)
    name = "shard"
    while name in docs.columns:
        name += "_"
    # Shards are runs of row numbers: the first row of each tells all rows' shards.
    firsts = sorted((r["first"], r["shard"]) for r in assigned.groupBy("shard").agg(F.min(ROW).alias("first")).collect())
    begun = F.size(F.filter(F.array(*[F.lit(first) for first, _ in firsts]), lambda first: first <= F.col(ROW)))
    shard = F.element_at(F.array(*[F.lit(number) for _, number in firsts]), begun) if firsts else F.lit(0)
    ordered.select(shard.cast("int").alias(name), ROW, "row").sortWithinPartitions(name, ROW).select(
        "row.*", name).write.partitionBy(name).parquet(path)
    return shard_boxes(assigned, dimensions)


def op11_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign(ordered_rows(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")
