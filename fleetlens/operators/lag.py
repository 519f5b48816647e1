"""LAG over ordered keys that stays bounded when one key holds most of the rows.

A plain ``lag().over(partitionBy(key))`` puts a whole key in one task. Where a key is
that large, the order column is cut into chunks at its quantiles, so a (key, chunk) group holds about one chunk of rows. What a chunk needs from
the past is one row: the last row of the key's previous chunk. Those rows are found with a pre-aggregated ``max_by``
(one row per key and chunk) and added as seed rows at the head of the next chunk, so one shuffle of the data is enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

CHUNK = "_chunk"
_SEED = "_seed"

# Rows of one key that a task should sort at a time. A table whose largest key has fewer is not cut.
ROWS_PER_CHUNK = 8_000_000
# Values looked at per chunk to place its edge.
SAMPLES_PER_CHUNK = 100


def _as_number(df: DataFrame, column: str):
    if isinstance(df.schema[column].dataType, TimestampType):
        return F.unix_micros(column).cast("double")
    return F.col(column).cast("double")


def order_splits(
    df: DataFrame, column: str, keys: Sequence[Sequence[str]], rows_per_chunk: int | None = None
) -> tuple[float, ...]:
    """Quantiles of ``column`` that cut the largest group of any of the ``keys`` into chunks; empty when no group is large.

    Like a range partitioner this looks at the data before the plan is built: rows are counted by key (aggregated before
    the shuffle), and only where a key is too large, a sample of the order column of such keys places the edges. Where
    they lie changes how the work is split, not the result. There is no upper limit to the number of chunks.
    """
    rows_per_chunk = rows_per_chunk or ROWS_PER_CHUNK
    cuts: set[float] = set()
    for key in keys:
        large = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_chunk)
        most, total = large.agg(F.max("_n"), F.sum("_n")).first()
        if most is None:
            continue
        chunks = -(-most // rows_per_chunk)
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
        rows = df.select(*key, _as_number(df, column).alias("v")).alias("a")
        share = min(1.0, SAMPLES_PER_CHUNK * chunks / most)
        rows = rows.join(large.select(*key).alias("b"), same, "left_semi").select("v")
        rows = rows.sample(share, seed=7) if share < 1.0 else rows
        shares = [i / chunks for i in range(1, chunks)]
        cuts.update(rows.agg(F.percentile_approx("v", shares, 10 * max(chunks, 1000))).first()[0] or ())
    return tuple(sorted(cuts))


def with_chunk(df: DataFrame, column: str, splits: Sequence[float]) -> DataFrame:
    """Add the chunk number of ``column``; equal values always share a chunk."""
    if not splits:
        return df.withColumn(CHUNK, F.lit(0))
    from pyspark.ml.feature import Bucketizer

    edges = [float("-inf"), *splits, float("inf")]
    cut = Bucketizer(splits=edges, inputCol="_order", outputCol=CHUNK, handleInvalid="keep")
    chunked = cut.transform(df.withColumn("_order", _as_number(df, column))).drop("_order")
    return chunked.withColumn(CHUNK, F.col(CHUNK).cast("int"))


def lag_over(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    splits: Sequence[float] = (),
    tail_source: DataFrame | None = None,
) -> DataFrame:
    """Add, for every ``new: source`` in ``values``, ``source`` of the key's previous row by ``order``.

    ``order[0]`` is the column ``splits`` were taken from; the rest break ties. ``tail_source`` may name a cheaper
    frame with the same rows (for instance the scan below an earlier window) to find the seed rows in. The result keeps
    the chunk number as ``_chunk`` so that later windows can reuse the partitioning.
    """
    rows = with_chunk(df, order[0], splits)
    if splits:
        carried = list(dict.fromkeys([*order, *values.values()]))
        carried = [c for c in carried if c not in keys]
        tails = (
            with_chunk(df if tail_source is None else tail_source, order[0], splits)
            .groupBy(*keys, CHUNK)
            .agg(F.max_by(F.struct(*carried), F.struct(*order)).alias("_tail"))
        )
        following = F.lead(CHUNK).over(Window.partitionBy(*keys).orderBy(CHUNK))
        seeds = (
            tails.withColumn("_next", following)
            .where(F.col("_next").isNotNull())
            .select(*keys, F.col("_next").alias(CHUNK), "_tail.*", F.lit(True).alias(_SEED))
        )
        rows = rows.withColumn(_SEED, F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    spec = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    rows = rows.withColumns({new: F.lag(source).over(spec) for new, source in values.items()})
    return rows.where(~F.col(_SEED)).drop(_SEED) if splits else rows
