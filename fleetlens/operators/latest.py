"""Keep the newest rows of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = 1) -> DataFrame:
    """The ``rows`` newest rows per key by descending ``order``.

    Spark cuts every map task down to ``rows`` per key before the shuffle (WindowGroupLimit), so a hot key sends at most
    ``rows`` times the number of map tasks to its reducer.
    """
    spec = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(spec)).where(F.col("_rank") <= rows).drop("_rank")


def newest_by_state(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key as an aggregate, which update-mode streams accept."""
    values = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*")
