"""Tables in the folder that all executors share, and running totals over a global order."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.session import shared_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: later jobs start there, also when executors are lost."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Columns of ``in_ranges``.
RANGE, ROW = "_range", "_row"


def in_ranges(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` written in ranges of ``order``, with the number of the range and one of its own for every row.

    Rows that are equal in all of ``order`` are dealt over ranges by where they are read.
    """
    tie = "_tie"
    dealt = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order, tie)
    numbered = dealt.sortWithinPartitions(*order, tie).withColumns(
        {RANGE: F.spark_partition_id(), ROW: F.monotonically_increasing_id()})
    return written(numbered.drop(tie), name)


def running_total(ranged: DataFrame, weight: str, before: str) -> DataFrame:
    """``before``: the sum of ``weight`` over all rows that come earlier in the order of ``in_ranges``.

    Ranges are summed first and their sums, one for each range, added up; inside a range a window goes on from there. The
    number of a row grows along the order, so it alone sorts a range.
    """
    sums = ranged.groupBy(RANGE).agg(F.sum(weight).alias("_sum"))
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(RANGE, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(RANGE).orderBy(ROW).rowsBetween(Window.unboundedPreceding, -1)
    found = ranged.withColumn(before, F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return found.join(F.broadcast(starts), RANGE).withColumn(before, F.col(before) + F.col("_start")).drop("_start")
