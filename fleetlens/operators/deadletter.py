"""Type coercion of raw reports, with rows that fail it routed to a dead-letter stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.schemas import REPORT

UNKNOWN_KEY = "unknown"


def _coerced() -> dict:
    return {f.name: F.col(f.name).try_cast(f.dataType) for f in REPORT.fields}


def rows_are_valid() -> Column:
    """Every field of a raw report is there and can be read as its type."""
    readable = F.lit(True)
    for column in _coerced().values():
        readable = readable & column.isNotNull()
    return readable


def split_valid(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed reports, and ``key, value`` dead letters for rows with a missing or unreadable field.

    Booleans are parsed, not tested for emptiness. A dead letter holds the raw fields as JSON and is keyed by the raw
    vehicle id, or by ``unknown`` where there is none.
    """
    readable = rows_are_valid()
    good = raw.where(readable).withColumns(_coerced())
    letter = F.to_json(F.struct(*REPORT.names), {"ignoreNullFields": "false"})
    dead = raw.where(~readable).select(
        F.coalesce(F.col("p").cast("string"), F.lit(UNKNOWN_KEY)).alias("key"), letter.alias("value")
    )
    return good, dead


def keyed_json(reports: DataFrame) -> DataFrame:
    """Reports as ``key, value`` messages keyed by vehicle."""
    return reports.select(F.col("p").cast("string").alias("key"), F.to_json(F.struct(*REPORT.names)).alias("value"))
