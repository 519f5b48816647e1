"""Time parts of vehicle reports. All of them assume the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Offset of the local wall clock and its text format.
LOCAL_OFFSET = "-03:00"
LOCAL_FORMAT = "yyyy-MM-dd HH:mm:ss"


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, cut toward zero."""
    return F.timestamp_diff("SECOND", start, end)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a timestamp, NULL when it is not one."""
    return F.try_to_timestamp(text)


def epoch_millis(ts: Column) -> Column:
    """Epoch milliseconds."""
    return F.unix_millis(ts)


def local_text(ts: Column) -> Column:
    """Local wall-clock text with the fraction of a second dropped."""
    return F.date_format(F.from_utc_timestamp(ts, LOCAL_OFFSET), LOCAL_FORMAT)


def from_local_text(text: Column) -> Column:
    """The wall-clock text read back as a timestamp, without any zone shift; NULL when it does not parse."""
    return F.try_to_timestamp(text, F.lit(LOCAL_FORMAT))


def clock(ts: Column) -> Column:
    """``HH:mm:ss`` of a timestamp."""
    return F.date_format(ts, "HH:mm:ss")
