"""Range metrics over container logs: counts, rates, bytes and quantiles per label set and time step.

Lines are first folded into bins one step wide (partial aggregation before the shuffle); a range longer than the step is
then summed over bins, so a line is never copied into every window it falls in. A metric row stands for the half-open
range [``window_start``, ``window_end``).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86400}


def seconds_of(span: str) -> int:
    """Seconds of a span such as ``5m`` or ``24h``."""
    match = re.fullmatch(r"(\d+)([smhd])", span)
    if not match:
        raise ValueError(f"not a time span: {span!r}")
    return int(match[1]) * _UNITS[match[2]]


def _interval(seconds: int) -> str:
    return f"{seconds} seconds"


def condition(
    equal: Mapping[str, str] | None = None, matching: Mapping[str, str] | None = None, line_regex: str | None = None
) -> Column:
    """Labels equal a value or match a whole-label regex, and the text contains ``line_regex``."""
    tests = [F.col(label) == value for label, value in (equal or {}).items()]
    tests += [F.col(label).rlike(f"^(?:{pattern})$") for label, pattern in (matching or {}).items()]
    tests += [] if line_regex is None else [F.col("line").rlike(line_regex)]
    return reduce(Column.__and__, tests, F.lit(True))


def select_logs(
    logs: DataFrame,
    equal: Mapping[str, str] | None = None,
    matching: Mapping[str, str] | None = None,
    line_regex: str | None = None,
) -> DataFrame:
    """Lines whose labels equal a value or match a whole-label regex, and whose text contains ``line_regex``."""
    return logs.where(condition(equal, matching, line_regex))


def extract(logs: DataFrame, pattern: str, label: str) -> DataFrame:
    """Add the first group of ``pattern`` as a label; lines without a match drop out."""
    return logs.withColumn(label, F.regexp_extract("line", pattern, 1)).where(F.col(label) != "")


def over_time(logs: DataFrame, span: str, by: Sequence[str] = (), step: str | None = None) -> DataFrame:
    """Lines (``entries``) and bytes (``volume``) of every label set per range. ``step`` defaults to the range."""
    width, stride = seconds_of(span), seconds_of(step or span)
    if width % stride:
        raise ValueError("the range must be a whole number of steps")
    bins = logs.groupBy(*by, F.window("ts", _interval(stride)).alias("_w")).agg(
        F.count(F.lit(1)).alias("entries"), F.sum(F.octet_length("line")).alias("volume")
    )
    if width == stride:
        return bins.select(
            *by, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "entries", "volume"
        )
    every = F.expr(f"INTERVAL {stride} SECONDS")
    last = F.col("_w.start") + F.expr(f"INTERVAL {width} SECONDS")
    return (
        bins.select(*by, F.explode(F.sequence(F.col("_w.end"), last, every)).alias("window_end"), "entries", "volume")
        .groupBy(*by, "window_end")
        .agg(F.sum("entries").alias("entries"), F.sum("volume").alias("volume"))
        .select(
            *by, (F.col("window_end") - F.expr(f"INTERVAL {width} SECONDS")).alias("window_start"), "window_end",
            "entries", "volume",
        )
    )


def totals(ranges: DataFrame) -> DataFrame:
    """Sum over all label sets."""
    return ranges.groupBy("window_start", "window_end").agg(
        F.sum("entries").alias("entries"), F.sum("volume").alias("volume")
    )


def per_second(metric: Column, span: str) -> Column:
    return metric / F.lit(float(seconds_of(span)))


def label_sets(logs: DataFrame, span: str, by: Sequence[str], step: str | None = None) -> DataFrame:
    """How many label sets wrote at least one line in each range."""
    ranges = over_time(logs, span, by, step)
    return ranges.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("value"))


def quantile_over_time(
    logs: DataFrame, pattern: str, share: float, span: str, by: Sequence[str] = ("container", "stream")
) -> DataFrame:
    """Interpolated quantile of a number found in the line, per label set and range.

    Equal values are counted before the shuffle, so a group reaches its reducer as one row per distinct value.
    """
    values = extract(logs, pattern, "_text").withColumn("_value", F.col("_text").cast("double"))
    window = F.window("ts", _interval(seconds_of(span))).alias("_w")
    counted = values.groupBy(*by, window, "_value").agg(F.count(F.lit(1)).alias("_n"))
    return (
        counted.groupBy(*by, "_w")
        .agg(F.percentile("_value", share, F.col("_n")).alias("value"))
        .select(*by, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "value")
    )


def steps_of(logs: DataFrame, span: str, edges: tuple[int, int] | None = None) -> DataFrame:
    """Every range between two times, including those without lines. ``edges`` are seconds since 1970 of the first and the
    last line to cover, by default those of ``logs``; steps are made in parallel, however far apart the edges are."""
    width = seconds_of(span)
    if edges is None:
        edges = logs.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    first, last = (0, -1) if edges[0] is None else (edge // width for edge in edges)
    start = F.timestamp_seconds((F.col("id") + first) * width)
    return logs.sparkSession.range(last - first + 1).select(start.alias("window_start")).withColumn(
        "window_end", F.col("window_start") + F.expr(f"INTERVAL {width} SECONDS")
    )


def or_default(metric: DataFrame, steps: DataFrame, default: float) -> DataFrame:
    """A metric without labels at every step, ``default`` where it has no value."""
    return steps.join(metric, ["window_start", "window_end"], "left").withColumn(
        "value", F.coalesce(F.col("value"), F.lit(default))
    )


def or_unlabelled(metric: DataFrame, steps: DataFrame, default: float, label: str) -> DataFrame:
    """A labelled metric plus one series without label that is ``default`` at every step.

    This is what ``or vector(k)`` means once labels are kept: the constant never shares a label set with the metric.
    """
    constant = steps.withColumns({label: F.lit(None).cast("string"), "value": F.lit(default)})
    return metric.unionByName(constant)
