"""Mergeable estimates: quantiles of log values and numbers of vehicles, from one small sketch per bin.

A sketch is made once per label set and bin, on the map side first, and kept in a table; any longer range merges its bins.
So neither the values of a range nor the pairs of line and vehicle are ever kept or meet in one task. Batch tables and
streams under a watermark take the same functions.

Quantiles (KLL, ``K`` = 200): the rank of an answer is off by at most ``RANK_ERROR`` with 99 % confidence, whatever the values;
up to about ``K`` values it is exact. Counts (HLL of 2^``LG_K`` registers): off by at most ``COUNT_ERROR``, three standard
errors, of the count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.logmetrics import seconds_of

K, RANK_ERROR = 200, 0.0165
LG_K, COUNT_ERROR = 12, 0.05


def value_sketches(logs: DataFrame, pattern: str, bin_: str, by: Sequence[str], wanted: Column | None = None) -> DataFrame:
    """A quantile sketch of the number that ``pattern`` finds in the wanted lines, per label set and bin (``window``)."""
    text = F.regexp_extract("line", pattern, 1)
    found = text != "" if wanted is None else wanted & (text != "")
    values = logs.withColumn("_value", F.when(found, text.cast("double")))
    return values.groupBy(*by, F.window("ts", f"{seconds_of(bin_)} seconds")).agg(
        F.kll_sketch_agg_double("_value", F.lit(K)).alias("sketch"), F.count("_value").alias("values")).where("values > 0")


def stored(sketched: DataFrame) -> DataFrame:
    """Bins as a table: their start and end as columns of their own."""
    others = [c for c in sketched.columns if c != "window"]
    return sketched.select(F.col("window.start").alias("bin_start"), F.col("window.end").alias("bin_end"), *others)


def quantiles(sketched: DataFrame, share: float, by: Sequence[str]) -> DataFrame:
    """The quantile of every bin."""
    return sketched.select(*by, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                           F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias("value"))


def _window(span: str):
    """The range that a bin lies in. Times of bins end just before their end."""
    return F.window("bin_start", f"{seconds_of(span)} seconds")


def merged_quantiles(bins: DataFrame, share: float, span: str, by: Sequence[str]) -> DataFrame:
    """The quantile of every range of whole stored bins."""
    ranges = bins.groupBy(*by, _window(span)).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return quantiles(ranges, share, by)


def vehicle_sketches(positions: DataFrame, bin_: str = "1m") -> DataFrame:
    """A sketch of the vehicles of every line and bin, and the newest report."""
    return positions.groupBy(F.col("c").alias("linha"), F.window("event_time", f"{seconds_of(bin_)} seconds")).agg(
        F.hll_sketch_agg("p", LG_K).alias("sketch"), F.max("event_time").alias("ultima_atualizacao"))


def active_vehicles(bins: DataFrame, span: str | None = None) -> DataFrame:
    """About how many vehicles reported on each line, in every range of stored bins or, without ``span``, ever."""
    window = [] if span is None else [_window(span)]
    times = [] if span is None else [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    united = bins.groupBy("linha", *window).agg(
        F.hll_union_agg("sketch").alias("sketch"), F.max("ultima_atualizacao").alias("ultima_atualizacao"))
    return united.select("linha", *times, F.hll_sketch_estimate("sketch").alias("total_onibus_ativos"), "ultima_atualizacao")


def active_within(bins: DataFrame, span: str) -> DataFrame:
    """About how many vehicles reported on each line in the span before the newest report, counted in whole bins."""
    newest = bins.agg(F.max("bin_end")).first()[0]
    recent = bins.where(F.col("bin_start") >= F.lit(newest) - F.expr(f"INTERVAL {seconds_of(span)} SECONDS"))
    return active_vehicles(recent)
