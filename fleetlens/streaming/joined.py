"""Headway and motion as append streams, for sinks that take rows once and for all.

A report's speed comes from the LAG of its vehicle and its gap from the LAG of its line and direction. Both are streams
under a watermark, and they meet in Spark's stream-stream join on line, vehicle and event time. Equal event times bound the
join on both sides, so the watermark evicts what it has passed: the join holds reports of the open seconds only. The inner
join gives headways, the left outer join every report's motion, whose gap is NULL once the watermark rules a match out.

The jobs (``jobs.py``) keep the same facts on one row and need neither join; these streams are for consumers that want the
events themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.plans import headway, motion
from fleetlens.sources.positions import watermarked
from fleetlens.streaming.lag_state import stream_lag
from fleetlens.streaming.ordered import FIX

SLOT_SECONDS = 3600
KEYS = ["linha", "p", "event_time"]


def with_previous_fix(positions: DataFrame, slot_seconds: int = SLOT_SECONDS, ttl_seconds: float | None = None) -> DataFrame:
    rows = stream_lag(watermarked(positions), motion.VEHICLE, ["c", "sl", "py", "px"], FIX, slot_seconds, ttl_seconds=ttl_seconds)
    return rows.withColumn("from_time", F.timestamp_micros("from_time"))


def gaps(positions: DataFrame, slot_seconds: int = SLOT_SECONDS, ttl_seconds: float | None = None) -> DataFrame:
    rows = stream_lag(watermarked(positions), motion.LINE_WAY, ["p", "py", "px"], headway.NEIGHBOUR, slot_seconds, ttl_seconds=ttl_seconds)
    return rows.where(headway.other_vehicle()).select(
        F.col("c").alias("linha"), "p", "event_time", F.col("event_id").alias("gap_event_id"), headway.gap_km().alias("gap_km"))


def headway_events(positions: DataFrame, slot_seconds: int = SLOT_SECONDS, ttl_seconds: float | None = None) -> DataFrame:
    """Inner join: one row per report with a plausible speed and a neighbour."""
    rows = with_previous_fix(positions, slot_seconds, ttl_seconds).where(motion.moved())
    speeds = motion.plausible(rows.select(F.col("c").alias("linha"), "p", "event_time", motion.step_speed().alias("speed_kmh")))
    near = gaps(positions, slot_seconds, ttl_seconds).where(F.col("gap_km") > headway.MIN_GAP_KM)
    found = speeds.where(F.col("speed_kmh") >= headway.MIN_SPEED_KMH).join(near, KEYS).withColumn(
        "headway_min", headway.headway_minutes(F.col("gap_km"), F.col("speed_kmh")))
    return found.where(F.col("headway_min") <= headway.MAX_HEADWAY_MIN).withColumnRenamed("gap_event_id", "event_id")


def motion_with_gaps(positions: DataFrame, slot_seconds: int = SLOT_SECONDS, ttl_seconds: float | None = None) -> DataFrame:
    """Left outer join: every report's speed, 0 when unknown, with the gap of the matching line report where there is one."""
    speeds = with_previous_fix(positions, slot_seconds, ttl_seconds).select(
        "event_id", F.col("c").alias("linha"), "sl", "p", "event_time", F.coalesce(motion.step_speed(), F.lit(0.0)).alias("speed_kmh"))
    return speeds.join(gaps(positions, slot_seconds, ttl_seconds), KEYS, "left")
