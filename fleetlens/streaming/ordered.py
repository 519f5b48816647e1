"""Reports in event-time order over a stream, with their predecessors, shared by all jobs that need order.

A streaming query may not use ``lag``, because a row's predecessor can still arrive. Here every micro-batch is put in order
inside ``foreachBatch``, where ``lag`` is an ordinary window: reports wait in a stored state table until the watermark has
passed them, and those it passes get the vehicle's previous fix and the previous report on their line from one window each.
The state is small: the reports of the last seconds, the last passed report of every vehicle and of every line and
direction, what each source partition last sent, and the watermark. That is the least over the partitions that are not idle
(``idle.py``), so a partition that lags loses nothing and a silent one holds nothing up. Reports that arrive behind the
watermark are dropped, as by any event-time window.

A batch reads the state that an earlier batch wrote and writes its own last, after all results; so a batch repeated after
a failure starts from the same state, and finds the results it has already written.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from fleetlens.operators.latest import newest_rows
from fleetlens.operators.upsert import BatchId, has_version, read_table, write_version
from fleetlens.plans import headway, motion
from fleetlens.schemas import POSITIONS
from fleetlens.streaming.idle import least_active

COLUMNS = ["event_id", "c", "sl", "p", "py", "px", "event_time"]
ROLE, SEEN = "role", "seen"
WAITING, VEHICLE, LINE, SOURCE, MARK = "waiting", "vehicle", "line", "source", "mark"
# A source partition's row has its number as ``event_id``, its newest event time, and when it was last heard of.
STATE = StructType([*[POSITIONS[c] for c in COLUMNS], StructField(SEEN, TimestampType()), StructField(ROLE, StringType())])
# Ids of reports start with the partition they came from (``sources/positions.py``).
PARTITION_SHIFT = 48

FIX = {"from_py": "py", "from_px": "px", "from_time": "event_time"}


class Step(NamedTuple):
    """What a micro-batch lets through: ordered reports, the state after them, and the watermark in microseconds."""

    rows: DataFrame
    state: DataFrame
    mark: int


def _lag(rows: DataFrame, seeds: DataFrame, keys: list[str], values: dict[str, str], ttl_us: int | None) -> DataFrame:
    """``values`` of the previous row of the same key, where ``seeds`` come before all rows; NULL if it is older than the
    time to live."""
    both = rows.withColumn("_seed", F.lit(False)).unionByName(
        seeds.withColumn("_seed", F.lit(True)), allowMissingColumns=True)
    order = Window.partitionBy(*keys).orderBy(*motion.ORDER)
    lags = {new: F.lag(old).over(order) for new, old in values.items()}
    if ttl_us is not None:
        near = F.unix_micros("event_time") - F.unix_micros(F.lag("event_time").over(order)) <= ttl_us
        lags = {new: F.when(near, value) for new, value in lags.items()}
    return both.withColumns(lags).where(~F.col("_seed")).drop("_seed")


def _sources(batch: DataFrame, state: DataFrame, now_us: int) -> DataFrame:
    """Newest event time of every source partition, and when it was last heard of."""
    sent = batch.where(F.col("event_time").isNotNull()).groupBy(F.shiftright("event_id", PARTITION_SHIFT).alias("event_id")).agg(
        F.max("event_time").alias("event_time")).withColumn(SEEN, F.timestamp_micros(F.lit(now_us)))
    known = state.where(F.col(ROLE) == SOURCE).select("event_id", "event_time", SEEN)
    return sent.unionByName(known).groupBy("event_id").agg(F.max("event_time").alias("event_time"), F.max(SEEN).alias(SEEN))


def advance(batch: DataFrame, state: DataFrame, delay_us: int, idle_us: int | None = None, now_us: int | None = None,
            ttl_us: int | None = None) -> Step | None:
    """Put a micro-batch in order; None when no report has a time yet.

    Partitions that were silent for longer than ``idle_us`` until ``now_us`` (by default the clock) do not hold the
    watermark back; without ``idle_us`` all do. A vehicle or line whose last report is older than ``ttl_us`` is forgotten.
    """
    at = F.unix_micros("event_time")
    now_us = time.time_ns() // 1000 if now_us is None else now_us
    before = state.where(F.col(ROLE) == MARK).agg(F.max(at)).first()[0]
    fresh = batch.select(*COLUMNS).where(F.col("event_time").isNotNull())
    if before is not None:
        fresh = fresh.where(at > before)
    sources = _sources(batch, state, now_us)
    least = sources.agg(F.unix_micros(least_active(F.col("event_time"), F.col(SEEN), F.timestamp_micros(F.lit(now_us)), idle_us))).first()[0]
    marks = [mark for mark in (before, None if least is None else least // 1000 * 1000 - delay_us) if mark is not None]
    if not marks:
        return None
    mark = max(marks)

    def kept(role: str) -> DataFrame:
        return state.where(F.col(ROLE) == role).select(*COLUMNS)

    pending = fresh.unionByName(kept(WAITING))
    ready = pending.where(at <= mark)
    fixes = _lag(ready, kept(VEHICLE), list(motion.VEHICLE), FIX, ttl_us)
    rows = _lag(fixes, kept(LINE), list(motion.LINE_WAY), headway.NEIGHBOUR, ttl_us)

    def last(keys, role: str) -> DataFrame:
        found = newest_rows(ready.unionByName(kept(role)), list(keys), motion.ORDER)
        # What the watermark has left behind by more than the time to live can have no follower.
        return as_state(found if ttl_us is None else found.where(at >= mark - ttl_us), role)

    line = batch.sparkSession.range(1).select(F.timestamp_micros(F.lit(mark)).alias("event_time"))
    after = as_state(pending.where(at > mark), WAITING).unionByName(last(motion.VEHICLE, VEHICLE)).unionByName(
        last(motion.LINE_WAY, LINE)).unionByName(as_state(sources, SOURCE)).unionByName(as_state(line, MARK))
    return Step(rows, after, mark)


def as_state(rows: DataFrame, role: str) -> DataFrame:
    """Rows of the state; columns that ``rows`` lack are NULL."""
    given = {**{f.name: F.lit(None).cast(f.dataType) for f in STATE.fields}, **{c: F.col(c) for c in rows.columns}, ROLE: F.lit(role)}
    return rows.select(*[given[c].alias(c) for c in STATE.names])


def run_batch(batch: DataFrame, number: BatchId, path: str, delay_us: int, keep_seconds: int,
              results: list[Callable[[DataFrame, int, BatchId], None]], idle_us: int | None = None,
              ttl_us: int | None = None) -> None:
    """Order a micro-batch, hand the rows to every result, then move the state on."""
    spark: SparkSession = batch.sparkSession
    if has_version(spark, path, number):
        return
    step = advance(batch, read_table(spark, path, STATE), delay_us, idle_us, ttl_us=ttl_us)
    if step is None:
        return
    rows = step.rows.persist()
    try:
        for result in results:
            result(rows, step.mark, number)
        write_version(step.state, path, number, keep_seconds)
    finally:
        rows.unpersist()


# What jobs take from ordered rows -------------------------------------------------------------------------------------


def speed_events(rows: DataFrame) -> DataFrame:
    moved = rows.where(motion.moved())
    return motion.plausible(moved.select(F.col("c").alias("linha"), "p", "event_time", motion.step_speed().alias("speed_kmh")))


def _gaps(rows: DataFrame) -> DataFrame:
    return rows.where(headway.other_vehicle()).select(F.col("c").alias("linha"), "p", "event_time", headway.gap_km().alias("gap_km"))


def headway_events(rows: DataFrame) -> DataFrame:
    """Speeds joined with gaps on line, vehicle and event time."""
    speeds = speed_events(rows).where(F.col("speed_kmh") >= headway.MIN_SPEED_KMH)
    gaps = _gaps(rows).where(F.col("gap_km") > headway.MIN_GAP_KM)
    found = speeds.join(gaps, ["linha", "p", "event_time"]).withColumn(
        "headway_min", headway.headway_minutes(F.col("gap_km"), F.col("speed_kmh")))
    return found.where(F.col("headway_min") <= headway.MAX_HEADWAY_MIN)


def motion_with_gaps(rows: DataFrame) -> DataFrame:
    """Every report with its speed, and its gap where the line report has one (left outer join)."""
    speeds = rows.select(F.col("c").alias("linha"), "sl", "p", "event_time", "event_id",
                         F.coalesce(motion.step_speed(), F.lit(0.0)).alias("speed_kmh"))
    return speeds.join(_gaps(rows), ["linha", "p", "event_time"], "left")
