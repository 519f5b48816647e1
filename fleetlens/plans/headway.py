"""Minutes between a vehicle and the previous report on its line and direction.

A headway needs two facts about one (line, vehicle, time): the vehicle's speed since its own last fix, and its distance
to the previous report on the line. Written as a join of the stream with itself that means two scans and four shuffles.
Here both facts are put on the same row instead. Within a (vehicle, time) only the first report can have a speed, because
the ones after it follow at zero seconds, so carrying that speed to all reports of the group gives exactly the join's
rows, also when a vehicle reports twice at one time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.geo import haversine_km
from fleetlens.operators.lag import CHUNK, lag_over
from fleetlens.plans.motion import (
    LINE_WAY,
    MAX_SPEED_KMH,
    ORDER,
    VEHICLE,
    moved,
    per_minute,
    step_speed,
    time_splits,
    with_previous_fix,
)

# Slower vehicles, nearer neighbours and longer headways are not counted.
MIN_SPEED_KMH = 5.0
MIN_GAP_KM = 0.05
MAX_HEADWAY_MIN = 120.0

NEIGHBOUR = {"near_py": "py", "near_px": "px", "near_p": "p"}


def with_neighbour(
    positions: DataFrame, splits: Sequence[float] | None = None, tail_source: DataFrame | None = None
) -> DataFrame:
    """Every report with the previous report on the same line and direction, whoever sent it."""
    if splits is None:
        splits = time_splits(positions if tail_source is None else tail_source, LINE_WAY)
    return lag_over(positions, ["c", "sl"], ORDER, NEIGHBOUR, splits, tail_source)


def gap_km() -> Column:
    return haversine_km(F.col("near_py"), F.col("near_px"), F.col("py"), F.col("px"))


def other_vehicle() -> Column:
    return F.col("near_py").isNotNull() & (F.col("p") != F.col("near_p"))


def line_gaps(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """Distance of every report to the previous one on its line, where another vehicle sent that."""
    return (
        with_neighbour(positions, splits)
        .where(other_vehicle() & F.col("near_px").isNotNull())
        .select("event_id", F.col("c").alias("linha"), "sl", "p", "event_time", gap_km().alias("gap_km"))
    )


def _with_group_speed(positions: DataFrame, splits: Sequence[float]) -> DataFrame:
    """Attach the one speed of a (vehicle, time) to all its reports on the same line."""
    rows = with_previous_fix(positions, splits)
    same_time = Window.partitionBy("p", CHUNK, "event_time").orderBy("event_id")
    first = F.first(F.struct("c", F.when(moved(), step_speed()).alias("speed"))).over(same_time)
    return (
        rows.withColumn("_first", first)
        .withColumn("speed_kmh", F.when(F.col("_first.c") == F.col("c"), F.col("_first.speed")))
        .select("event_id", "c", "sl", "p", "py", "px", "event_time", "speed_kmh")
    )


def headway_minutes(gap: Column, speed: Column) -> Column:
    return gap / F.nullif(speed, F.lit(0.0)) * 60.0


def headway_events(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """One row per report with a plausible speed and a neighbour: gap, speed and headway in minutes."""
    splits = time_splits(positions, VEHICLE, LINE_WAY) if splits is None else splits
    rows = lag_over(_with_group_speed(positions, splits), ["c", "sl"], ORDER, NEIGHBOUR, splits, tail_source=positions)
    return (
        rows.where(
            F.col("speed_kmh").between(MIN_SPEED_KMH, MAX_SPEED_KMH) & other_vehicle() & F.col("near_px").isNotNull()
        )
        .select("event_id", F.col("c").alias("linha"), "p", "event_time", "speed_kmh", gap_km().alias("gap_km"))
        .where(F.col("gap_km") > MIN_GAP_KM)
        .withColumn("headway_min", headway_minutes(F.col("gap_km"), F.col("speed_kmh")))
        .where(F.col("headway_min") <= MAX_HEADWAY_MIN)
    )


def headway_summary() -> list[Column]:
    headway = F.col("headway_min")
    return [
        F.round(F.avg(headway), 2).alias("headway_medio"),
        F.round(F.min(headway), 2).alias("headway_minimo"),
        F.round(F.max(headway), 2).alias("headway_maximo"),
    ]


def headway_by_line(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """Mean, lowest and highest headway of every line and when it was last measured."""
    events = headway_events(positions, splits)
    return events.groupBy("linha").agg(*headway_summary(), F.max("event_time").alias("ultima_atualizacao"))


def headway_history(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """The same headways per line and minute."""
    return per_minute(headway_events(positions, splits), headway_summary())


def motion_with_gaps(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """Every report's speed, 0 when unknown, with the gap of the matching line report where there is one.

    This is the outer join on (line, vehicle, time) in full: reports that share all three pair up.
    """
    splits = time_splits(positions, VEHICLE, LINE_WAY) if splits is None else splits
    speed = with_previous_fix(positions, splits).select(
        "event_id", F.col("c").alias("linha"), "sl", "p", "event_time",
        F.coalesce(step_speed(), F.lit(0.0)).alias("speed_kmh"),
    )
    gaps = with_neighbour(positions, splits).where(other_vehicle()).select(
        F.col("event_id").alias("gap_event_id"), F.col("c").alias("linha"), "p", "event_time", gap_km().alias("gap_km")
    )
    return speed.join(gaps, ["linha", "p", "event_time"], "left")
