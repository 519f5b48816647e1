"""Vehicle speed between consecutive fixes, by line and over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.geo import haversine_km
from fleetlens.functions.timing import elapsed_seconds
from fleetlens.operators.lag import CHUNK, lag_over, order_splits

ORDER = ["event_time", "event_id"]

# Faster readings are noise; history is kept per minute.
MAX_SPEED_KMH = 120.0
HISTORY_WINDOW = "1 minute"


VEHICLE, LINE_WAY = ("p",), ("c", "sl")


def time_splits(positions: DataFrame, *keys: Sequence[str], rows_per_chunk: int | None = None) -> tuple[float, ...]:
    """Edges that keep every group of the given keys small enough for a task."""
    return order_splits(positions, "event_time", keys, rows_per_chunk)


def step_seconds() -> Column:
    return elapsed_seconds(F.col("from_time"), F.col("event_time"))


def step_km() -> Column:
    return haversine_km(F.col("from_py"), F.col("from_px"), F.col("py"), F.col("px"))


def step_speed() -> Column:
    """km/h since the previous fix; NULL without one or within the same second."""
    hours = step_seconds().cast("double") / 3600.0
    return step_km() / F.nullif(hours, F.lit(0.0))


def moved() -> Column:
    """The row has a usable previous fix at least a second old."""
    return (
        F.col("from_py").isNotNull() & F.col("from_px").isNotNull() & F.col("from_time").isNotNull()
        & (step_seconds() > 0)
    )


def with_previous_fix(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """Every report with the vehicle's previous coordinates and time. Keeps the ``_chunk`` helper column."""
    splits = time_splits(positions, VEHICLE) if splits is None else splits
    previous = {"from_py": "py", "from_px": "px", "from_time": "event_time"}
    return lag_over(positions, ["p"], ORDER, previous, splits)


def segments(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """Distance and whole seconds of every step a vehicle made."""
    return (
        with_previous_fix(positions, splits)
        .where(moved())
        .withColumns({"distance_km": step_km(), "seconds": step_seconds()})
        .drop(CHUNK)
    )


def speed_events(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """One row per step with its speed, noise included."""
    return (
        with_previous_fix(positions, splits)
        .where(moved())
        .select("event_id", F.col("c").alias("linha"), "p", "event_time", step_speed().alias("speed_kmh"))
    )


def plausible(speeds: DataFrame) -> DataFrame:
    return speeds.where(F.col("speed_kmh") <= MAX_SPEED_KMH)


def speed_summary() -> list[Column]:
    speed = F.col("speed_kmh")
    return [
        F.round(F.avg(speed), 2).alias("velocidade_media"),
        F.round(F.max(speed), 2).alias("velocidade_maxima"),
        F.round(F.min(speed), 2).alias("velocidade_minima"),
    ]


def per_minute(events: DataFrame, summary: list[Column]) -> DataFrame:
    """Summaries per line and one-minute tumbling window; works on batch and watermarked streams."""
    grouped = events.groupBy("linha", F.window("event_time", HISTORY_WINDOW).alias("_w")).agg(*summary)
    kept = [c for c in grouped.columns if c not in ("linha", "_w")]
    return grouped.select(
        "linha", F.col("_w.start").alias("janela_inicio"), F.col("_w.end").alias("janela_fim"), *kept
    )


def speed_by_line(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """Mean, highest and lowest plausible speed of every line and when it was last measured."""
    events = plausible(speed_events(positions, splits))
    return events.groupBy("linha").agg(*speed_summary(), F.max("event_time").alias("ultima_atualizacao"))


def speed_history(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """The same speeds per line and minute."""
    return per_minute(plausible(speed_events(positions, splits)), speed_summary())
