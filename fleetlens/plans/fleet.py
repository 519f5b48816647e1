"""Current state of the fleet: active vehicles, latest positions, operating status and the line catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import display
from fleetlens.operators.latest import newest_rows
from fleetlens.plans.headway import gap_km, headway_minutes, other_vehicle, with_neighbour
from fleetlens.plans.motion import ORDER, step_speed

# Fixed values of the status rules.
CRAWL_KMH = 3.0
STOPPED_KMH = 2.0
CRAWL_HEADWAY_MIN = 9.72
ALONE_HEADWAY_MIN = 7.5
LATE_HEADWAY_MIN = 10.0


def active_vehicles(positions: DataFrame) -> DataFrame:
    """Distinct vehicles seen on every line. Spark first groups by (line, vehicle), so a hot line stays spread out."""
    return positions.groupBy(F.col("c").alias("linha")).agg(
        F.count_distinct("p").alias("total_onibus_ativos"), F.max("event_time").alias("ultima_atualizacao")
    )


def as_position_rows(positions: DataFrame) -> DataFrame:
    return positions.select(
        F.col("p").alias("prefixo"), F.col("c").alias("linha"), F.col("lt0").alias("letreiro_terminal"),
        F.col("lt1").alias("letreiro_origem"), F.col("py").alias("latitude"), F.col("px").alias("longitude"),
        F.col("a").alias("acessivel"), F.col("event_time").alias("ultima_atualizacao"), "event_id",
    )


def latest_position(positions: DataFrame) -> DataFrame:
    """The newest report of every vehicle."""
    return newest_rows(as_position_rows(positions), ["prefixo"], ["ultima_atualizacao", "event_id"]).drop("event_id")


def as_catalogue_rows(positions: DataFrame) -> DataFrame:
    named = positions.where(F.col("c").isNotNull() & F.col("lt1").isNotNull() & F.col("lt0").isNotNull())
    return named.select(
        F.col("c").alias("linha"), F.col("lt1").alias("letreiro_origem"), F.col("lt0").alias("letreiro_terminal"),
        F.concat("c", F.lit(" | "), "lt1", F.lit(" - "), "lt0").alias("linha_descricao"),
        F.col("event_time").alias("ultima_atualizacao"), "event_id",
    )


def line_catalogue(positions: DataFrame) -> DataFrame:
    """Newest signs of every line, with a description for pick lists."""
    return newest_rows(as_catalogue_rows(positions), ["linha"], ["ultima_atualizacao", "event_id"]).drop("event_id")


def assumed_headway(gap: Column, speed: Column) -> Column:
    """Headway for the status rule: a fixed value when crawling, another when no neighbour is known."""
    measured = F.when(speed >= CRAWL_KMH, headway_minutes(gap, speed)).otherwise(CRAWL_HEADWAY_MIN)
    return F.coalesce(measured, F.lit(ALONE_HEADWAY_MIN))


def operating_status(headway: Column, speed: Column) -> Column:
    return (
        F.when(speed <= STOPPED_KMH, display.STOPPED)
        .when(headway > LATE_HEADWAY_MIN, display.DELAYED)
        .otherwise(display.NORMAL)
    )


def as_status_rows(motion: DataFrame) -> DataFrame:
    """Status columns from rows with ``linha, sl, p, event_time, speed_kmh, gap_km``."""
    headway = assumed_headway(F.col("gap_km"), F.col("speed_kmh"))
    return motion.select(
        F.col("p").alias("prefixo"), "linha", display.direction_label(F.col("sl")).alias("sentido"),
        F.round("speed_kmh", 1).alias("velocidade_kmh"), F.round(headway, 2).alias("headway_minutos"),
        operating_status(headway, F.col("speed_kmh")).alias("status"),
        F.col("event_time").alias("ultima_atualizacao"),
    )


def vehicle_status(positions: DataFrame, splits: Sequence[float] | None = None) -> DataFrame:
    """Speed, headway and status of every vehicle at its newest report.

    Only the newest report of a vehicle counts, so after the line neighbour is known (one shuffle) every map task keeps
    just the two newest reports per vehicle: the one to show and the fix before it. Among reports of one vehicle at one
    time, those with a usable neighbour go last, so that a neighbour which any of them has is not lost.
    """
    rows = with_neighbour(positions, splits)
    rows = rows.withColumn("_gap_km", F.when(other_vehicle(), gap_km())).withColumn(
        "_has_gap", F.col("_gap_km").isNotNull()
    )
    order = ["event_time", "_has_gap", "event_id"]
    pair = newest_rows(rows, ["p"], order, rows=2)
    newest_first = Window.partitionBy("p").orderBy(*[F.col(c).desc() for c in order])
    previous = {"from_py": "py", "from_px": "px", "from_time": "event_time"}
    current = (
        pair.withColumns({new: F.lead(old).over(newest_first) for new, old in previous.items()})
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
    )
    return as_status_rows(
        current.select(
            F.col("c").alias("linha"), "sl", "p", "event_time", F.col("_gap_km").alias("gap_km"),
            F.coalesce(step_speed(), F.lit(0.0)).alias("speed_kmh"),
        )
    )
