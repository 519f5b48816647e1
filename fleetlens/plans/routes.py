"""Vehicles on their routes: spacing, bunching and route length, with the display text of the control room."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import display
from fleetlens.functions.timing import clock
from fleetlens.operators import spatial
from fleetlens.operators.lag import lag_over, order_splits
from fleetlens.operators.nearest import nearest_point
from fleetlens.session import ensure_checkpoint_dir

# Fixed value: half side of the search box, in degrees.
SEARCH_DEGREES = 0.01


def place_on_shapes(latest: DataFrame, shapes: DataFrame) -> DataFrame:
    """Latest positions with the travelled distance of the nearest shape point, NULL when none is near."""
    placed = nearest_point(
        latest, shapes, ["latitude", "longitude"], ["shape_pt_lat", "shape_pt_lon"], "shape_dist_traveled",
        SEARCH_DEGREES,
    )
    return placed.withColumnRenamed("shape_dist_traveled", "dist_percorrida_metros")


def place_on_index(latest: DataFrame, index: spatial.Index) -> DataFrame:
    """The same from a stored index of the shapes."""
    return spatial.nearest_point(latest, index, ["latitude", "longitude"], "dist_percorrida_metros")


def route_spacing(
    latest: DataFrame, shapes: DataFrame | spatial.Index, rows_per_chunk: int | None = None
) -> DataFrame:
    """Gap of every vehicle to the next one behind it along the line, with a diagnosis.

    Places are written once, one row per vehicle, and counted by line to see whether one could outgrow a task. Vehicles
    that are not near a shape have no distance, sort after all others and get no gap, so they are left out before the LAG.
    """
    place = place_on_index if isinstance(shapes, spatial.Index) else place_on_shapes
    placed = place(latest.select("prefixo", "linha", "latitude", "longitude"), shapes)
    placed = placed.where(F.col("dist_percorrida_metros").isNotNull())
    ensure_checkpoint_dir(latest.sparkSession)
    placed = placed.checkpoint()
    splits = order_splits(placed, "dist_percorrida_metros", [["linha"]], rows_per_chunk)
    behind = {"onibus_a_frente": "prefixo", "_behind_m": "dist_percorrida_metros"}
    rows = lag_over(placed, ["linha"], ["dist_percorrida_metros", "prefixo"], behind, splits)
    gap = display.fixed((F.col("dist_percorrida_metros") - F.col("_behind_m")) / 1000.0, 2)
    return (
        rows.withColumn("_gap", gap)
        .where(F.col("_gap").isNotNull())
        .select(
            "linha", F.col("prefixo").alias("onibus"), "onibus_a_frente",
            display.decimal_comma(F.col("dist_percorrida_metros"), 1).alias("km_acumulado_rota"),
            F.translate(F.col("_gap").cast("string"), ".", ",").alias("dist_entre_onibus_km"),
            display.spacing_diagnosis(F.col("_gap")).alias("diagnostico_operacional"),
            "dist_percorrida_metros",
        )
        .orderBy("linha", "dist_percorrida_metros", "onibus")
        .drop("dist_percorrida_metros")
    )


def distinct_trips(trips: DataFrame, lines: Sequence[str] | None = None) -> DataFrame:
    chosen = trips if lines is None else trips.where(F.col("route_id").isin(*lines))
    return chosen.select("route_id", "shape_id", "direction_id").distinct()


def route_extent(shapes: DataFrame, trips: DataFrame, lines: Sequence[str] | None = None) -> DataFrame:
    """Longest shape of every line and direction in km. Shapes shrink to one row each before they are joined."""
    length = shapes.groupBy("shape_id").agg(F.max("shape_dist_traveled").alias("metres"))
    return (
        length.join(distinct_trips(trips, lines), "shape_id")
        .groupBy(F.col("route_id").alias("linha"), "direction_id")
        .agg((F.max("metres") / 1000.0).alias("dist_km"))
    )


def route_length(shapes: DataFrame, trips: DataFrame, lines: Sequence[str] | None = None) -> DataFrame:
    """Outbound, inbound and total length of every line as display text."""
    km = F.col("dist_km")

    def one_way(direction: int):
        return F.coalesce(F.max(F.when(F.col("direction_id") == direction, km)), F.lit(0.0))

    def text(value):
        return F.concat(display.decimal_comma(value, 2), F.lit(" km"))

    return (
        route_extent(shapes, trips, lines)
        .groupBy("linha")
        .agg(
            text(one_way(0)).alias("extensao_ida"),
            text(one_way(1)).alias("extensao_volta"),
            text(F.sum(km)).alias("extensao_total_ida_e_volta"),
        )
        .orderBy("linha")
    )


def operations_panel(status: DataFrame, line: str | None = None) -> DataFrame:
    """Vehicles in operation, formatted for display."""
    rows = status if line is None else status.where(F.col("linha") == line)
    return rows.orderBy("sentido", "prefixo").select(
        "prefixo", "sentido",
        F.concat(display.fixed(F.col("velocidade_kmh"), 1).cast("string"), F.lit(" km/h")).alias("velocidade"),
        F.concat(display.minute_clock(F.col("headway_minutos")), F.lit(" min")).alias("headway"),
        display.status_badge(F.col("status")).alias("status"),
        clock(F.col("ultima_atualizacao")).alias("ultima_posicao"),
    )


def line_filter_options(catalogue: DataFrame) -> DataFrame:
    """Pick-list values and texts, ordered by line."""
    return catalogue.orderBy("linha").select(F.col("linha").alias("__value"), F.col("linha_descricao").alias("__text"))


def rows_of_line(table: DataFrame, line: str) -> DataFrame:
    """One line's rows of any result table."""
    return table.where(F.col("linha") == line)


def history_of_line(history: DataFrame, line: str) -> DataFrame:
    """One line's history, newest window first."""
    return rows_of_line(history, line).orderBy(F.col("janela_fim").desc())


def positions_sample(latest: DataFrame, line: str, rows: int = 10) -> DataFrame:
    """A few of a line's vehicles; ordered by vehicle so that the choice is stable."""
    return rows_of_line(latest, line).orderBy("prefixo").limit(rows)
