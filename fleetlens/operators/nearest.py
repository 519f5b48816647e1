"""Nearest reference point inside a box, without pairing every row with every point around it.

Coordinates are binned into nested square cells whose side shrinks from the box radius by ``FAN`` per level. Each level
keeps one row per occupied cell with the tight bounds of its points. A location starts in the 3x3 coarsest cells around
it and goes down level by level: bounds give the closest and the farthest any point of a cell can be, and cells whose
closest point is farther than some other cell's farthest point are dropped. Only the points of the few surviving finest
cells are compared one by one. Candidates per location are bounded by cells, not by points, so crowded spots cost no more
than quiet ones, and since a cell is dropped only when it cannot hold the answer the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.geo import squared_degrees
from fleetlens.session import ensure_checkpoint_dir

FAN_BITS = 3
FAN = 1 << FAN_BITS
# A finest cell should hold about this many points even if all of them lay in one box.
POINTS_PER_CELL = 16


def levels_for(points: int) -> int:
    """Levels that split a box of 2x2 coarsest cells finely enough for ``points``."""
    cells = max(points / POINTS_PER_CELL / 4, 1.0)
    return max(1, math.ceil(math.log(cells, FAN * FAN)))


def _cell(coordinate: Column, finest: float) -> Column:
    return F.floor(coordinate / F.lit(finest)).cast("long")


def _parent(cell: Column) -> Column:
    """Enclosing cell one level up; the arithmetic shift rounds down for negative cells too."""
    return F.shiftright(cell, FAN_BITS)


def _cell_bounds(points: DataFrame, levels: int) -> list[DataFrame]:
    """Occupied cells with tight bounds, from the level below the coarsest down to the finest. The finest are aggregated
    from the points and written; each level comes from the one below it."""
    finest = points.groupBy("ci", "cj").agg(
        F.min("plat").alias("lat0"), F.max("plat").alias("lat1"), F.min("plon").alias("lon0"), F.max("plon").alias("lon1")
    ).checkpoint()
    stack = [finest]
    for _ in range(levels - 1):
        stack.append(
            stack[-1]
            .groupBy(_parent(F.col("ci")).alias("ci"), _parent(F.col("cj")).alias("cj"))
            .agg(F.min("lat0").alias("lat0"), F.max("lat1").alias("lat1"),
                 F.min("lon0").alias("lon0"), F.max("lon1").alias("lon1"))
        )
    return stack[::-1]


def nearest_point(
    left: DataFrame,
    points: DataFrame,
    left_at: Sequence[str],
    point_at: Sequence[str],
    value: str,
    radius: float,
    levels: int | None = None,
) -> DataFrame:
    """Add ``value`` of the nearest point within +-``radius`` degrees of every left row, NULL when there is none.

    Of several points at the same distance the smallest ``value`` is taken. ``levels`` changes the work, never the
    result; by default it follows from the number of points, which Parquet answers from its footers.
    """
    levels = levels_for(points.count()) if levels is None else levels
    finest = finest_cell(radius, levels)
    located = points.select(
        F.col(point_at[0]).alias("plat"), F.col(point_at[1]).alias("plon"), F.col(value).alias("_value")
    ).where(F.col("plat").isNotNull() & F.col("plon").isNotNull())
    located = located.withColumns({"ci": _cell(F.col("plat"), finest), "cj": _cell(F.col("plon"), finest)})
    # Written once: the points are scanned here and counted above, whatever the number of levels.
    ensure_checkpoint_dir(points.sparkSession)
    distinct_points = located.groupBy("ci", "cj", "plat", "plon").agg(F.min("_value").alias("_value")).checkpoint()
    candidates = coarse_blocks(distinct_spots(left, left_at), finest, levels)
    return search(left, left_at, value, candidates, _cell_bounds(distinct_points, levels), distinct_points, radius)


def finest_cell(radius: float, levels: int) -> float:
    """Side of the finest cells. Slightly wider than the radius asks for, so rounding at a box edge cannot push a point out
    of the 3x3 coarsest cells."""
    return radius * 1.0001 / FAN**levels


def distinct_spots(left: DataFrame, left_at: Sequence[str]) -> DataFrame:
    lat, lon = left_at
    return (
        left.select(F.col(lat).alias("slat"), F.col(lon).alias("slon"))
        .where(F.col("slat").isNotNull() & F.col("slon").isNotNull())
        .distinct()
    )


def coarse_blocks(spots: DataFrame, finest: float, levels: int) -> DataFrame:
    """Every location with the 3x3 coarsest cells (``pi``, ``pj``) around it."""
    def block(coordinate: str) -> Column:
        home = F.shiftright(_cell(F.col(coordinate), finest), FAN_BITS * levels)
        return F.explode(F.sequence(home - 1, home + 1))

    return spots.withColumn("pi", block("slat")).withColumn("pj", block("slon"))


def search(
    left: DataFrame, left_at: Sequence[str], value: str, candidates: DataFrame, pyramid: Sequence[DataFrame], points: DataFrame,
    radius: float,
) -> DataFrame:
    """Go down the ``pyramid`` (bounds of occupied cells, from the coarser level to the finest) from the ``candidates`` of
    every location, and compare the points of the cells that are left."""
    lat, lon = left_at
    slat, slon = F.col("slat"), F.col("slon")
    box = (slat - radius, slat + radius, slon - radius, slon + radius)
    per_spot = Window.partitionBy("slat", "slon")
    for cells in pyramid:
        children = cells.withColumns({"pi": _parent(F.col("ci")), "pj": _parent(F.col("cj"))})
        touches = (
            (F.col("lat1") >= box[0]) & (F.col("lat0") <= box[1]) & (F.col("lon1") >= box[2]) & (F.col("lon0") <= box[3])
        )
        inside = (
            (F.col("lat0") >= box[0]) & (F.col("lat1") <= box[1]) & (F.col("lon0") >= box[2]) & (F.col("lon1") <= box[3])
        )
        zero = F.lit(0.0)
        near_lat = F.greatest(F.col("lat0") - slat, slat - F.col("lat1"), zero)
        near_lon = F.greatest(F.col("lon0") - slon, slon - F.col("lon1"), zero)
        far_lat = F.greatest(F.abs(F.col("lat0") - slat), F.abs(F.col("lat1") - slat))
        far_lon = F.greatest(F.abs(F.col("lon0") - slon), F.abs(F.col("lon1") - slon))
        candidates = (
            candidates.join(children, ["pi", "pj"])
            .where(touches)
            .withColumn("_closest", near_lat * near_lat + near_lon * near_lon)
            .withColumn("_reach", F.min(F.when(inside, far_lat * far_lat + far_lon * far_lon)).over(per_spot))
            .where(F.col("_reach").isNull() | (F.col("_closest") <= F.col("_reach")))
            .select("slat", "slon", F.col("ci").alias("pi"), F.col("cj").alias("pj"))
        )

    matched = (
        candidates.withColumnsRenamed({"pi": "ci", "pj": "cj"})
        .join(points, ["ci", "cj"])
        .where(F.col("plat").between(box[0], box[1]) & F.col("plon").between(box[2], box[3]))
    )
    best = matched.groupBy("slat", "slon").agg(
        F.min(F.struct(squared_degrees(slat, slon, F.col("plat"), F.col("plon")).alias("d2"), "_value")).alias("_best")
    )
    best = best.select(slat.alias(lat), slon.alias(lon), F.col("_best._value").alias(value))
    return left.join(best, [lat, lon], "left").select(*left.columns, value)
