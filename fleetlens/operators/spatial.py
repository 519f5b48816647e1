"""A stored index of reference points: clustered files and the cell pyramid beside them.

Points are written once, by tile (a block of coarse cells, the partition column) and inside a tile along a Z-order key of
their finest cells, so files and row groups hold neighbours. The pyramid of every tile, the bounds of its occupied cells on
all levels, stands in a second table with the same partitions. A search (``nearest.search``) reads the tiles around its
locations and aggregates nothing. ``refresh`` rewrites the tiles that changed owners (shapes) touch, before and after; it
may be repeated after a failure.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators import nearest
from fleetlens.operators.nearest import FAN_BITS
from fleetlens.session import ensure_checkpoint_dir

# A tile is this many bits of coarsest cells wide.
TILE_BITS = 4
# Beyond so many tiles a search leaves the choice of files to its joins.
MOST_TILES = 1000
POINT = "owner string, ci long, cj long, plat double, plon double, _value double, tile long"
CELL = "level int, ci long, cj long, lat0 double, lat1 double, lon0 double, lon1 double, tile long"


class Index(NamedTuple):
    path: str
    radius: float
    levels: int

    @property
    def finest(self) -> float:
        return nearest.finest_cell(self.radius, self.levels)


def _tile(ci: Column, cj: Column, bits: int) -> Column:
    """One number for the tile that encloses a cell ``bits`` below it."""
    return F.shiftleft(F.shiftright(ci, bits), 32) + F.shiftright(cj, bits)


def _spread(x: Column) -> Column:
    """The low 16 bits of a number, each followed by a zero."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = (x.bitwiseOR(F.shiftleft(x, shift))).bitwiseAND(F.lit(mask).cast("long"))
    return x


def curve_key(ci: Column, cj: Column, bits: int) -> Column:
    """Place of a cell on the Z-order curve through its tile."""
    low = F.lit((1 << min(bits, 16)) - 1).cast("long")
    return F.shiftleft(_spread(ci.bitwiseAND(low)), 1).bitwiseOR(_spread(cj.bitwiseAND(low)))


def _located(points: DataFrame, at: Sequence[str], value: str, owner: str, index: Index) -> DataFrame:
    bits = TILE_BITS + FAN_BITS * index.levels
    rows = points.select(F.col(owner).cast("string").alias("owner"), F.col(at[0]).alias("plat"), F.col(at[1]).alias("plon"),
                         F.col(value).cast("double").alias("_value")).where(F.col("plat").isNotNull() & F.col("plon").isNotNull())
    rows = rows.withColumns({"ci": nearest._cell(F.col("plat"), index.finest), "cj": nearest._cell(F.col("plon"), index.finest)})
    rows = rows.groupBy("owner", "ci", "cj", "plat", "plon").agg(F.min("_value").alias("_value"))
    return rows.withColumn("tile", _tile(F.col("ci"), F.col("cj"), bits))


def _write(points: DataFrame, index: Index) -> None:
    """Write whole tiles of points, and the pyramids of these tiles from what was written."""
    bits = TILE_BITS + FAN_BITS * index.levels
    key = curve_key(F.col("ci"), F.col("cj"), bits)
    clustered = points.withColumn("_key", key).repartitionByRange("tile", "_key").sortWithinPartitions("tile", "_key").drop("_key")

    def put(table: DataFrame, name: str) -> None:
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile").parquet(f"{index.path}/{name}")

    put(clustered, "points")
    bounds = [F.min("lat0").alias("lat0"), F.max("lat1").alias("lat1"), F.min("lon0").alias("lon0"), F.max("lon1").alias("lon1")]
    finest = points.select("tile", "ci", "cj", F.col("plat").alias("lat0"), F.col("plat").alias("lat1"),
                           F.col("plon").alias("lon0"), F.col("plon").alias("lon1")).groupBy("tile", "ci", "cj").agg(*bounds)
    # Each occupied cell with its enclosing cells; a level is as many steps above the finest.
    stack = [F.struct(F.lit(index.levels - k).alias("level"), F.shiftright("ci", FAN_BITS * k).alias("ci"),
                      F.shiftright("cj", FAN_BITS * k).alias("cj")) for k in range(index.levels)]
    cells = finest.select("tile", F.explode(F.array(*stack)).alias("cell"), "lat0", "lat1", "lon0", "lon1").groupBy(
        "tile", "cell").agg(*bounds).select("cell.*", "lat0", "lat1", "lon0", "lon1", "tile")
    put(cells.repartition("tile").sortWithinPartitions("tile", "level", "ci", "cj"), "cells")


def build(points: DataFrame, at: Sequence[str], value: str, owner: str, radius: float, path: str, levels: int | None = None) -> Index:
    """Write the index of ``points`` under ``path``. Of points of one owner at one place the least ``value`` is kept."""
    index = Index(path, radius, nearest.levels_for(points.count()) if levels is None else levels)
    _write(_located(points, at, value, owner, index), index)
    points.sparkSession.createDataFrame([(radius, index.levels)], "radius double, levels int").write.mode("overwrite").parquet(f"{path}/meta")
    return index


def opened(spark: SparkSession, path: str) -> Index | None:
    """The index under ``path``, if a whole one is there: its ``meta`` is written last."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/meta/_SUCCESS")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return Index(path, *spark.read.parquet(f"{path}/meta").first())


def _points(spark: SparkSession, index: Index) -> DataFrame:
    return spark.read.schema(POINT).parquet(f"{index.path}/points")


def refresh(index: Index, changed: DataFrame, owners: DataFrame, at: Sequence[str], value: str, owner: str) -> None:
    """Put the points of ``changed`` in place of all that the index has of ``owners`` (a column ``owner``); other tiles than
    those that either touches are not written. Owners without points in ``changed`` go."""
    spark = changed.sparkSession
    ensure_checkpoint_dir(spark)
    gone = owners.select(F.col("owner").cast("string").alias("owner")).distinct()
    new = _located(changed, at, value, owner, index)
    old = _points(spark, index)
    tiles = old.select("owner", "tile").join(gone, "owner", "left_semi").select("tile").union(new.select("tile")).distinct()
    touched = sorted(r[0] for r in tiles.collect())
    if not touched:
        return
    kept = old.where(F.col("tile").isin(*touched)).join(gone, "owner", "left_anti")
    # Read in full before the tiles are overwritten.
    whole = kept.select(*new.columns).unionByName(new).checkpoint()
    filled = {r[0] for r in whole.select("tile").distinct().collect()}
    _write(whole, index)
    for tile in set(touched) - filled:
        for name in ("points", "cells"):
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{index.path}/{name}/tile={tile}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def nearest_point(left: DataFrame, index: Index, left_at: Sequence[str], value: str) -> DataFrame:
    """As ``nearest.nearest_point`` over the stored points."""
    spark = left.sparkSession
    spots = nearest.distinct_spots(left, left_at)
    candidates = nearest.coarse_blocks(spots, index.finest, index.levels)
    tile = _tile(F.col("pi"), F.col("pj"), TILE_BITS)
    tiles = [r[0] for r in candidates.select(tile.alias("tile")).distinct().limit(MOST_TILES + 1).collect()]

    def near(table: DataFrame) -> DataFrame:
        return table if len(tiles) > MOST_TILES else table.where(F.col("tile").isin(*sorted(tiles)))

    cells = near(spark.read.schema(CELL).parquet(f"{index.path}/cells"))
    pyramid = [cells.where(F.col("level") == level).drop("level", "tile") for level in range(1, index.levels + 1)]
    points = near(_points(spark, index)).select("ci", "cj", "plat", "plon", "_value")
    return nearest.search(left, left_at, value, candidates, pyramid, points, index.radius)
