"""Connected components of a graph given as edges, in Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.session import ensure_checkpoint_dir


def _to_least(edges: DataFrame, include_self: bool) -> DataFrame:
    """Each node's neighbours, joined to the least of them; with ``include_self`` the node counts as one of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    if include_self:
        least = least.withColumn("low", F.least("low", "u"))
    # Joined by the complement: both sides are shuffled for the join then, and Spark can split a hub's edges.
    return edges.withColumn("_key", F.bitwise_not("u")).join(least.select(F.bitwise_not("u").alias("_key"), "low"), "_key")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) for every node of ``edges`` (``u``, ``v``).

    Rounds of large-star (a node hands its larger neighbours to its least one) and small-star (it hands itself and its
    smaller neighbours to the least) until nothing changes; the number of rounds grows with the logarithm of the graph.
    Minima are aggregated before the shuffle, and each round is cut off by a checkpoint in the shared folder.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    current = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct().checkpoint()
    seen = None
    while True:
        state = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or not state["n"]:
            break
        seen = state
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, True).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        # Now v < u, and every smaller neighbour of u is one of its v.
        large = large.where("u <> v").distinct()
        small = _to_least(large, False)
        moved = small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        own = small.select("u", F.col("low").alias("v"))
        current = moved.union(own).distinct().select(F.col("v").alias("u"), F.col("u").alias("v")).checkpoint()
    pairs = current.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return pairs.union(current.select(F.col("u").alias("node"), F.col("u").alias("component"))).distinct()
