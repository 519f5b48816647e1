"""Stored log lines with an index of their label sets.

The distinct label sets stand in a small table with a fingerprint each. Lines carry the fingerprint only and are laid out by
day and by bucket of fingerprints, in files sorted by fingerprint and time. Matchers, regular expressions too, run on the few
label sets; the join reaches the lines through their bucket, which Spark prunes while the query runs (dynamic partition
pruning). Days are pruned beforehand, and hours inside a day by the files' statistics; folders by the hour would be many
thousands a year.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.logmetrics import condition

BUCKETS = 16
LABELS = ("container", "stream")
LINE = "fingerprint long, ts timestamp, line string, day date, bucket int"
LABEL_SET = "fingerprint long, container string, stream string"


def fingerprinted(logs: DataFrame) -> DataFrame:
    """A missing label and an empty one have fingerprints of their own."""
    return logs.withColumn("fingerprint", F.xxhash64(*[part for label in LABELS for part in (F.col(label), F.col(label).isNull())]))


def append_logs(logs: DataFrame, path: str) -> None:
    """Add lines, and those of their label sets that are not known yet. Sets come first, so that no line is without one."""
    spark = logs.sparkSession
    rows = fingerprinted(logs)
    sets = rows.select("fingerprint", *LABELS).distinct()
    known = label_sets(spark, path)
    if known is not None:
        sets = sets.join(known.select("fingerprint"), "fingerprint", "left_anti")
    sets.coalesce(1).write.mode("append").parquet(f"{path}/labels")
    lines = rows.select("fingerprint", "ts", "line").withColumns(
        {"day": F.to_date("ts"), "bucket": F.pmod("fingerprint", F.lit(BUCKETS)).cast("int")})
    lines.hint("rebalance", "day", "bucket").sortWithinPartitions("day", "bucket", "fingerprint", "ts").write.mode("append").partitionBy(
        "day", "bucket").parquet(f"{path}/lines")


def label_sets(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/labels")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(LABEL_SET).parquet(f"{path}/labels").distinct()


def read_logs(
    spark: SparkSession, path: str, equal: Mapping[str, str] | None = None, matching: Mapping[str, str] | None = None,
    line_regex: str | None = None, since: str | None = None, until: str | None = None,
) -> DataFrame:
    """``ts``, labels and ``line`` of the lines whose labels match, from ``since`` on and before ``until``."""
    lines = spark.read.schema(LINE).parquet(f"{path}/lines")
    if since is not None:
        first = F.lit(since).cast("timestamp")
        lines = lines.where((F.col("ts") >= first) & (F.col("day") >= F.to_date(first)))
    if until is not None:
        last = F.lit(until).cast("timestamp")
        lines = lines.where((F.col("ts") < last) & (F.col("day") <= F.to_date(last)))
    wanted = spark.read.schema(LABEL_SET).parquet(f"{path}/labels").where(condition(equal, matching)).distinct()
    wanted = wanted.withColumn("bucket", F.pmod("fingerprint", F.lit(BUCKETS)).cast("int"))
    found = lines.join(wanted, ["bucket", "fingerprint"])
    if line_regex is not None:
        found = found.where(F.col("line").rlike(line_regex))
    return found.select("ts", *LABELS, "line")
