"""Raw nested position payloads: ``{"l": [{line fields, "vs": [{vehicle fields}]}]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from fleetlens.functions.timing import epoch_millis, local_text, parse_iso
from fleetlens.operators.deadletter import UNKNOWN_KEY, split_valid
from fleetlens.schemas import FEED, FEED_LINE, FEED_VEHICLE, REPORT

LINE_FIELDS = [f for f in FEED_LINE.names if f != "vs"]


def _as_text(schema: StructType) -> StructType:
    return StructType([
        StructField(f.name, ArrayType(_as_text(f.dataType.elementType)) if isinstance(f.dataType, ArrayType) else StringType())
        for f in schema.fields
    ])


def _explode_feed(payloads: DataFrame, schema: StructType, keep: list[str]) -> DataFrame:
    """One row per vehicle with its line's fields repeated; empty or unreadable payloads and lines give none."""
    lines = payloads.select(*keep, F.explode(F.from_json("payload", schema)["l"]).alias("ln"))
    vehicles = lines.select(*keep, *[F.col(f"ln.{f}") for f in LINE_FIELDS], F.explode("ln.vs").alias("v"))
    return vehicles.select(*keep, *LINE_FIELDS, *[F.col(f"v.{f}") for f in FEED_VEHICLE.names])


def _gps() -> Column:
    return parse_iso(F.col("ta"))


def flatten_feed(payloads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed reports from payloads; ``keep`` names payload columns to carry along.

    The ISO time becomes epoch milliseconds and local text, both NULL where it cannot be read.
    """
    rows = _explode_feed(payloads, FEED, list(keep))
    return rows.withColumns({"ta": epoch_millis(_gps()), "ta_tempo": local_text(_gps())}).select(*keep, *REPORT.names)


# Bodies that say nothing: an empty answer of the feed.
_NOTHING = ("", "null", "false", "0", "{}", "[]", '""')
_CORRUPT = "_corrupt_record"


def _parsed() -> Column:
    schema = StructType([*_as_text(FEED).fields, StructField(_CORRUPT, StringType())])
    return F.from_json("payload", schema, {"columnNameOfCorruptRecord": _CORRUPT})


def checked_rows(payloads: DataFrame) -> DataFrame:
    """One row per vehicle with every field as text, and one ``unreadable`` row per payload that does not parse or whose
    lists are not lists, with the ``payload`` itself. Empty bodies and empty lists give no row.

    A time that cannot be read stays as it is, so that a dead letter shows it.
    """
    body = F.trim(F.coalesce(F.col("payload"), F.lit("")), F.lit(" \t\r\n"))
    parsed = payloads.select("payload", body.isin(*_NOTHING).alias("_nothing"), _parsed().alias("_feed")).where(~F.col("_nothing"))
    unreadable = F.col("_feed").isNull() | F.col(f"_feed.{_CORRUPT}").isNotNull()
    none = F.lit(None).cast(_as_text(FEED)["l"].dataType.elementType)
    no_vehicle = F.lit(None).cast(_as_text(FEED_VEHICLE))
    kept = parsed.withColumn("unreadable", unreadable)
    lines = kept.select("payload", "unreadable", F.explode(
        F.when(F.col("unreadable"), F.array(none)).otherwise(F.col("_feed.l"))).alias("ln"))
    vehicles = lines.select("payload", "unreadable", *[F.col(f"ln.{f}") for f in LINE_FIELDS], F.explode(
        F.when(F.col("unreadable"), F.array(no_vehicle)).otherwise(F.col("ln.vs"))).alias("v"))
    rows = vehicles.select("payload", "unreadable", *LINE_FIELDS, *[F.col(f"v.{f}") for f in FEED_VEHICLE.names])
    times = {"ta": F.coalesce(epoch_millis(_gps()).cast("string"), "ta"), "ta_tempo": local_text(_gps())}
    return rows.withColumns(times).select("payload", "unreadable", *REPORT.names)


def flatten_checked(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed reports and dead letters from payloads, every field read as text before it is coerced.

    A payload that cannot be read is a dead letter as it came, with key ``unknown``.
    """
    rows = checked_rows(payloads)
    good, dead = split_valid(rows.where(~F.col("unreadable")).select(*REPORT.names))
    return good, dead.unionByName(_unread(rows))


def _unread(rows: DataFrame) -> DataFrame:
    return rows.where("unreadable").select(F.lit(UNKNOWN_KEY).alias("key"), F.col("payload").alias("value"))


def dead_payloads(payloads: DataFrame) -> DataFrame:
    """Dead letters of the payloads that cannot be read."""
    return _unread(checked_rows(payloads))


def read_payload_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Payload files landed by a poller, one payload per file, as a stream."""
    return (
        spark.readStream.format("text").schema("value string").option("wholetext", "true")
        .option("maxFilesPerTrigger", files_per_batch).load(folder)
        .withColumnRenamed("value", "payload")
    )
