"""Keyed publishing of reports and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.operators.deadletter import UNKNOWN_KEY, keyed_json, rows_are_valid
from fleetlens.schemas import REPORT, avro_schema
from fleetlens.sources.feed import checked_rows
from fleetlens.sources.positions import POLL, TOPIC

# Fixed value: name of the dead-letter topic is configuration in the wire contract; this is its default.
DEAD_LETTER_TOPIC = "posicoes_sptrans_dlq"


def to_messages(reports: DataFrame, encoding: str = "json") -> DataFrame:
    """Key and value of every report; the key is the vehicle, so its reports share a partition."""
    if encoding == "json":
        return keyed_json(reports)
    from pyspark.sql.avro.functions import to_avro

    body = to_avro(F.struct(*REPORT.names), avro_schema())
    return reports.select(F.col("p").cast("string").alias("key"), body.alias("value"))


def tagged(reports: DataFrame, dead: DataFrame, encoding: str = "json") -> DataFrame:
    """Reports and dead letters as one frame of messages with their ``topic``."""
    good = to_messages(reports, encoding).withColumn("topic", F.lit(TOPIC))
    return good.unionByName(dead.withColumn("topic", F.lit(DEAD_LETTER_TOPIC)))


def publish(messages: DataFrame, servers: str) -> None:
    """Write a batch of messages, each to its ``topic``."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def land(messages: DataFrame, folder: str, partitions: int | None = None) -> None:
    """File twin of :func:`publish`: one folder of JSON files for each topic.

    Hashing on topic and key puts each vehicle's reports in one partition as the topic does. ``partitions`` is the number
    of tasks that write, by default the session's shuffle partitions; dead letters without a vehicle are spread.
    """
    spread = F.when(F.col("key") == UNKNOWN_KEY, F.xxhash64("value"))
    by = ["topic", "key", spread]
    placed = messages.repartition(partitions, *by) if partitions else messages.repartition(*by)
    placed.write.mode("append").partitionBy("topic").json(folder)


def start_ingest(payloads: DataFrame, checkpoint: str, folder: str | None = None, servers: str | None = None,
                 trigger: tuple[tuple[str, object], ...] = (("processingTime", POLL),)) -> StreamingQuery:
    """Payload stream to messages on the main and the dead-letter topic, in Kafka (``servers``) or files (``folder``).
    Every payload is read and checked once."""
    writer = feed_messages(payloads).writeStream.queryName("ingest").option("checkpointLocation", checkpoint)
    writer = writer.trigger(**dict(trigger))
    if servers:
        return writer.format("kafka").option("kafka.bootstrap.servers", servers).start()
    return writer.format("json").partitionBy("topic").option("path", folder).start()


def feed_messages(payloads: DataFrame) -> DataFrame:
    """``topic``, ``key`` and ``value`` of every report of a payload, and of every payload that cannot be read."""
    rows = checked_rows(payloads)
    good, key = rows_are_valid(), F.col("p").cast("string")
    typed = F.to_json(F.struct(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in REPORT.fields]))
    raw = F.to_json(F.struct(*REPORT.names), {"ignoreNullFields": "false"})
    unread = F.col("unreadable")
    return rows.select(
        F.when(~unread & good, TOPIC).otherwise(DEAD_LETTER_TOPIC).alias("topic"),
        F.when(~unread & good, key.try_cast("int").cast("string")).when(unread, UNKNOWN_KEY).otherwise(
            F.coalesce(key, F.lit(UNKNOWN_KEY))).alias("key"),
        F.when(unread, F.col("payload")).when(good, typed).otherwise(raw).alias("value"),
    )
