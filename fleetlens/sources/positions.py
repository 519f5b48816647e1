"""Position reports from Kafka or files, batch or streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.timing import from_local_text
from fleetlens.schemas import POSITIONS, REPORT, SHAPES, TRIPS, avro_schema

# Fixed values of the source contract.
TOPIC = "posicoes_sptrans"
TOPIC_PARTITIONS = 4
WATERMARK = "2 seconds"
POLL = "15 seconds"

# What a micro-batch may read after a standstill; both bound the rows any task can be given.
BATCH_LIMITS = {"kafka": {"maxOffsetsPerTrigger": "50000000"}, "files": {"maxFilesPerTrigger": "1000"}}

_FILE_FORMATS = ("parquet", "json", "csv", "orc")


def _decode(value: Column, encoding: str) -> Column:
    """Message body to a report struct. Registry-framed Avro carries a magic byte and a 4-byte schema id in front."""
    if encoding == "json":
        return F.from_json(value.cast("string"), REPORT)
    from pyspark.sql.avro.functions import from_avro

    body = F.substring(value, 6, 2**31 - 1) if encoding == "avro-registry" else value
    return from_avro(body, avro_schema())


def decode_messages(messages: DataFrame, encoding: str = "avro-registry") -> DataFrame:
    """Reports from Kafka records. Event time is the broker timestamp; partition and offset break ties."""
    tie = F.shiftleft(F.col("partition").cast("long"), 48) + F.col("offset")
    return messages.select(
        tie.alias("event_id"), _decode(F.col("value"), encoding).alias("r"), F.col("timestamp").alias("event_time")
    ).select("event_id", "r.*", "event_time")


def read_positions(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    streaming: bool = False,
    servers: str | None = None,
    encoding: str = "avro-registry",
    topic: str = TOPIC,
    **options: str,
) -> DataFrame:
    """Position reports with event time, from ``kafka`` (``servers``, ``topic``) or files of a declared schema (``path``)."""
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        start = "latest" if streaming else "earliest"
        limits = BATCH_LIMITS["kafka"] if streaming else {}
        settings = {
            "subscribe": topic, "startingOffsets": start, "kafka.bootstrap.servers": servers, **limits, **options
        }
        return decode_messages(reader.format("kafka").options(**settings).load(), encoding)
    if fmt not in _FILE_FORMATS:
        raise ValueError(f"unknown position format: {fmt!r}")
    limits = BATCH_LIMITS["files"] if streaming else {}
    return reader.format(fmt).schema(POSITIONS).options(**{**limits, **options}).load(path)


def with_gps_timestamp(positions: DataFrame) -> DataFrame:
    """Add ``ta_ts``, the local GPS time text as a timestamp."""
    return positions.withColumn("ta_ts", from_local_text(F.col("ta_tempo")))


def watermarked(positions: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return positions.withWatermark("event_time", delay)


def read_shapes(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return spark.read.format(fmt).schema(SHAPES).options(header="true", enforceSchema="false").load(path)


def read_trips(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return spark.read.format(fmt).schema(TRIPS).options(header="true", enforceSchema="false").load(path)
