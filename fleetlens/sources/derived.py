"""Telemetry views derived from the generic test tables (``events``, ``orders``, ``customer``).

The tables hold no bus reports, so positions, route geometry, trips, logs and raw feed payloads are computed from them
row by row. Every view covers its whole base table. ``fleetlens.oracle`` states the same views for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns the views read. They are declared so that no job is needed to infer them.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint",
    "nation": "n_name string",
}

FILES_PER_BATCH = 200
REPORTS_PER_PAYLOAD = 256


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


# Event time is squeezed 60 times towards 2024-01-01 so that speeds take realistic values.
_POSITIONS = {
    "event_id": "event_id",
    "c": "concat('L', lpad(cast(user_id % 10 AS string), 2, '0'), '-10')",
    "cl": "cast(user_id % 10 AS int)",
    "sl": "cast(1 + event_id % 2 AS int)",
    "lt0": "concat('TERM ', cast(user_id % 10 AS string))",
    "lt1": "concat('ORIG ', cast(user_id % 10 AS string))",
    "qv": "15",
    "p": "cast(user_id AS int)",
    "a": "user_id % 3 = 0",
    "ta": "unix_millis(gps)",
    "ta_tempo": "date_format(from_utc_timestamp(gps, '-03:00'), 'yyyy-MM-dd HH:mm:ss')",
    "py": "-23.55D + 0.0001D * (cast(floor(value * 100) AS bigint) % 400)",
    "px": "-46.63D + 0.0001D * (event_id * 37 % 400)",
    "event_time": "event_time",
}
_EVENT_TIME = (
    "timestamp_micros(1704067200000000 + "
    "cast(floor((unix_micros(cast(ts AS timestamp)) - 1704067200000000) / 60) AS bigint))"
)
_GPS = "timestamp_seconds(unix_seconds(event_time) - event_id % 12)"

_SHAPES = {
    "shape_id": "concat('S', cast(o_orderkey % 20 AS string))",
    "shape_pt_lat": "-23.55D + 0.00001D * (o_orderkey * 7 % 4000)",
    "shape_pt_lon": "-46.63D + 0.00001D * (o_custkey * 13 % 4000)",
    "shape_dist_traveled": "cast(o_orderkey % 2000 AS double) * 100",
}

_TRIPS = {
    "route_id": "concat('L', lpad(cast(c_custkey % 10 AS string), 2, '0'), '-10')",
    "shape_id": "concat('S', cast(c_custkey % 20 AS string))",
    "direction_id": "cast(c_custkey div 10 AS int) % 2",
}

_LOGS = {
    "ts": "cast(ts AS timestamp)",
    "container": """CASE event_type WHEN 'view' THEN 'kafka' WHEN 'click' THEN 'flink-taskmanager'
        WHEN 'error' THEN 'flink-jobmanager' WHEN 'signup' THEN 'schema-registry' ELSE 'python-producer' END""",
    "stream": "if(event_id % 5 = 0, 'stderr', 'stdout')",
    "line": """CASE
        WHEN event_type = 'error' AND event_id % 3 = 0
            THEN concat('Checkpoint ', event_id, ' completed in ', cast(floor(value * 10) AS bigint), ' ms')
        WHEN event_type = 'error' AND event_id % 3 = 1 THEN concat('JobFailedException job=', event_id)
        WHEN event_type = 'error' THEN concat('Sink: sink_', elt(cast(event_id % 4 AS int) + 1, 'speed', 'headway', 'status', 'latest_pos'))
        WHEN event_type = 'signup' AND event_id % 17 = 0 THEN concat('DeserializationException for id ', event_id)
        WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'HTTP GET /schemas/ids/1'
        WHEN event_type = 'signup' THEN 'HTTP POST Registering new schema'
        WHEN event_type = 'view' AND event_id % 7 = 0 THEN concat('INFO connection accepted from client ', event_id)
        WHEN event_type = 'view' THEN concat('partition ', event_id % 4, ' replica isr ok posicoes')
        WHEN event_type = 'purchase' THEN concat('mensagem enviada offset=', event_id)
        WHEN event_id % 11 = 0 THEN concat('java.lang.OutOfMemoryError in task ', event_id)
        ELSE concat('task heartbeat ', event_id) END""",
}


def _view(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def positions_from_events(events: DataFrame) -> DataFrame:
    """Position reports from event rows, batch or streaming."""
    timed = events.selectExpr("event_id", "user_id", "value", f"{_EVENT_TIME} AS event_time")
    return _view(timed.selectExpr("*", f"{_GPS} AS gps"), _POSITIONS)


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions_from_events(_table(spark, sf_dir, "events"))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream, a bounded number of files at a time. The pattern fits one file as well as a folder of files."""
    reader = spark.readStream.schema(TABLES["events"]).option("maxFilesPerTrigger", FILES_PER_BATCH)
    return reader.parquet(f"{sf_dir}/events.parquet*")


def position_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reports as a stream."""
    return positions_from_events(_event_stream(spark, sf_dir))


# A source of four partitions: reports of the third lag, those of the first stop half way, the second is silent for hours
# and then sends what it held back.
_ARRIVALS = {
    "source_partition": "cast(event_id % 4 AS int)",
    "event_time": "event_time",
    "arrived": """CASE WHEN event_id % 4 = 3 THEN event_time + INTERVAL 20 MINUTES
        WHEN event_id % 4 = 2 AND event_time >= timestamp'2024-01-01 02:00:00' AND event_time < timestamp'2024-01-01 04:00:00'
            THEN timestamp'2024-01-01 04:00:01' ELSE event_time END""",
}
_SENT = "event_id % 4 <> 1 OR event_time < timestamp'2024-01-01 06:00:00'"


def arrival_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with the source partition they come from and the time they arrive."""
    return _view(position_stream(spark, sf_dir).where(_SENT), _ARRIVALS)


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route points with the distance travelled so far, in metres."""
    return _view(_table(spark, sf_dir, "orders"), _SHAPES)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(_table(spark, sf_dir, "customer"), _TRIPS)


def logs_from_events(events: DataFrame) -> DataFrame:
    """Container log lines from event rows, batch or streaming."""
    return _view(events, _LOGS)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs_from_events(_table(spark, sf_dir, "events"))


def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs_from_events(_event_stream(spark, sf_dir))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw nested payloads of up to ``REPORTS_PER_PAYLOAD`` consecutive reports, so that no payload can grow."""
    poll = F.expr(f"event_id div {REPORTS_PER_PAYLOAD}").alias("poll")
    stamp = F.date_format(F.timestamp_millis("ta"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ta")
    vehicle = F.struct("p", "a", stamp, "py", "px")
    line = ["c", "cl", "sl", "lt0", "lt1", "qv"]
    lines = positions(spark, sf_dir).groupBy(poll, *line).agg(F.collect_list(vehicle).alias("vs"))
    return (
        lines.groupBy("poll")
        .agg(F.collect_list(F.struct(*line, "vs")).alias("l"))
        .select(F.to_json(F.struct("l")).alias("payload"))
    )


def broken_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads, and one of each broken kind for every nation: cut off, a list that is an object, an error page."""
    name = F.col("n_name")
    kinds = F.array(
        F.concat(F.lit('{"l":[{"c":"'), name, F.lit('","cl":1,"vs":[{"p":')),
        F.concat(F.lit('{"l":[{"c":"'), name, F.lit('","vs":{"p":1}}]}')),
        F.concat(F.lit("<html><body>"), name, F.lit("</body></html>")),
    )
    broken = _table(spark, sf_dir, "nation").select(F.explode(kinds).alias("payload"))
    return feed(spark, sf_dir).unionByName(broken)


def raw_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports as untyped text, some of which cannot be coerced: bad or missing ids, broken numbers and flags."""
    event = F.col("event_id")
    df = positions(spark, sf_dir)
    text = {f: F.col(f).cast("string") for f in ("cl", "sl", "qv", "p", "a", "ta")}
    text["p"] = F.when(event % 13 == 0, F.concat(F.lit("bus-"), text["p"])).when(event % 17 != 0, text["p"])
    text["a"] = F.when(event % 19 == 0, "maybe").otherwise(text["a"])
    text["ta"] = F.when(event % 23 == 0, "yesterday").otherwise(text["ta"])
    text["py"] = F.format_string("%.4f", "py")
    text["px"] = F.format_string("%.4f", "px")
    return df.select("event_id", *[text.get(f, F.col(f)).alias(f) for f in (
        "c", "cl", "sl", "lt0", "lt1", "qv", "p", "a", "ta", "ta_tempo", "py", "px")])


def careless_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows shaped like the latest-position table that break its rules in several ways."""
    event = F.col("event_id")
    return positions(spark, sf_dir).select(
        F.when(event % 29 != 0, F.col("p")).alias("prefixo"),
        F.when(event % 11 != 0, F.col("c")).alias("linha"),
        F.when(event % 13 == 0, F.repeat("lt0", 20)).otherwise(F.col("lt0")).alias("letreiro_terminal"),
        F.when(event % 7 != 0, F.col("lt1")).alias("letreiro_origem"),
        F.col("py").alias("latitude"),
        F.when(event % 31 != 0, F.col("px")).alias("longitude"),
        F.col("a").alias("acessivel"),
        F.col("event_time").alias("ultima_atualizacao"),
    )
