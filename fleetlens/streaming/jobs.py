"""The eight continuous jobs as Structured Streaming queries.

Current-state tables are kept by ``foreachBatch``: a micro-batch shrinks to one row per key with the batch operators and
is merged into the table, which is itself the state, so no state store grows without bound and late reports still count.
Jobs that need ordered rows share one query, which puts every micro-batch in order once (``ordered.py``) and keeps the
result tables of all of them. A repeated micro-batch changes nothing. Rows that break
a table's rules (a NULL key, text that is too long) go to its reject table. A job writes Parquet tables, or hands its rows
to a sink such as a database.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from fleetlens import schemas
from fleetlens.operators import sketches
from fleetlens.operators.latest import newest_rows
from fleetlens.operators.upsert import (
    KEEP_SECONDS,
    BatchId,
    append_history,
    has_version,
    keep_valid,
    merge_latest,
    read_table,
    upsert,
    upsert_jdbc,
    write_version,
)
from fleetlens.plans import fleet, motion
from fleetlens.session import SETTINGS
from fleetlens.sources.positions import POLL, watermarked
from fleetlens.streaming import idle, ordered
from fleetlens.streaming.ledger import finish, finished, forget

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"

WATERMARK_US = 2_000_000
# Fixed value: silence after which a source partition counts as idle.
IDLE_SECONDS = 5
POLL_SECONDS = 15

Sink = Callable[[DataFrame, BatchId, schemas.TableSpec], None]


@dataclass(frozen=True)
class JobConfig:
    """Where and how jobs write.

    ``trigger`` is passed to ``writeStream.trigger``. ``active_within`` limits job 1 to vehicles seen that recently (for
    example ``10 minutes``), by default all since the start count. ``sink`` takes the valid rows of every batch instead of
    the Parquet result tables. ``state_partitions`` is the number of state partitions of a new stream, by default the
    session's shuffle partitions; a stream keeps the number it starts with. ``keep_seconds`` is how long a replaced version
    of a table stays readable. ``idle_seconds`` is how long a source partition may be silent before the watermark goes on
    without it; None waits for ever. ``ttl_seconds`` is how long the last report of a silent vehicle or line is kept in the
    state of ordered jobs; by default for ever.
    """

    tables: str
    checkpoints: str
    trigger: tuple[tuple[str, object], ...] = (("processingTime", POLL),)
    active_within: str | None = None
    sink: Sink | None = None
    state_partitions: int | None = None
    keep_seconds: int = KEEP_SECONDS
    idle_seconds: float | None = IDLE_SECONDS
    ttl_seconds: float | None = None

    def table(self, spec: schemas.TableSpec) -> str:
        return f"{self.tables}/{spec.name}"


def jdbc_sink(url: str, properties: dict[str, str]) -> Sink:
    """Sink that merges every batch into database tables."""
    return lambda rows, batch, spec: upsert_jdbc(rows, batch, spec, url, properties)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint: the same over restarts, another for a fresh checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def _start(df: DataFrame, cfg: JobConfig, name: str, body: Callable[[DataFrame, BatchId], None], mode: str = "append"):
    checkpoint = f"{cfg.checkpoints}/{name}"

    def write(rows: DataFrame, number: int) -> None:
        # Kept while it is looked at twice. Batches without rows, which stateful jobs run to move on, leave tables alone.
        rows.persist()
        try:
            if not rows.isEmpty():
                body(rows, BatchId(_query_id(rows.sparkSession, checkpoint), number))
        finally:
            rows.unpersist()

    return (
        df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**dict(cfg.trigger)).foreachBatch(write).start()
    )


def _store(rows: DataFrame, batch: BatchId, cfg: JobConfig, spec: schemas.TableSpec) -> None:
    """Merge a batch's rows into a result table, or hand them to the sink."""
    if cfg.sink:
        cfg.sink(keep_valid(rows.select(*spec.columns), batch, cfg.table(spec), spec), batch, spec)
    else:
        upsert(rows, batch, cfg.table(spec), spec, cfg.keep_seconds)


def _replace(rows: DataFrame, batch: BatchId, cfg: JobConfig, spec: schemas.TableSpec) -> None:
    """Write a result table that is computed in full from stored sums."""
    valid = keep_valid(rows.select(*spec.columns), batch, cfg.table(spec), spec)
    if cfg.sink:
        cfg.sink(valid, batch, spec)
    else:
        write_version(valid, cfg.table(spec), batch, cfg.keep_seconds)


# Jobs -------------------------------------------------------------------------------------------------------------

_PAIRS = schemas.TableSpec(
    "active_pairs", ("linha", "prefixo"),
    StructType([StructField("linha", StringType()), StructField("prefixo", schemas.REPORT["p"].dataType),
                StructField("ultima_atualizacao", TimestampType())]),
    optional=("prefixo",),
)


Body = Callable[[DataFrame, BatchId], None]


def _active_vehicles(cfg: JobConfig) -> Body:
    """Job 1. Keeps one row per (line, vehicle) and counts them, so a hot line is never one growing set. Reports without a
    vehicle keep their line's time up to date but are no vehicle, as in the batch plan."""

    def merge(rows: DataFrame, batch: BatchId) -> None:
        seen = rows.groupBy(F.col("c").alias("linha"), F.col("p").alias("prefixo")).agg(
            F.max("event_time").alias("ultima_atualizacao")
        )
        path, spark = cfg.table(_PAIRS), rows.sparkSession
        if not has_version(spark, path, batch):
            valid = keep_valid(seen, batch, path, _PAIRS)
            merged = merge_latest(read_table(spark, path, _PAIRS.schema), valid, _PAIRS.keys, _PAIRS.updated)
            if cfg.active_within:
                # Pairs outside the span are forgotten.
                newest = merged.agg(F.max("ultima_atualizacao")).scalar()
                merged = merged.where(F.col("ultima_atualizacao") >= newest - F.expr(f"INTERVAL {cfg.active_within}"))
            write_version(merged, path, batch, cfg.keep_seconds)
        counts = read_table(spark, path, _PAIRS.schema).groupBy("linha").agg(
            F.count("prefixo").alias("total_onibus_ativos"), F.max("ultima_atualizacao").alias("ultima_atualizacao")
        )
        _replace(counts, batch, cfg, schemas.ACTIVE_VEHICLES)

    return merge


def active_vehicles_job(positions: DataFrame, cfg: JobConfig) -> StreamingQuery:
    return _start(positions, cfg, "active_vehicles", _active_vehicles(cfg))


def _running_schema() -> StructType:
    numbers = [StructField(c, DoubleType()) for c in ("total", "lowest", "highest")]
    return StructType([StructField("linha", StringType()), StructField("rows", LongType()), *numbers,
                       StructField("updated", TimestampType())])


def _summary_columns(spec: schemas.TableSpec) -> tuple[str, str, str]:
    """Mean, lowest and highest column of a result table."""
    return tuple(next(c for c in spec.columns if f"_{part}" in c) for part in ("medi", "minim", "maxim"))


def _sums(column: str) -> list:
    return [F.count(F.lit(1)).alias("rows"), F.sum(column).alias("total"), F.min(column).alias("lowest"),
            F.max(column).alias("highest"), F.max("event_time").alias("updated")]


def _merged(parts: DataFrame, *keys: str) -> DataFrame:
    return parts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"), F.max("updated").alias("updated"),
    )


def _shown(sums: DataFrame, spec: schemas.TableSpec, *others) -> DataFrame:
    mean, lowest, highest = _summary_columns(spec)
    return sums.select(
        "linha", *others, F.round(F.col("total") / F.nullif("rows", F.lit(0)), 2).alias(mean),
        F.round("lowest", 2).alias(lowest), F.round("highest", 2).alias(highest),
        F.col("updated").alias("ultima_atualizacao"),
    ).select(*spec.columns)


Result = Callable[[DataFrame, int, BatchId], None]


def _running(plan: Callable[[DataFrame], DataFrame], column: str, cfg: JobConfig, name: str, spec: schemas.TableSpec) -> Result:
    """All-time mean, lowest and highest by line, from sums merged batch by batch."""
    path = f"{cfg.tables}/{name}_running"

    def merge(rows: DataFrame, mark: int, batch: BatchId) -> None:
        spark = rows.sparkSession
        if not has_version(spark, path, batch):
            part = plan(rows).groupBy("linha").agg(*_sums(column))
            merged = _merged(read_table(spark, path, _running_schema()).unionByName(part), "linha")
            write_version(merged, path, batch, cfg.keep_seconds)
        _replace(_shown(read_table(spark, path, _running_schema()), spec), batch, cfg, spec)

    return merge


def _history(plan: Callable[[DataFrame], DataFrame], column: str, cfg: JobConfig, name: str, spec: schemas.TableSpec) -> Result:
    """Summaries per line and minute, added once the watermark has passed the minute; sums of open minutes are kept."""
    path = f"{cfg.tables}/{name}_open"
    times = [StructField("janela_inicio", TimestampType()), StructField("janela_fim", TimestampType())]
    schema = StructType([*_running_schema().fields, *times])
    keys = ("linha", "janela_inicio", "janela_fim")

    def append(rows: DataFrame, mark: int, batch: BatchId) -> None:
        spark = rows.sparkSession
        if has_version(spark, path, batch):
            return
        window = F.window("event_time", motion.HISTORY_WINDOW).alias("_w")
        part = plan(rows).groupBy("linha", window).agg(*_sums(column)).withColumns(
            {"janela_inicio": F.col("_w.start"), "janela_fim": F.col("_w.end")}).drop("_w")
        sums = _merged(read_table(spark, path, schema).unionByName(part), *keys).persist()
        try:
            closed = F.unix_micros("janela_fim") <= mark
            done = _shown(sums.where(closed), spec, "janela_inicio", "janela_fim")
            valid = keep_valid(done, batch, cfg.table(spec), spec)
            if cfg.sink:
                cfg.sink(valid, batch, spec)
            else:
                append_history(valid, batch, cfg.table(spec), spec)
            write_version(sums.where(~closed).select(*schema.names), path, batch, cfg.keep_seconds)
        finally:
            sums.unpersist()

    return append


def _status(cfg: JobConfig) -> Result:
    spec = schemas.VEHICLE_STATUS
    return lambda rows, mark, batch: _store(_status_rows(ordered.motion_with_gaps(rows)), batch, cfg, spec)


# Jobs 2, 3, 4, 5 and 7 take ordered rows.
ORDERED: dict[str, Callable[[JobConfig], Result]] = {
    "speed_by_line": lambda cfg: _running(
        ordered.speed_events, "speed_kmh", cfg, "speed_by_line", schemas.SPEED_BY_LINE),
    "speed_history": lambda cfg: _history(
        ordered.speed_events, "speed_kmh", cfg, "speed_history", schemas.SPEED_HISTORY),
    "headway_by_line": lambda cfg: _running(
        ordered.headway_events, "headway_min", cfg, "headway_by_line", schemas.HEADWAY_BY_LINE),
    "headway_history": lambda cfg: _history(
        ordered.headway_events, "headway_min", cfg, "headway_history", schemas.HEADWAY_HISTORY),
    "vehicle_status": _status,
}


def _ordered(cfg: JobConfig, names: Sequence[str]) -> Body:
    results = [ORDERED[name](cfg) for name in names]
    path = f"{cfg.tables}/ordered_state"
    idle_us, ttl_us = (None if seconds is None else int(seconds * 1_000_000) for seconds in (cfg.idle_seconds, cfg.ttl_seconds))
    return lambda rows, batch: ordered.run_batch(rows, batch, path, WATERMARK_US, cfg.keep_seconds, results, idle_us, ttl_us)


def ordered_jobs(positions: DataFrame, cfg: JobConfig, names: tuple[str, ...] = tuple(ORDERED)) -> StreamingQuery:
    """One query that orders the reports and keeps the results of the named jobs."""
    return _start(positions, cfg, "ordered", _ordered(cfg, names))


def vehicle_sketches_job(positions: DataFrame, cfg: JobConfig, bin_: str = "1m") -> StreamingQuery:
    """Sketches of the vehicles of every line and minute, appended once the watermark has passed the minute. Beside job 1 for
    fleets whose pairs of line and vehicle are too many: any span is a union of its minutes (``sketches.active_within``)."""
    bins = sketches.stored(sketches.vehicle_sketches(watermarked(positions), bin_))
    return (
        bins.writeStream.queryName("vehicle_sketches").outputMode("append").format("parquet")
        .option("path", f"{cfg.tables}/vehicle_sketches").option("checkpointLocation", f"{cfg.checkpoints}/vehicle_sketches")
        .trigger(**dict(cfg.trigger)).start()
    )


def source_marks_job(arrivals: DataFrame, cfg: JobConfig, poll_seconds: int = POLL_SECONDS) -> StreamingQuery:
    """Watermark, active and idle partitions, and late reports at the end of every poll, for watching a source. ``arrivals``
    have ``source_partition``, ``event_time`` and ``arrived``."""
    idle_us = int((cfg.idle_seconds or 1e9) * 1_000_000)
    return _start(arrivals, cfg, "source_marks", lambda rows, batch: idle.track(
        rows, batch, cfg.table(idle.MARKS), f"{cfg.tables}/source_marks_state", poll_seconds, WATERMARK_US, idle_us, cfg.keep_seconds))


def _newest(plan: Callable[[DataFrame], DataFrame], spec: schemas.TableSpec) -> Callable[[JobConfig], Body]:
    return lambda cfg: lambda rows, batch: _store(plan(rows), batch, cfg, spec)


def _status_rows(rows: DataFrame) -> DataFrame:
    found = rows.withColumn("_has_gap", F.col("gap_km").isNotNull())
    return fleet.as_status_rows(newest_rows(found, ["p"], ["event_time", "_has_gap", "event_id"]))


# Jobs 1, 6 and 8 take reports as they come.
UNORDERED: dict[str, Callable[[JobConfig], Body]] = {
    "active_vehicles": _active_vehicles,
    "latest_position": _newest(fleet.latest_position, schemas.LATEST_POSITION),
    "line_catalogue": _newest(fleet.line_catalogue, schemas.LINE_CATALOGUE),
}


def latest_position_job(positions: DataFrame, cfg: JobConfig) -> StreamingQuery:
    """Job 6."""
    return _start(positions, cfg, "latest_position", UNORDERED["latest_position"](cfg))


def line_catalogue_job(positions: DataFrame, cfg: JobConfig) -> StreamingQuery:
    """Job 8."""
    return _start(positions, cfg, "line_catalogue", UNORDERED["line_catalogue"](cfg))


JOBS: dict[str, Callable[[DataFrame, JobConfig], StreamingQuery]] = {
    "active_vehicles": active_vehicles_job,
    "latest_position": latest_position_job,
    "line_catalogue": line_catalogue_job,
}
# All job names, in the order of the result tables.
NAMES = ("active_vehicles", "speed_by_line", "speed_history", "headway_by_line", "headway_history", "latest_position",
         "vehicle_status", "line_catalogue")


def start_all(
    spark: SparkSession, source: Callable[[], DataFrame], cfg: JobConfig, names: tuple[str, ...] = NAMES
) -> dict[str, StreamingQuery]:
    """Start jobs side by side, each with its own reader from ``source`` and its own checkpoint. Those that need ordered
    reports share one query, which stands under each of their names."""
    spark.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    wanted = spark.conf.get(PARTITIONS)
    if cfg.state_partitions:
        spark.conf.set(PARTITIONS, str(cfg.state_partitions))
    try:
        queries = {name: JOBS[name](source(), cfg) for name in names if name in JOBS}
        shared = tuple(name for name in names if name in ORDERED)
        if shared:
            queries |= dict.fromkeys(shared, ordered_jobs(source(), cfg, shared))
        return queries
    finally:
        spark.conf.set(PARTITIONS, wanted)


def _fan_out(bodies: dict[str, Body], cfg: JobConfig) -> Body:
    """Run all bodies on a micro-batch side by side, and note in a ledger which have finished.

    If one fails the batch fails, and Spark repeats it; those that the ledger names are not run again. The entries of a batch
    go when the next one has finished.
    """
    ledger = f"{cfg.tables}/_ledger"

    def run(rows: DataFrame, batch: BatchId) -> None:
        spark = rows.sparkSession
        done = finished(spark, ledger, batch)
        # Jobs of the same micro-batch share the executors, and its rows, which are kept in memory.
        with ThreadPoolExecutor(len(bodies)) as pool:
            running = {name: pool.submit(inheritable_thread_target(spark)(body), rows, batch)
                       for name, body in bodies.items() if name not in done}
            failed = []
            for name, result in running.items():
                if result.exception() is None:
                    finish(spark, ledger, batch, name)
                else:
                    failed.append(result.exception())
        if failed:
            raise failed[0]
        forget(spark, ledger, batch)

    return run


def start_together(positions: DataFrame, cfg: JobConfig, names: tuple[str, ...] = NAMES) -> StreamingQuery:
    """All named jobs in one streaming query with one reader: every micro-batch is read once and handed to all of them."""
    bodies = {name: UNORDERED[name](cfg) for name in names if name in UNORDERED}
    shared = tuple(name for name in names if name in ORDERED)
    if shared:
        bodies["ordered"] = _ordered(cfg, shared)
    return _start(positions, cfg, "together", _fan_out(bodies, cfg))
