"""Every query by name, as ``(spark, folder of the base tables) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import display, timing
from fleetlens.operators import constraints, deadletter, logindex, logmetrics, sketches, spatial, upsert
from fleetlens.operators.lag import CHUNK
from fleetlens.plans import fleet, headway, motion, panels, routes
from fleetlens.schemas import LATEST_POSITION, TABLES
from fleetlens.session import SETTINGS, ensure_checkpoint_dir, shared_dir
from fleetlens.sources import derived, feed, producer
from fleetlens.sources.positions import with_gps_timestamp
from fleetlens.streaming import idle, jobs, joined, logstreams

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the parameterised queries.
LINE = "L01-10"
EXTENT_LINES = ("L01-10", "L02-10", "L03-10")
UPSERT_CUT = "2024-01-01 06:00:00"
RAW_DIGITS = 6
SMALL_CHUNK = 100
# Seconds of a poll and of silence that make a partition idle, for the test views' sparse reports.
IDLE_POLL, IDLE_AFTER = 300, 720
# Seconds after which a silent vehicle or line is forgotten in ``stream_vehicle_status_ttl``.
TTL_SECONDS = 600
STATE_COUNTS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def _on_positions(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plan(derived.positions(spark, folder))


def _stored_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Latest positions as a stored table: the route queries read it several times."""
    ensure_checkpoint_dir(spark)
    return fleet.latest_position(derived.positions(spark, folder)).checkpoint()


def _gps_time_parts(positions: DataFrame) -> DataFrame:
    iso = F.date_format(F.timestamp_millis("ta"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    gps = timing.parse_iso(iso)
    return positions.select("event_id", timing.epoch_millis(gps).alias("ta"), timing.local_text(gps).alias("ta_tempo"))


def _vehicle_lag(positions: DataFrame) -> DataFrame:
    return motion.with_previous_fix(positions).select("event_id", "p", "from_py", "from_px", "from_time")


def _adjacent_lag(positions: DataFrame) -> DataFrame:
    return headway.with_neighbour(positions).select("event_id", "c", "sl", "p", "near_py", "near_px", "near_p")


def _adjacent_lag_chunked(positions: DataFrame) -> DataFrame:
    splits = motion.time_splits(positions, motion.LINE_WAY, rows_per_chunk=SMALL_CHUNK)
    rows = headway.with_neighbour(positions, splits)
    return rows.select("event_id", "c", "sl", "p", "near_py", "near_px", "near_p")


def _headway_chunked(positions: DataFrame) -> DataFrame:
    splits = motion.time_splits(positions, motion.VEHICLE, motion.LINE_WAY, rows_per_chunk=SMALL_CHUNK)
    return headway.headway_by_line(positions, splits)


def _segment_distance(positions: DataFrame) -> DataFrame:
    rows = motion.segments(positions)
    return rows.select("event_id", "p", F.round("distance_km", RAW_DIGITS).alias("distance_km"), "seconds")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, RAW_DIGITS) for c in columns})


def _upsert_merge(positions: DataFrame) -> DataFrame:
    """Latest positions up to a cut, merged with every report after it."""
    before = F.col("event_time") < F.lit(UPSERT_CUT).cast("timestamp")
    target = fleet.latest_position(positions.where(before))
    batch = fleet.as_position_rows(positions.where(~before)).drop("event_id")
    return upsert.merge_latest(target, batch, LATEST_POSITION.keys, LATEST_POSITION.updated)


def _constraint_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, broken = constraints.check_constraints(derived.careless_positions(spark, folder), LATEST_POSITION)
    return broken.withColumn("broken", F.array_join(F.array_sort("broken"), ","))


def _decimal_comma(positions: DataFrame) -> DataFrame:
    return positions.select("event_id", display.decimal_comma(F.col("py"), 2).alias("py_text"))


def _line_filter(spark: SparkSession, folder: str) -> DataFrame:
    logs = derived.logs(spark, folder)
    return logmetrics.select_logs(logs, line_regex="(?i)(checkpoint|completed)").select("ts", "container", "stream", "line")


def _panel(key: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        metric = panels.run_panel(derived.logs(spark, folder), panels.PANELS[key])
        return _rounded(metric, "value") if dict(metric.dtypes).get("value") == "double" else metric

    return run


# Log-metric forms and the panel that shows each.
LOG_FORMS = {
    "log_scan": "kafka_feed",
    "log_count_over_time": "flink_checkpoints",
    "log_count_default": "flink_failures",
    "log_live_containers": "flink_live_containers",
    "log_series_count": "kafka_topics",
    "log_extract_count": "flink_running_jobs",
    "log_quantile": "flink_checkpoint_p95",
    "log_rate": "kafka_messages_in",
    "log_rate_by_container": "flink_rate_by_container",
    "log_bytes_rate": "kafka_bytes_by_container",
    "log_bytes_over_time": "kafka_log_bytes",
}

BATCH: dict[str, Query] = {
    # Continuous jobs, as batch results.
    "active_vehicles": _on_positions(fleet.active_vehicles),
    "speed_by_line": _on_positions(motion.speed_by_line),
    "speed_history": _on_positions(motion.speed_history),
    "headway_by_line": _on_positions(headway.headway_by_line),
    "headway_history": _on_positions(headway.headway_history),
    "latest_position": _on_positions(fleet.latest_position),
    "vehicle_status": _on_positions(fleet.vehicle_status),
    "line_catalogue": _on_positions(fleet.line_catalogue),
    # Steps those jobs are made of.
    "gps_timestamp": _on_positions(lambda p: with_gps_timestamp(p).select("event_id", "ta_tempo", "ta_ts")),
    "gps_time_parts": _on_positions(_gps_time_parts),
    "vehicle_lag": _on_positions(_vehicle_lag),
    "adjacent_lag": _on_positions(_adjacent_lag),
    # The form that tables with very large keys get, forced by a small chunk.
    "adjacent_lag_chunked": _on_positions(_adjacent_lag_chunked),
    "headway_by_line_chunked": _on_positions(_headway_chunked),
    "segment_distance": _on_positions(_segment_distance),
    "instant_speed": _on_positions(lambda p: _rounded(motion.speed_events(p), "speed_kmh")),
    "speed_valid": _on_positions(lambda p: _rounded(motion.plausible(motion.speed_events(p)), "speed_kmh")),
    "line_gaps": _on_positions(lambda p: _rounded(headway.line_gaps(p), "gap_km")),
    "headway_events": _on_positions(
        lambda p: _rounded(headway.headway_events(p), "speed_kmh", "gap_km", "headway_min")
    ),
    "vehicle_motion_left": _on_positions(lambda p: _rounded(headway.motion_with_gaps(p), "speed_kmh", "gap_km")),
    "direction_label": _on_positions(
        lambda p: p.select("event_id", "sl", display.direction_label(F.col("sl")).alias("sentido"))
    ),
    "decimal_comma": _on_positions(_decimal_comma),
    # Control-room queries.
    "lookup_line": _on_positions(lambda p: routes.rows_of_line(fleet.active_vehicles(p), LINE)),
    "lookup_line_speed": _on_positions(lambda p: routes.rows_of_line(motion.speed_by_line(p), LINE)),
    "lookup_line_headway": _on_positions(lambda p: routes.rows_of_line(headway.headway_by_line(p), LINE)),
    "speed_history_line": _on_positions(lambda p: routes.history_of_line(motion.speed_history(p), LINE)),
    "headway_history_line": _on_positions(lambda p: routes.history_of_line(headway.headway_history(p), LINE)),
    "positions_sample": _on_positions(lambda p: routes.positions_sample(fleet.latest_position(p), LINE)),
    "operations_panel": _on_positions(lambda p: routes.operations_panel(fleet.vehicle_status(p), LINE)),
    "operations_panel_all": _on_positions(lambda p: routes.operations_panel(fleet.vehicle_status(p))),
    "line_filter_options": _on_positions(lambda p: routes.line_filter_options(fleet.line_catalogue(p))),
    "nearest_shape": lambda s, d: routes.place_on_shapes(_stored_latest(s, d), derived.shapes(s, d)).select(
        "prefixo", "linha", "dist_percorrida_metros"
    ),
    "route_spacing": lambda s, d: routes.route_spacing(_stored_latest(s, d), derived.shapes(s, d)),
    "distinct_trips": lambda s, d: routes.distinct_trips(derived.trips(s, d)),
    "route_extent": lambda s, d: routes.route_extent(derived.shapes(s, d), derived.trips(s, d)),
    "route_length": lambda s, d: routes.route_length(derived.shapes(s, d), derived.trips(s, d), EXTENT_LINES),
    "route_length_all": lambda s, d: routes.route_length(derived.shapes(s, d), derived.trips(s, d)),
    # Ingest and sinks.
    "flatten_feed": lambda s, d: feed.flatten_feed(derived.feed(s, d)),
    "dead_payloads": lambda s, d: feed.dead_payloads(derived.broken_feed(s, d)),
    "ingest_messages": lambda s, d: producer.feed_messages(derived.broken_feed(s, d)),
    "flatten_checked": lambda s, d: feed.flatten_checked(derived.feed(s, d))[0],
    "valid_reports": lambda s, d: deadletter.split_valid(derived.raw_reports(s, d))[0],
    "dead_letter": lambda s, d: deadletter.split_valid(derived.raw_reports(s, d))[1],
    "keyed_messages": _on_positions(deadletter.keyed_json),
    "upsert_merge": _on_positions(_upsert_merge),
    "constraint_violations": lambda s, d: constraints.violation_report(
        derived.careless_positions(s, d), LATEST_POSITION
    ),
    "constraint_rejects": _constraint_rejects,
    # Log metrics.
    "log_line_filter": _line_filter,
    **{form: _panel(key) for form, key in LOG_FORMS.items()},
    **{f"panel_{key}": _panel(key) for key in panels.PANELS if key not in LOG_FORMS.values()},
}


def _stream(name: str, spec) -> Query:
    """Run one continuous job over all reports that are there now, and return the table it keeps."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        home = f"{shared_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
        cfg = jobs.JobConfig(f"{home}/tables", f"{home}/checkpoints", (("availableNow", True),))
        query = jobs.start_all(spark, lambda: derived.position_stream(spark, folder), cfg, (name,))[name]
        query.awaitTermination()
        if spec.updated in spec.keys:
            return upsert.read_history(spark, cfg.table(spec), spec).select(*spec.columns)
        return upsert.read_table(spark, cfg.table(spec), spec.schema)

    return run


STREAMS: dict[str, Query] = {
    f"stream_{name}": _stream(name, spec) for name, spec in zip(jobs.NAMES, (
        TABLES["tb_onibus_ativos_por_linha"], TABLES["tb_velocidade_por_linha"],
        TABLES["tb_historico_velocidade_por_linha"], TABLES["tb_headway_por_linha"],
        TABLES["tb_historico_headway_por_linha"], TABLES["tb_posicao_atual_onibus"],
        TABLES["tb_veiculos_em_operacao"], TABLES["tb_linhas_onibus_filtro"],
    ), strict=True)
}

def _job_config(spark: SparkSession, name: str, **settings) -> jobs.JobConfig:
    home = f"{shared_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
    return jobs.JobConfig(f"{home}/tables", f"{home}/checkpoints", (("availableNow", True),), **settings)


def _idle_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Watermarks of a source of four partitions, one of which stops, one lags and one wakes late."""
    cfg = _job_config(spark, "idle_partitions", idle_seconds=IDLE_AFTER)
    jobs.source_marks_job(derived.arrival_stream(spark, folder), cfg, IDLE_POLL).awaitTermination()
    return upsert.read_history(spark, cfg.table(idle.MARKS), idle.MARKS).select(*idle.MARKS.columns)


def _appended(name: str, plan: Callable[[SparkSession, str], DataFrame]) -> Query:
    """Run a streaming plan over all that is there now into a Parquet sink in append mode, and return what it wrote."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        home = f"{shared_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
        spark.conf.set(jobs.STATE_STORE, SETTINGS[jobs.STATE_STORE])
        rows = plan(spark, folder)
        query = rows.writeStream.format("parquet").option("path", f"{home}/rows").option("checkpointLocation", f"{home}/checkpoint")
        # A count of all state rows costs a look-up at every write, and nobody reads it here.
        counted = spark.conf.get(STATE_COUNTS, "true")
        spark.conf.set(STATE_COUNTS, "false")
        try:
            running = query.queryName(name).trigger(availableNow=True).start()
        finally:
            spark.conf.set(STATE_COUNTS, counted)
        running.awaitTermination()
        return spark.read.schema(rows.schema).parquet(f"{home}/rows")

    return run


def _status_ttl(spark: SparkSession, folder: str) -> DataFrame:
    """Vehicle status where vehicles and lines that were silent for longer than a time to live start afresh."""
    cfg, spec = _job_config(spark, "vehicle_status_ttl", ttl_seconds=TTL_SECONDS), TABLES["tb_veiculos_em_operacao"]
    jobs.ordered_jobs(derived.position_stream(spark, folder), cfg, ("vehicle_status",)).awaitTermination()
    return upsert.read_table(spark, cfg.table(spec), spec.schema)


def _log_stream(name: str, panel: panels.Panel) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        cfg = _job_config(spark, name)
        spark.conf.set(jobs.STATE_STORE, SETTINGS[jobs.STATE_STORE])
        rows = logstreams.run_panel(derived.log_stream(spark, folder), panel)
        logstreams.append_panel(rows, cfg, name).awaitTermination()
        found = spark.read.schema(rows.schema).parquet(f"{cfg.tables}/{name}")
        return _rounded(found, "value") if dict(found.dtypes)["value"] == "double" else found

    return run


# Log panels as streams. The ranges of the first ones slide; the last have a value at every step.
LOG_STREAMS: dict[str, panels.Panel] = {
    "stream_log_rate": panels.Panel("rate", "5m", matching={"container": ".*kafka.*|.*python.*"}, step="1m"),
    "stream_log_rate_by_container": panels.Panel("rate_by_container", "1h", matching={"container": ".*flink.*"}, step="10m"),
    "stream_log_bytes_over_time": panels.Panel("bytes", "1h", matching={"container": ".*kafka.*|.*python.*"}, step="10m"),
    "stream_log_live_containers": panels.PANELS["flink_live_containers"],
    "stream_log_count_default": panels.PANELS["registry_errors"],
    "stream_log_bytes_default": panels.PANELS["flink_bytes_by_container"],
}


def _quantile_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Whether quantiles of days, merged from the stored sketches of a streamed job's hours, keep their bound on the rank."""
    cfg = _job_config(spark, "log_quantile_sketch")
    wanted = logmetrics.condition(panels.PANELS["flink_checkpoint_p95"].equal)
    lines = derived.log_stream(spark, folder).withWatermark("ts", logstreams.DELAY)
    bins = sketches.stored(sketches.value_sketches(lines, panels.CHECKPOINT_MS, "1h", panels.SERIES, wanted))
    logstreams.append_panel(bins, cfg, "bins").awaitTermination()
    by = ["container", "stream"]
    merged = sketches.merged_quantiles(spark.read.schema(bins.schema).parquet(f"{cfg.tables}/bins"), 0.95, "24h", by)
    lines = logmetrics.extract(logmetrics.select_logs(derived.logs(spark, folder), panels.PANELS["flink_checkpoint_p95"].equal),
                               panels.CHECKPOINT_MS, "found")
    # The last bin is still open.
    newest = derived.logs(spark, folder).agg(F.max("ts")).first()[0]
    done = F.date_trunc("hour", F.date_trunc("millisecond", F.lit(newest)) - F.expr(f"INTERVAL {logstreams.DELAY}"))
    values = lines.where(F.col("ts") < done).select(*by, F.window("ts", "24 hours").alias("w"), F.col("found").cast("double").alias("v"))
    both = values.select(*by, F.col("w.start").alias("window_start"), "v").join(merged, [*by, "window_start"])
    ranks = both.groupBy(*by, "window_start", "window_end").agg(
        F.count(F.lit(1)).alias("values"), F.avg((F.col("v") < F.col("value")).cast("int")).alias("low"),
        F.avg((F.col("v") <= F.col("value")).cast("int")).alias("high"))
    error = F.greatest(F.col("low") - 0.95, 0.95 - F.col("high"), F.lit(0.0))
    return ranks.select(*by, "window_start", "window_end", "values", (error <= sketches.RANK_ERROR).alias("within"))


def _active_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Vehicles of each line and hour, exact and whether the union of a streamed job's sketches of minutes is within its bound."""
    cfg = _job_config(spark, "active_vehicles_sketch")
    jobs.vehicle_sketches_job(derived.position_stream(spark, folder), cfg).awaitTermination()
    bins = spark.read.parquet(f"{cfg.tables}/vehicle_sketches")
    about = sketches.active_vehicles(bins, "1h").withColumnRenamed("total_onibus_ativos", "about").drop("ultima_atualizacao")
    seen = derived.positions(spark, folder)
    newest = seen.agg(F.max("event_time")).first()[0]
    done = F.date_trunc("minute", F.date_trunc("millisecond", F.lit(newest)) - F.expr("INTERVAL 2 SECONDS"))
    exact = seen.where(F.col("event_time") < done).groupBy(F.col("c").alias("linha"), F.window("event_time", "1 hour").alias("w")).agg(
        F.count_distinct("p").alias("total_onibus_ativos"))
    both = exact.select("linha", F.col("w.start").alias("window_start"), "total_onibus_ativos").join(about, ["linha", "window_start"], "left")
    off = F.abs(F.col("about") - F.col("total_onibus_ativos"))
    return both.select("linha", "window_start", "total_onibus_ativos",
                       F.coalesce(off <= F.ceil(sketches.COUNT_ERROR * F.col("total_onibus_ativos")), F.lit(False)).alias("within"))


def _shape_index(spark: SparkSession, folder: str) -> spatial.Index:
    """The stored index of a folder's shapes, built where there is none yet of these shapes."""
    shapes = derived.shapes(spark, folder)
    # Shapes that change have another index.
    state = shapes.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*shapes.columns).cast("decimal(38,0)"))).first()
    path = f"{shared_dir(spark)}/shape-index-{uuid.uuid5(uuid.NAMESPACE_URL, f'{folder} {state}').hex}"
    at = ["shape_pt_lat", "shape_pt_lon"]
    return spatial.opened(spark, path) or spatial.build(shapes, at, "shape_dist_traveled", "shape_id", routes.SEARCH_DEGREES, path)


def _log_scan_stored(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark)}/logs-{uuid.uuid4().hex}"
    logindex.append_logs(derived.logs(spark, folder), path)
    panel = panels.PANELS[LOG_FORMS["log_scan"]]
    return logindex.read_logs(spark, path, panel.equal, panel.matching, panel.line)


# Over stored indexes.
STORED: dict[str, Query] = {
    "nearest_shape_stored": lambda s, d: routes.place_on_index(_stored_latest(s, d), _shape_index(s, d)).select(
        "prefixo", "linha", "dist_percorrida_metros"),
    "route_spacing_stored": lambda s, d: routes.route_spacing(_stored_latest(s, d), _shape_index(s, d)),
    "log_scan_stored": _log_scan_stored,
}

def _all_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the eight result tables after one query with one reader has kept them all."""
    cfg = _job_config(spark, "together")
    jobs.start_together(derived.position_stream(spark, folder), cfg).awaitTermination()
    found = None
    for name, spec in TABLES.items():
        stored = upsert.read_history if spec.updated in spec.keys else lambda s, path, spec: upsert.read_table(s, path, spec.schema)
        part = stored(spark, cfg.table(spec), spec).agg(F.count(F.lit(1)).alias("linhas"), F.count_distinct(
            spec.keys[0]).alias("chaves"), F.max(spec.updated).alias("ultima")).withColumn("tabela", F.lit(name))
        found = part if found is None else found.unionByName(part)
    return found


STREAMS |= {
    "stream_all_jobs": _all_jobs,
    "stream_idle_partitions": _idle_partitions,
    # Append streams, joined by Spark's stream-stream join.
    "stream_headway_events": lambda s, d: _rounded(_appended(
        "headway_events", lambda s, d: joined.headway_events(derived.position_stream(s, d)))(s, d), "speed_kmh", "gap_km", "headway_min"),
    "stream_motion_left": lambda s, d: _rounded(_appended(
        "motion_left", lambda s, d: joined.motion_with_gaps(derived.position_stream(s, d)))(s, d), "speed_kmh", "gap_km"),
    "stream_vehicle_status_ttl": _status_ttl,
    **{name: _log_stream(name, panel) for name, panel in LOG_STREAMS.items()},
    "log_quantile_sketch": _quantile_sketch,
    "active_vehicles_sketch": _active_sketch,
}

QUERIES: dict[str, Query] = {**BATCH, **STORED, **STREAMS}
