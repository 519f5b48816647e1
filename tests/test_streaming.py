"""Continuous jobs over several micro-batches against the batch plans."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.operators import logmetrics as lm
from fleetlens.operators.latest import newest_by_state
from fleetlens.operators.upsert import read_history, read_rejects, read_table
from fleetlens.plans import fleet, headway, motion
from fleetlens.sources import derived, feed
from fleetlens.sources.positions import read_positions, watermarked
from fleetlens.streaming import jobs
from fleetlens.streaming.lag_state import stream_lag
from tests.conftest import SMALL, rows_of

BATCHES = 4


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Positions in files that arrive in time order; inside a file the rows are shuffled."""
    folder = tmp_path_factory.mktemp("landed")
    rows = derived.positions(spark, SMALL).orderBy("event_time", "event_id").collect()
    size = -(-len(rows) // BATCHES)
    rng = random.Random(5)
    for i in range(BATCHES):
        part = rows[i * size:(i + 1) * size]
        rng.shuffle(part)
        spark.createDataFrame(part, schemas.POSITIONS).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def config(tmp_path, **extra):
    return jobs.JobConfig(str(tmp_path / "tables"), str(tmp_path / "checkpoints"), (("availableNow", True),), **extra)


def run(spark, folder, cfg, *names):
    def source():
        return read_positions(spark, "parquet", folder, streaming=True, maxFilesPerTrigger="1")

    queries = jobs.start_all(spark, source, cfg, names)
    for query in queries.values():
        query.awaitTermination()
        assert query.exception() is None
    return queries


def passed(spark, folder):
    """Condition for rows the final watermark has passed."""
    mark = read_positions(spark, "parquet", folder).agg(F.max("event_time")).first()[0]
    return F.col("event_time") <= F.date_trunc("millisecond", F.lit(mark)) - F.expr("INTERVAL 2 SECONDS")


def test_headway_history_over_batches(spark, landed, tmp_path):
    cfg = config(tmp_path)
    run(spark, landed, cfg, "headway_history")
    batch = headway.headway_history(read_positions(spark, "parquet", landed))
    stored = read_history(spark, cfg.table(schemas.HEADWAY_HISTORY), schemas.HEADWAY_HISTORY).drop("window_date")
    missing = batch.exceptAll(stored).select(F.col("janela_fim").alias("event_time"))
    assert stored.exceptAll(batch).count() == 0
    assert stored.count() > 100 and missing.where(passed(spark, landed)).count() == 0


def test_status_over_batches(spark, landed, tmp_path):
    cfg = config(tmp_path)
    run(spark, landed, cfg, "vehicle_status")
    seen = read_positions(spark, "parquet", landed)
    expected = fleet.as_status_rows(
        jobs.newest_rows(headway.motion_with_gaps(seen).where(passed(spark, landed)), ["p"], ["event_time", "event_id"])
    )
    stored = read_table(spark, cfg.table(schemas.VEHICLE_STATUS), schemas.VEHICLE_STATUS.schema)
    assert rows_of(stored) == rows_of(expected)


@pytest.mark.parametrize("slot_seconds", [60, 3600, 10**6])
def test_stream_lag_equals_lag_for_any_slot(spark, landed, tmp_path, slot_seconds):
    spark.conf.set(jobs.STATE_STORE, jobs.SETTINGS[jobs.STATE_STORE])
    source = read_positions(spark, "parquet", landed, streaming=True, maxFilesPerTrigger="1")
    out = stream_lag(watermarked(source), ["c", "sl"], ["p", "py", "px"], headway.NEIGHBOUR, slot_seconds)
    query = (
        out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    columns = ["event_id", "p", *headway.NEIGHBOUR]
    expected = headway.with_neighbour(read_positions(spark, "parquet", landed)).where(passed(spark, landed))
    assert rows_of(spark.read.parquet(str(tmp_path / "out")).select(*columns)) == rows_of(expected.select(*columns))


def test_state_tables_over_batches_side_by_side(spark, landed, tmp_path):
    cfg = config(tmp_path)
    run(spark, landed, cfg, "active_vehicles", "latest_position", "line_catalogue")
    seen = read_positions(spark, "parquet", landed)
    for spec, plan in ((schemas.ACTIVE_VEHICLES, fleet.active_vehicles), (schemas.LATEST_POSITION, fleet.latest_position),
                       (schemas.LINE_CATALOGUE, fleet.line_catalogue)):
        assert rows_of(read_table(spark, cfg.table(spec), spec.schema)) == rows_of(plan(seen))


def test_fresh_checkpoints_lose_nothing(spark, reports, tmp_path):
    """Two queries one after the other, each from batch 0, over the same tables."""
    first = [{"p": 1, "at": 0}, {"p": 1, "at": 60, "km": 0.5}, {"p": None, "at": 61}, {"p": 2, "at": 600}, {"p": 2, "at": 700, "id": 70}]
    then = [{"p": 1, "at": 1000, "km": 1.0, "id": 80}, {"p": 1, "at": 1100, "km": 2.0, "id": 81}, {"p": 3, "at": 1300, "id": 82},
            {"p": 3, "at": 1400, "id": 83}]
    names = ("active_vehicles", "speed_by_line", "speed_history", "latest_position")
    seen = {}
    for turn, part in enumerate((first, then)):
        folder = str(tmp_path / f"in{turn}")
        for report in part:  # several batches
            reports([report]).coalesce(1).write.mode("append").parquet(folder)
        cfg = jobs.JobConfig(str(tmp_path / "tables"), str(tmp_path / f"checkpoints{turn}"), (("availableNow", True),),
                             state_partitions=2, keep_seconds=0)
        run(spark, folder, cfg, *names)
        seen[turn] = read_history(spark, cfg.table(schemas.SPEED_HISTORY), schemas.SPEED_HISTORY).count()
    latest = read_table(spark, cfg.table(schemas.LATEST_POSITION), schemas.LATEST_POSITION.schema).collect()
    assert {r.prefixo: r.ultima_atualizacao.minute for r in latest} == {1: 18, 2: 11, 3: 23}
    assert read_rejects(spark, cfg.table(schemas.LATEST_POSITION), schemas.LATEST_POSITION).count() == 1
    active = read_table(spark, cfg.table(schemas.ACTIVE_VEHICLES), schemas.ACTIVE_VEHICLES.schema).first()
    assert active.total_onibus_ativos == 3
    speeds = read_table(spark, cfg.table(schemas.SPEED_BY_LINE), schemas.SPEED_BY_LINE.schema).first()
    assert speeds.velocidade_maxima == 36.0 and seen[1] > seen[0] > 0


def test_rows_go_to_a_sink(spark, landed, tmp_path):
    got = {}

    def sink(rows, batch, spec):
        got.setdefault((spec.name, batch.query), []).append(rows.count())

    run(spark, landed, config(tmp_path, sink=sink), "latest_position", "active_vehicles")
    assert {name for name, _ in got} == {schemas.LATEST_POSITION.name, schemas.ACTIVE_VEHICLES.name} and len(got) == 2
    assert all(len(counts) == BATCHES for counts in got.values())


def test_active_within_forgets_quiet_vehicles(spark, landed, tmp_path):
    cfg = config(tmp_path, active_within="1 hour")
    run(spark, landed, cfg, "active_vehicles")
    seen = read_positions(spark, "parquet", landed)
    newest = seen.agg(F.max("event_time")).first()[0]
    recent = seen.groupBy("c", "p").agg(F.max("event_time").alias("event_time"))
    recent = recent.where(F.col("event_time") >= F.lit(newest) - F.expr("INTERVAL 1 HOUR"))
    spec = schemas.ACTIVE_VEHICLES
    assert rows_of(read_table(spark, cfg.table(spec), spec.schema)) == rows_of(fleet.active_vehicles(recent))


def test_running_means_do_not_count_a_batch_twice(spark, landed, tmp_path):
    cfg = config(tmp_path)
    run(spark, landed, cfg, "speed_by_line")
    first = rows_of(read_table(spark, cfg.table(schemas.SPEED_BY_LINE), schemas.SPEED_BY_LINE.schema))
    run(spark, landed, cfg, "speed_by_line")  # resumes from the checkpoint; nothing is new
    spec = schemas.SPEED_BY_LINE
    assert rows_of(read_table(spark, cfg.table(spec), spec.schema)) == first
    events = motion.plausible(motion.speed_events(read_positions(spark, "parquet", landed))).where(passed(spark, landed))
    expected = events.groupBy("linha").agg(*motion.speed_summary(), F.max("event_time").alias("ultima_atualizacao"))
    assert first == rows_of(expected)


def test_late_reports_miss_windows_but_not_state(spark, reports, tmp_path):
    folder = str(tmp_path / "in")
    on_time = [{"p": 1, "at": 0}, {"p": 1, "at": 60, "km": 0.5}, {"p": 2, "at": 600}]
    late = [{"p": 1, "at": 30, "km": 0.2, "id": 50}, {"p": 3, "at": 10, "id": 51}]
    passing = [{"p": 2, "at": 900, "id": 40}]  # a batch in which the watermark moves past the late reports
    after = [{"p": 2, "at": 1200, "id": 60}]
    for part in (on_time, passing, late, after):
        reports(part).coalesce(1).write.mode("append").parquet(folder)
    cfg = config(tmp_path)
    run(spark, folder, cfg, "speed_history", "active_vehicles")
    history = read_history(spark, cfg.table(schemas.SPEED_HISTORY), schemas.SPEED_HISTORY).collect()
    assert [r.velocidade_media for r in history if r.janela_inicio.minute == 1] == [30.0]
    active = read_table(spark, cfg.table(schemas.ACTIVE_VEHICLES), schemas.ACTIVE_VEHICLES.schema).first()
    assert active.total_onibus_ativos == 3


def test_newest_by_state_runs_in_update_mode(spark, landed, tmp_path):
    source = read_positions(spark, "parquet", landed, streaming=True, maxFilesPerTrigger="1")
    newest = newest_by_state(fleet.as_position_rows(source), ["prefixo"], ["ultima_atualizacao", "event_id"])
    seen = []
    query = (
        newest.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c"))
        .foreachBatch(lambda df, n: seen.append({r.prefixo: r for r in df.collect()})).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    final = {}
    for update in seen:
        final |= update
    expected = fleet.latest_position(read_positions(spark, "parquet", landed)).collect()
    assert {k: r.ultima_atualizacao for k, r in final.items()} == {r.prefixo: r.ultima_atualizacao for r in expected}


def test_log_metric_streams(spark, tmp_path):
    logs = derived.log_stream(spark, SMALL).withWatermark("ts", "2 seconds")
    query = (
        lm.over_time(logs, "1h", ["container"]).writeStream.format("parquet").option("path", str(tmp_path / "o"))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "o"))
    batch = lm.over_time(derived.logs(spark, SMALL), "1h", ["container"])
    assert stored.exceptAll(batch).count() == 0 and batch.exceptAll(stored).count() <= 5


def test_payload_files_stream_into_reports(spark, tmp_path):
    folder = tmp_path / "polls"
    folder.mkdir()
    for i in range(3):
        vehicle = {"p": i, "a": False, "ta": "2024-03-01T11:00:00Z", "py": 1.0, "px": 2.0}
        line = {"c": "A", "cl": 1, "sl": 1, "lt0": "T", "lt1": "O", "qv": 1, "vs": [vehicle]}
        (folder / f"{i}.json").write_text(json.dumps({"l": [line]}, indent=1))
    query = (
        feed.flatten_feed(feed.read_payload_stream(spark, str(folder))).writeStream.format("parquet")
        .option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.p for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [0, 1, 2]
