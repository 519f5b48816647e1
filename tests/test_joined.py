"""Append streams joined by time, and expiry of what silent vehicles leave behind."""

import random

import pytest
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.operators.upsert import read_table
from fleetlens.plans import headway
from fleetlens.sources import derived
from fleetlens.sources.positions import read_positions, watermarked
from fleetlens.streaming import jobs, joined, ordered
from fleetlens.streaming.lag_state import BUCKETS, stream_lag
from tests.conftest import SMALL, START, rows_of


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")
    rows = derived.positions(spark, SMALL).orderBy("event_time", "event_id").collect()
    rng = random.Random(7)
    for i in range(3):
        part = rows[i * 334:(i + 1) * 334]
        rng.shuffle(part)
        spark.createDataFrame(part, schemas.POSITIONS).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def appended(spark, rows, tmp_path):
    """Run a stream into a Parquet sink; its rows, and its progress by micro-batch."""
    spark.conf.set(jobs.STATE_STORE, jobs.SETTINGS[jobs.STATE_STORE])
    query = rows.writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(str(tmp_path / "o")), query.recentProgress


def source_of(spark, folder):
    return read_positions(spark, "parquet", folder, streaming=True, maxFilesPerTrigger="1")


def passed_by(spark, folder):
    mark = read_positions(spark, "parquet", folder).agg(F.max("event_time")).first()[0]
    return F.col("event_time") <= F.date_trunc("millisecond", F.lit(mark)) - F.expr("INTERVAL 2 SECONDS")


@pytest.mark.parametrize("name", ["headway_events", "motion_with_gaps"])
def test_joined_streams_over_batches(spark, landed, tmp_path, name):
    stored, progress = appended(spark, getattr(joined, name)(source_of(spark, landed)), tmp_path)
    expected = getattr(headway, name)(read_positions(spark, "parquet", landed)).where(passed_by(spark, landed))
    columns = expected.columns
    assert stored.count() > 50 and rows_of(stored.select(columns)) == rows_of(expected)
    join = [o for p in progress for o in p.stateOperators if o.operatorName == "symmetricHashJoin"]
    # Every report goes through the join's state, and the watermark takes it out again.
    assert len(join) >= 3 and sum(o.numRowsUpdated for o in join) >= stored.count()
    assert join[-1].numRowsTotal <= 4


def plain_lag(rows, key, ttl):
    """(p, at) -> place of the previous row of its key, unless it is more than ``ttl`` seconds older."""
    last, out = {}, {}
    for row in sorted(rows, key=lambda r: r["at"]):
        before = last.get(row[key])
        out[row["p"], row["at"]] = None if before is None or ttl is not None and row["at"] - before["at"] > ttl else before["at"]
        last[row[key]] = row
    return out


@pytest.mark.parametrize("ttl", [None, 100])
@pytest.mark.parametrize("slot", [60, 3600])
def test_lag_streams_forget_silent_keys(spark, reports, tmp_path, ttl, slot):
    times = {1: [0, 60, 160, 261, 700], 2: [5, 105, 400, 500], 3: [10]}
    rows = [{"p": p, "at": t} for p, ts in times.items() for t in ts] + [{"p": 9, "at": t} for t in (650, 1500)]
    rows.sort(key=lambda r: r["at"])
    for i in range(0, len(rows), 4):
        reports(rows[i:i + 4]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = stream_lag(watermarked(source_of(spark, str(tmp_path / "in"))), ["p"], ["py"], {"was": "event_time"}, slot, tie="event_id", ttl_seconds=ttl)
    stored, progress = appended(spark, out, tmp_path)
    got = {(r.p, (r.event_time - START).seconds): None if r.was is None else (r.was // 1_000_000) - int(START.timestamp()) for r in stored.collect()}
    want = {k: v for k, v in plain_lag(rows, "p", ttl).items() if k[1] < 1498}
    offset = {a: None if w is None else w - g for (a, g), w in zip(got.items(), [want[k] for k in got]) if g is not None}
    assert set(got) == set(want) and all((got[k] is None) == (want[k] is None) for k in want)
    assert len(set(offset.values())) == 1
    kept = [sum(o.numRowsTotal for o in p.stateOperators) for p in progress]
    if ttl is not None:
        # The watermark is at 1498: all keys but the last one's slot are forgotten.
        assert kept[-1] <= 6


def test_lag_streams_keep_state_by_bucket(spark, reports, tmp_path):
    """Many keys share few state entries, and numbers come out whole beside NULLs."""
    big = 2**60
    rows = [{"id": big + 3 * p + i, "p": p, "at": 10 * i + p % 7, "py": float(p)} for p in range(600) for i in range(2)]
    known = reports([*rows, {"id": 1, "p": 9, "at": 3700}, {"id": 2, "p": 8, "at": 3900}])
    for name, part in (("a", known.where("event_id <> 2")), ("b", known.where("event_id = 2"))):
        # Every seventh vehicle has no number, and every fifth report no place.
        part.withColumn("p", F.expr("if(p % 7 = 0, NULL, p)")).withColumn("py", F.expr("if(event_id % 5 = 0, NULL, py)")).coalesce(
            1).write.mode("append").parquet(str(tmp_path / "in"))
    found = {"was_id": "event_id", "was_py": "py", "was": "event_time"}
    out = stream_lag(watermarked(source_of(spark, str(tmp_path / "in"))), ["p"], ["py"], found, 3600)
    stored, progress = appended(spark, out, tmp_path)
    everything = read_positions(spark, "parquet", str(tmp_path / "in"))
    order = "OVER (PARTITION BY p ORDER BY event_time, event_id)"
    expected = everything.selectExpr(
        "p", "py", "event_id", f"lag(event_id) {order} AS was_id", f"lag(py) {order} AS was_py",
        f"unix_micros(lag(event_time) {order}) AS was", "event_time").where(passed_by(spark, str(tmp_path / "in")))
    assert stored.count() == 1201 and rows_of(stored) == rows_of(expected)
    lag = [o for p in progress for o in p.stateOperators if o.operatorName.startswith("transformWithState")]
    assert 0 < max(o.numRowsTotal for o in lag) <= 4 * BUCKETS


@pytest.mark.parametrize("ttl", [None, 100])
def test_ordered_state_forgets_silent_vehicles_and_lines(spark, reports, tmp_path, ttl):
    rows = [{"p": 1, "at": 0, "c": "A"}, {"p": 1, "at": 90, "km": 1.0, "c": "A"}, {"p": 1, "at": 300, "km": 2.0, "c": "A"},
            {"p": 2, "at": 310, "km": 3.0, "c": "A"}, {"p": 2, "at": 600, "c": "B"}, {"p": 3, "at": 800, "c": "C"}]
    for row in rows:
        reports([{**row, "id": row["at"]}]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    cfg = jobs.JobConfig(str(tmp_path / "t"), str(tmp_path / "c"), (("availableNow", True),), ttl_seconds=ttl)
    jobs.ordered_jobs(source_of(spark, str(tmp_path / "in")), cfg, ("vehicle_status",)).awaitTermination()
    state = read_table(spark, f"{cfg.tables}/ordered_state", ordered.STATE).collect()
    held = {role: sorted(r.p for r in state if r.role == role) for role in (ordered.VEHICLE, ordered.LINE)}
    status = read_table(spark, cfg.table(schemas.VEHICLE_STATUS), schemas.VEHICLE_STATUS.schema)
    speed = {r.prefixo: r.velocidade_kmh for r in status.collect()}
    if ttl is None:
        assert held == {ordered.VEHICLE: [1, 2], ordered.LINE: [2, 2]}
        assert speed[1] > 0 and speed[2] > 0
    else:
        # Both vehicles were silent for longer before their last report, and nothing of the first is kept.
        assert held == {ordered.VEHICLE: [], ordered.LINE: []}
        assert speed == {1: 0.0, 2: 0.0}
