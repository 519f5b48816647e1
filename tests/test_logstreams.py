"""Log panels as streams over several micro-batches, and sketches merged from bins."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import logmetrics as lm
from fleetlens.operators import sketches
from fleetlens.plans import fleet, panels
from fleetlens.schemas import LOGS
from fleetlens.sources import derived
from fleetlens.sources.positions import read_positions
from fleetlens.streaming import jobs, logstreams
from tests.conftest import SMALL, rows_of

BASE = datetime(2024, 1, 1)


def landed(spark, rows, folder, files):
    size = -(-len(rows) // files)
    for i in range(files):
        spark.createDataFrame(rows[i * size:(i + 1) * size], LOGS).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(LOGS).option("maxFilesPerTrigger", 1).parquet(folder)


def streamed(spark, rows, tmp_path, name="p"):
    spark.conf.set(jobs.STATE_STORE, jobs.SETTINGS[jobs.STATE_STORE])
    cfg = jobs.JobConfig(str(tmp_path / "t"), str(tmp_path / "c"), (("availableNow", True),))
    query = logstreams.append_panel(rows, cfg, name)
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{cfg.tables}/{name}"), query.recentProgress


@pytest.fixture(scope="module")
def lines():
    """Lines in time order with quiet hours, a rare container and a gap of a day."""
    rng, at, out = random.Random(3), 0, []
    for i in range(400):
        at += rng.choice([1, 5, 20, 90, 700]) if i != 250 else 86_400
        container = rng.choice(["kafka"] * 5 + ["flink-jobmanager"] * 3 + ["schema-registry"])
        text = rng.choice(["Checkpoint 1 completed in %d ms" % rng.randint(1, 900), "FatalError", "HTTP GET", "ação"])
        out.append((BASE + timedelta(seconds=at), container, rng.choice(["stdout", "stderr"]), text))
    return out


def closed(spark, lines, metric):
    mark = max(r[0] for r in lines) - timedelta(seconds=2)
    return metric.where(F.col("window_end") <= F.lit(mark))


CASES = {
    "sliding": panels.Panel("rate", "10m", matching={"container": ".*kafka.*"}, step="2m"),
    "bytes": panels.Panel("bytes_by_container", "30m", step="10m"),
    "containers": panels.Panel("live_containers", "1h", step="20m"),
    "series": panels.Panel("entries_by_series", "1h", equal={"container": "schema-registry"}),
    "default": panels.Panel("entries", "5m", line="FatalError", default=18),
    "default_rate": panels.Panel("rate_by_container", "5m", equal={"container": "kafka"}, default=0),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("files", [1, 5])
def test_panels_as_streams_equal_the_batch_up_to_the_watermark(spark, lines, tmp_path, name, files):
    panel = CASES[name]
    source = landed(spark, lines, str(tmp_path / "in"), files)
    stored, progress = streamed(spark, logstreams.run_panel(source, panel), tmp_path)
    batch = panels.run_panel(spark.createDataFrame(lines, LOGS), panel)
    assert stored.count() > 5
    assert rows_of(stored.select(sorted(stored.columns))) == rows_of(closed(spark, lines, batch).select(sorted(stored.columns)))
    # State is open bins and ranges, not lines.
    assert sum(o.numRowsTotal for o in progress[-1].stateOperators) <= 60


def test_gaps_are_sent_as_one_row_and_timers_rearm(spark, tmp_path):
    """A day and a year without lines: the operator sends a row for each gap, and all steps come out once."""
    rows = [(BASE, "a", "s", "x"), (BASE + timedelta(hours=1), "a", "s", "y"), (BASE + timedelta(days=366), "a", "s", "x"),
            (BASE + timedelta(days=366, minutes=11), "a", "s", "y")]
    source = landed(spark, rows, str(tmp_path / "in"), 4)
    stored, _ = streamed(spark, logstreams.run_panel(source, panels.Panel("entries", "5m", line="x", default=7)), tmp_path)
    steps = 366 * 288 + 2
    got = stored.agg(F.count("*").alias("n"), F.count_distinct("window_start").alias("d"), F.sum("value").alias("s")).first()
    assert (got.n, got.d, got.s) == (steps, steps, 7 * (steps - 2) + 2)


def test_start_logs_runs_panels_side_by_side(spark, lines, tmp_path):
    names = ("kafka_log_bytes", "registry_http", "flink_checkpoint_p95")
    landed(spark, lines, str(tmp_path / "in"), 2)
    cfg = jobs.JobConfig(str(tmp_path / "t"), str(tmp_path / "c"), (("availableNow", True),))
    queries = logstreams.start_logs(spark, lambda: spark.readStream.schema(LOGS).parquet(str(tmp_path / "in")), cfg, names)
    for query in queries.values():
        query.awaitTermination()
        assert query.exception() is None
    assert all(spark.read.parquet(f"{cfg.tables}/{name}").count() > 0 for name in names)


def test_sketches_merge_within_their_bounds(spark):
    rng = random.Random(1)
    values = [int(rng.lognormvariate(5, 1)) for _ in range(30_000)]
    rows = [(BASE + timedelta(seconds=i % 3600), "c", "s", f"completed in {v} ms") for i, v in enumerate(values)]
    logs = spark.createDataFrame(rows + [(BASE, "c", "s", "completed in x ms"), (BASE, "d", "s", "nothing")], LOGS)
    bins = sketches.stored(sketches.value_sketches(logs, panels.CHECKPOINT_MS, "1m", ["container"]))
    assert bins.count() == 60 and max(len(r.sketch) for r in bins.collect()) < 8000
    values.sort()
    for share in (0.05, 0.5, 0.95):
        row, = sketches.merged_quantiles(bins, share, "1h", ["container"]).collect()
        below, upto = sum(v < row.value for v in values), sum(v <= row.value for v in values)
        assert below / len(values) - share <= sketches.RANK_ERROR and share - upto / len(values) <= sketches.RANK_ERROR


def test_vehicle_sketches_unite_to_any_span(spark, tmp_path):
    seen = derived.positions(spark, SMALL)
    bins = sketches.stored(sketches.vehicle_sketches(seen))
    exact = {r.linha: r.total_onibus_ativos for r in fleet.active_vehicles(seen).collect()}
    about = {r.linha: r.total_onibus_ativos for r in sketches.active_vehicles(bins).collect()}
    assert exact.keys() == about.keys() and all(abs(about[k] - exact[k]) <= 1 + sketches.COUNT_ERROR * exact[k] for k in exact)
    newest = bins.agg(F.max("bin_end")).first()[0]
    recent = seen.where(F.col("event_time") >= F.lit(newest) - F.expr("INTERVAL 2 HOURS")).groupBy("c").agg(F.count_distinct("p").alias("n"))
    assert {r.linha: r.total_onibus_ativos for r in sketches.active_within(bins, "2h").collect()} == {r.c: r.n for r in recent.collect()}
    large = spark.range(200_000).selectExpr("'A' AS c", "cast(id % 50000 AS int) AS p", "timestamp_seconds(1704067200 + id % 7200) AS event_time")
    merged = sketches.active_vehicles(sketches.stored(sketches.vehicle_sketches(large)), "1h")
    counts = {r.w.start: r.n for r in large.groupBy(F.window("event_time", "1 hour").alias("w")).agg(F.count_distinct("p").alias("n")).collect()}
    assert len(counts) == 2 and min(counts.values()) > 20_000
    assert all(abs(r.total_onibus_ativos - counts[r.window_start]) <= sketches.COUNT_ERROR * counts[r.window_start] for r in merged.collect())
    # The stream keeps the same bins beside job 1.
    derived.positions(spark, SMALL).coalesce(1).write.parquet(str(tmp_path / "in"))
    cfg = jobs.JobConfig(str(tmp_path / "t"), str(tmp_path / "c"), (("availableNow", True),))
    jobs.vehicle_sketches_job(read_positions(spark, "parquet", str(tmp_path / "in"), streaming=True), cfg).awaitTermination()
    kept = spark.read.parquet(f"{cfg.tables}/vehicle_sketches")
    keys = ["linha", "bin_start", "bin_end", "ultima_atualizacao"]
    assert kept.count() >= bins.count() - 1 and kept.select(keys).exceptAll(bins.select(keys)).count() == 0
