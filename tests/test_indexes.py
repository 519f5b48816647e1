"""Stored indexes of points and of label sets, and one reader for all jobs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.operators import logindex, spatial
from fleetlens.operators import logmetrics as lm
from fleetlens.operators.upsert import read_history, read_table
from fleetlens.schemas import LOGS
from fleetlens.sources import derived
from fleetlens.sources.positions import read_positions
from fleetlens.streaming import jobs
from tests.conftest import SMALL, rows_of
from tests.test_operators import brute_nearest

AT = ["a", "b"]


def scene(seed):
    rng = random.Random(seed)
    centres = [(0.0, 0.0), (-23.5, -46.6), (0.004, -0.004), (51.2, 7.1)]
    points = [(f"s{n % 7}", lat + rng.gauss(0, 0.004), lon + rng.gauss(0, 0.004), float(n)) for n, (lat, lon) in enumerate(centres * 60)]
    points += [points[0]] * 5 + [("s9", points[3][1], points[3][2], -1.0)]
    spots = [(rng.uniform(-0.03, 0.03), rng.uniform(-0.03, 0.03)) for _ in range(60)] + [(p[1], p[2]) for p in points[:20]]
    spots += [(points[8][1] + 0.01, points[8][2] - 0.01), (50.0, 50.0)]
    return points, [(i, lat, lon) for i, (lat, lon) in enumerate(spots)]


def found_in(spark, index, left):
    rows = spatial.nearest_point(spark.createDataFrame([*left, (999, None, 1.0)], "k int, la double, lo double"), index, ["la", "lo"], "v")
    return {r.k: r.v for r in rows.collect()}


@pytest.mark.parametrize("levels", [None, 1, 3])
def test_stored_points_give_the_nearest(spark, tmp_path, levels):
    points, left = scene(1)
    frame = spark.createDataFrame([*points, ("s0", None, 0.0, 5.0)], "s string, a double, b double, v double")
    index = spatial.build(frame, AT, "v", "s", 0.01, str(tmp_path / "i"), levels)
    assert spatial.opened(spark, str(tmp_path / "i")) == index and spatial.opened(spark, str(tmp_path / "none")) is None
    assert found_in(spark, index, left) == {**brute_nearest(left, [p[1:] for p in points], 0.01), 999: None}


def test_refresh_writes_only_touched_tiles(spark, tmp_path):
    points, left = scene(2)
    schema = "s string, a double, b double, v double"
    index = spatial.build(spark.createDataFrame(points, schema), AT, "v", "s", 0.01, str(tmp_path / "i"))

    def files():
        return {f.name for f in (tmp_path / "i" / "points").rglob("*.parquet")}

    before = files()
    # One shape moves, one goes, and a new one stands alone far away.
    gone, moved = "s2", [("s1", 0.002, 0.002, 70.0), ("s1", 0.021, 0.021, 71.0), ("new", 10.0, 10.0, 72.0)]
    changed = spark.createDataFrame(moved, schema)
    owners = spark.createDataFrame([("s1",), (gone,), ("new",)], "owner string")
    left.append((500, 10.001, 10.001))
    expected = [p for p in points if p[0] not in ("s1", gone)] + moved
    for _ in range(2):  # the second time changes nothing
        spatial.refresh(index, changed, owners, AT, "v", "s")
        assert found_in(spark, index, left) == {**brute_nearest(left, [p[1:] for p in expected], 0.01), 999: None}
    # A shape that goes leaves no empty tile behind, and tiles of other shapes were not written.
    spatial.refresh(index, changed.limit(0), owners.where("owner = 'new'"), AT, "v", "s")
    assert found_in(spark, index, left[-1:]) == {500: None, 999: None}
    far = spark.createDataFrame([("far", -60.0, 100.0, 1.0)], schema)
    kept = files()
    spatial.refresh(index, far, far.selectExpr("s AS owner"), AT, "v", "s")
    assert kept < files() and before & files() != before


def test_searches_read_the_tiles_around_their_locations(spark, tmp_path):
    points, _ = scene(3)
    index = spatial.build(spark.createDataFrame(points, "s string, a double, b double, v double"), AT, "v", "s", 0.01, str(tmp_path / "i"))
    spot = spark.createDataFrame([(1, 51.2, 7.1)], "k int, la double, lo double")
    plan = spatial.nearest_point(spot, index, ["la", "lo"], "v")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^]]*tile#\d+L? (IN|=)", plan)) >= 2
    tiles = len(list((tmp_path / "i" / "points").glob("tile=*")))
    row = spark.createDataFrame([(51.2, 7.1)], "slat double, slon double")
    near = {r[0] for r in spatial.nearest.coarse_blocks(row, index.finest, index.levels).select(
        spatial._tile(F.col("pi"), F.col("pj"), spatial.TILE_BITS)).collect()}
    assert tiles > 4 and len(near) <= 4


def test_curve_keys_are_the_bits_of_both_cells_in_turn(spark):
    rows = spark.createDataFrame([(i * 37 % 1024 - 512, i * 91 % 1024 - 512) for i in range(300)], "ci long, cj long")
    for r in rows.withColumn("key", spatial.curve_key(F.col("ci"), F.col("cj"), 10)).collect():
        bits = sum((((r.ci >> k) & 1) << (2 * k + 1)) | (((r.cj >> k) & 1) << (2 * k)) for k in range(10))
        assert r.key == bits


def test_label_index_reaches_lines_through_their_bucket(spark, tmp_path):
    path, logs = str(tmp_path / "l"), derived.logs(spark, SMALL)
    odd = spark.createDataFrame([(None, None, "no labels"), ("", "stdout", "empty label"), ("kafka", None, "no stream")],
                                "container string, stream string, line string").withColumn("ts", F.lit("2024-01-15 10:00:00").cast("timestamp"))
    early = F.col("ts") < "2024-01-15"
    logindex.append_logs(logs.where(early), path)
    logindex.append_logs(logs.where(~early).unionByName(odd), path)
    everything = logs.unionByName(odd).select("ts", "container", "stream", "line")
    sets = logindex.label_sets(spark, path)
    assert sets.count() == everything.select("container", "stream").distinct().count()
    assert rows_of(logindex.read_logs(spark, path)) == rows_of(everything)
    for wanted in ({"matching": {"container": ".*kafka.*|.*python.*"}}, {"equal": {"container": "kafka", "stream": "stderr"}},
                   {"equal": {"container": ""}}, {"equal": {"container": "nothing"}}, {"line_regex": "(?i)partition"}):
        assert rows_of(logindex.read_logs(spark, path, **wanted)) == rows_of(lm.select_logs(everything, **wanted))
    since, until = "2024-01-10 06:30:00", "2024-01-20 18:00:00"
    some = logindex.read_logs(spark, path, {"container": "kafka"}, since=since, until=until)
    assert rows_of(some) == rows_of(lm.select_logs(everything, {"container": "kafka"}).where(f"ts >= '{since}' AND ts < '{until}'"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and re.search(r"PartitionFilters: \[[^]]*day", plan)


def landed(spark, folder, files=3):
    rows = derived.positions(spark, SMALL).orderBy("event_time", "event_id").collect()
    size = -(-len(rows) // files)
    for i in range(files):
        spark.createDataFrame(rows[i * size:(i + 1) * size], schemas.POSITIONS).coalesce(1).write.mode("append").parquet(folder)
    return lambda: read_positions(spark, "parquet", folder, streaming=True, maxFilesPerTrigger="1")


def tables_of(spark, cfg):
    out = {}
    for spec in schemas.TABLES.values():
        stored = read_history(spark, cfg.table(spec), spec).drop("window_date") if spec.updated in spec.keys else read_table(
            spark, cfg.table(spec), spec.schema)
        out[spec.name] = rows_of(stored.select(*spec.columns))
    return out


def test_one_reader_feeds_all_jobs_and_a_repeat_runs_the_unfinished(spark, tmp_path, monkeypatch):
    source = landed(spark, str(tmp_path / "in"))

    def config(name):
        return jobs.JobConfig(str(tmp_path / name / "t"), str(tmp_path / name / "c"), (("availableNow", True),))

    apart, together = config("apart"), config("together")
    for query in set(jobs.start_all(spark, source, apart).values()):
        query.awaitTermination()
    runs, broken = [], [True]
    for name, job in jobs.UNORDERED.items():
        def counted(cfg, name=name, job=job):
            body = job(cfg)

            def run(rows, batch):
                runs.append((batch.number, name))
                if name == "line_catalogue" and batch.number == 1 and broken:
                    broken.clear()
                    raise RuntimeError("lost half way")
                body(rows, batch)

            return run

        monkeypatch.setitem(jobs.UNORDERED, name, counted)
    with pytest.raises(Exception, match="lost half way"):
        jobs.start_together(source(), together).awaitTermination()
    query = jobs.start_together(source(), together)
    query.awaitTermination()
    # Batch 1 ran twice, but only the job that had not finished did.
    assert sorted(runs) == sorted([(n, name) for n in range(3) for name in jobs.UNORDERED] + [(1, "line_catalogue")])
    # Each micro-batch is read once for all jobs.
    rows = derived.positions(spark, SMALL).count()
    assert sum(p["numInputRows"] for p in query.recentProgress) <= rows
    assert max(p["numInputRows"] for p in query.recentProgress) <= -(-rows // 3)
    assert tables_of(spark, together) == tables_of(spark, apart)
    assert len(list((tmp_path / "together" / "t" / "_ledger").iterdir())) == 1
