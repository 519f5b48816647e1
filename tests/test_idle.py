"""Watermarks of sources whose partitions lag, stop and wake."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fleetlens.operators.upsert import read_history, read_table
from fleetlens.streaming import idle, jobs, ordered
from tests.conftest import START

ARRIVALS = "source_partition int, event_time timestamp, arrived timestamp"
ZERO = datetime(2024, 1, 1)


def at(seconds):
    return ZERO + timedelta(seconds=seconds)


def plain_marks(arrivals, poll, delay, silence):
    """The rule, one poll after the other."""
    polls = sorted({a // poll * poll for _, _, a in arrivals})
    newest, seen, mark, out = {}, {}, None, []
    for start in polls:
        now = [(p, e, a) for p, e, a in arrivals if a // poll * poll == start]
        late = sum(mark is not None and e <= mark for _, e, _ in now)
        for p, e, a in now:
            newest[p], seen[p] = max(e, newest.get(p, e)), max(a, seen.get(p, a))
        active = [p for p in newest if start + poll - seen[p] <= silence]
        if active:
            least = min(newest[p] for p in active) - delay
            mark = least if mark is None else max(mark, least)
        out.append((at(start + poll), None if mark is None else at(mark), len(active), len(newest) - len(active), len(now), late))
    return out[:-1]


def test_marks_do_not_depend_on_micro_batches(spark, tmp_path):
    arrivals = [(0, t, t) for t in range(0, 600, 7)]
    arrivals += [(1, t, t + 40) for t in range(0, 500, 11)]  # lags
    arrivals += [(2, t, t) for t in range(0, 200, 13)]  # stops
    arrivals += [(3, t, 400) for t in range(100, 300, 9)] + [(3, t, t) for t in range(420, 600, 9)]  # wakes late
    arrivals.sort(key=lambda r: (r[2], r[0], r[1]))
    expected = plain_marks(arrivals, 15, 2, 50)
    assert sum(row[5] for row in expected) > 10 and {row[3] for row in expected} >= {0, 1}
    for files in (1, 4, 9):
        folder, home = str(tmp_path / f"in{files}"), tmp_path / f"out{files}"
        size = -(-len(arrivals) // files)
        for i in range(files):
            rows = [(p, at(e), at(a)) for p, e, a in arrivals[i * size:(i + 1) * size]]
            spark.createDataFrame(rows, ARRIVALS).coalesce(1).write.mode("append").parquet(folder)
        cfg = jobs.JobConfig(str(home / "t"), str(home / "c"), (("availableNow", True),), idle_seconds=50)
        source = spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", 1).parquet(folder)
        query = jobs.source_marks_job(source, cfg)
        query.awaitTermination()
        stored = read_history(spark, cfg.table(idle.MARKS), idle.MARKS).select(*idle.MARKS.columns)
        assert sorted(tuple(r) for r in stored.collect()) == expected
        state = read_table(spark, f"{cfg.tables}/source_marks_state", idle.STATE)
        assert state.count() == 4 + 1 + state.where("role = 'open'").count()


def step(reports, state, rows, now, idle_us=5_000_000):
    """One micro-batch; a row is (partition, seconds)."""
    spark = state.sparkSession
    batch = reports([{"p": p, "at": s, "id": (p << ordered.PARTITION_SHIFT) + s} for p, s in rows]) if rows else spark.createDataFrame([], jobs.schemas.POSITIONS)
    found = ordered.advance(batch, state, 2_000_000, idle_us, now * 1_000_000)
    passed = sorted((r.event_time - START).seconds for r in found.rows.collect())
    return spark.createDataFrame(found.state.collect(), ordered.STATE), passed, found.mark / 1e6 - START.timestamp()


def test_ordered_rows_wait_for_lagging_partitions_but_not_for_silent_ones(spark, reports):
    empty = spark.createDataFrame([], ordered.STATE)
    state, passed, mark = step(reports, empty, [(0, 100), (1, 40)], 0)
    assert passed == [] and mark % 3600 == 38 % 3600
    # Partition 1 lags: reports of it up to 40 s are not lost, and those of partition 0 wait.
    state, passed, mark = step(reports, state, [(0, 115), (1, 55)], 4)
    assert passed == [40] and mark % 3600 == 53
    # Partition 1 has been silent for longer than the timeout.
    state, passed, mark = step(reports, state, [(0, 130)], 10)
    assert passed == [55, 100, 115] and mark % 3600 == 128
    # It wakes with an old report, which is late, and the watermark stays; a new one counts again.
    state, passed, mark = step(reports, state, [(0, 145), (1, 60)], 12)
    assert passed == [] and mark % 3600 == 128
    state, passed, mark = step(reports, state, [(0, 160), (1, 150)], 14)
    assert passed == [130, 145] and mark % 3600 == 148
    sources = {r.event_id: (r.event_time - START).seconds for r in state.where(F.col("role") == ordered.SOURCE).collect()}
    assert sources == {0: 160, 1: 150}


def test_without_a_timeout_every_partition_holds_the_watermark(spark, reports):
    empty = spark.createDataFrame([], ordered.STATE)
    state, _, _ = step(reports, empty, [(0, 100), (1, 40)], 0, None)
    _, passed, mark = step(reports, state, [(0, 500)], 3600, None)
    assert passed == [] and mark % 3600 == 38
