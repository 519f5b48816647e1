import pytest
from pyspark.sql import functions as F

from fleetlens.operators import logmetrics as lm
from fleetlens.plans import panels
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def logs(spark):
    lines = [
        ("2024-01-01 00:00:10", "kafka", "stdout", "partition 1 ok"), ("2024-01-01 00:00:50", "kafka", "stderr", "ISR ação"),
        ("2024-01-01 00:03:00", "kafka-ui", "stdout", "completed in 10 ms"), ("2024-01-01 00:03:05", "kafka-ui", "stdout", "completed in 30 ms"),
        ("2024-01-01 00:03:09", "kafka-ui", "stdout", "completed in x ms"),
    ]
    return spark.createDataFrame(lines, "ts string, container string, stream string, line string").withColumn("ts", F.to_timestamp("ts"))


def brief(df, *columns):
    return [(f"{r.window_end:%H:%M}", *[r[c] for c in columns]) for r in df.orderBy("window_end", *columns).collect()]


def test_label_regex_matches_the_whole_label(logs):
    assert lm.select_logs(logs, matching={"container": "kafka"}).count() == 2
    assert lm.select_logs(logs, matching={"container": "kafka|x"}).count() == 2
    assert lm.select_logs(logs, matching={"container": ".*kafka.*"}).count() == 5
    assert lm.select_logs(logs, line_regex="(?i)isr").count() == 1


def test_tumbling_and_bytes(logs):
    assert brief(lm.totals(lm.over_time(logs, "1m", ["container"])), "entries", "volume") == [("00:01", 2, 24), ("00:04", 3, 53)]


def test_sliding_range_counts_a_line_in_every_range_it_is_in(logs):
    sliding = lm.over_time(logs, "3m", step="1m")
    assert brief(sliding, "entries") == [("00:01", 2), ("00:02", 2), ("00:03", 2), ("00:04", 3), ("00:05", 3), ("00:06", 3)]


def test_range_must_be_whole_steps(logs):
    with pytest.raises(ValueError):
        lm.over_time(logs, "5m", step="2m")
    with pytest.raises(ValueError):
        lm.seconds_of("5 minutes")


def test_default_fills_empty_steps(logs):
    metric = lm.over_time(lm.select_logs(logs, line_regex="ISR"), "1m").select("window_start", "window_end", F.col("entries").alias("value"))
    assert brief(lm.or_default(metric, lm.steps_of(logs, "1m"), 18), "value") == [("00:01", 1), ("00:02", 18), ("00:03", 18), ("00:04", 18)]


def test_constant_stays_next_to_labelled_series(logs):
    rows = panels.run_panel(logs, panels.Panel("rate_by_container", "1m", equal={"container": "kafka"}, default=0))
    assert sorted((r.container or "", round(r.value, 4)) for r in rows.collect()) == [("", 0.0)] * 4 + [("kafka", round(2 / 60, 4))]


def test_quantile_interpolates_and_skips_lines_without_a_number(logs):
    row, = lm.quantile_over_time(logs, r"completed in ([0-9]+) ms", 0.95, "5m").collect()
    assert row.value == pytest.approx(29.0)


def test_series_and_containers(logs):
    assert brief(lm.label_sets(logs, "5m", ["container"]), "value") == [("00:05", 2)]
    assert brief(lm.label_sets(logs, "5m", ["container", "stream"]), "value") == [("00:05", 3)]


def test_empty_logs_have_no_steps(logs):
    assert lm.steps_of(logs.where("false"), "1m").count() == 0


@pytest.mark.parametrize("key", panels.PANELS)
def test_every_panel_runs(logs, key):
    assert panels.run_panel(logs, panels.PANELS[key]).columns


def test_steps_between_far_edges_are_made_in_parallel(spark):
    logs = spark.createDataFrame([("1970-01-01 00:00:10",), ("2024-01-01 00:00:00",)], "ts string").withColumn("ts", F.to_timestamp("ts"))
    steps = lm.steps_of(logs, "1h")
    assert steps.count() == 473353 and steps.rdd.getNumPartitions() > 1
    assert lm.steps_of(logs.where("false"), "1h").count() == 0
    assert [r.window_start.minute for r in lm.steps_of(logs, "1m", (30, 150)).orderBy("window_start").collect()] == [0, 1, 2]
