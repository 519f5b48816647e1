"""Log panels as continuous queries in append mode.

Lines are counted in bins one step wide, which the watermark closes; a range longer than a step is a second aggregation over
the closed bins' times, in the same query. A row is written once, when the watermark has passed the end of its range. State
is one row per label set for every open bin and range, whatever the number of lines.

Time goes on with *all* lines: what a panel wants is a condition inside the first aggregation. A filter before it would be
pushed below the watermark, and the ranges of a quiet container would stay open until its own next line.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.operators import logmetrics as lm
from fleetlens.operators import sketches
from fleetlens.plans.panels import CHECKPOINT_MS, JOB_NAME, PANELS, SERIES, Panel
from fleetlens.session import SETTINGS
from fleetlens.streaming.jobs import STATE_STORE, JobConfig
from fleetlens.streaming.steps import at_every_step

DELAY = "2 seconds"
TIMES = ("window_start", "window_end")


def _ranges(logs: DataFrame, span: str, by: Sequence[str], step: str | None, wanted: Column | None) -> DataFrame:
    """``window``, ``entries`` and ``volume`` of every label set and closed range that has wanted lines."""
    width, stride = lm.seconds_of(span), lm.seconds_of(step or span)
    if width % stride:
        raise ValueError("the range must be a whole number of steps")
    wanted = F.lit(True) if wanted is None else wanted
    bins = logs.groupBy(*by, F.window("ts", f"{stride} seconds")).agg(
        F.count_if(wanted).alias("entries"), F.sum(F.when(wanted, F.octet_length("line"))).alias("volume")).where("entries > 0")
    if width == stride:
        return bins
    closed = bins.select(*by, F.window_time("window").alias("at"), "entries", "volume")
    return closed.groupBy(*by, F.window("at", f"{width} seconds", f"{stride} seconds")).agg(
        F.sum("entries").alias("entries"), F.sum("volume").alias("volume"))


def over_time(logs: DataFrame, span: str, by: Sequence[str] = (), step: str | None = None, wanted: Column | None = None) -> DataFrame:
    """Streaming twin of ``logmetrics.over_time``; ``logs`` carry a watermark on ``ts``."""
    found = _ranges(logs, span, by, step, wanted)
    return found.select(*by, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "entries", "volume")


def label_sets(logs: DataFrame, span: str, by: Sequence[str], step: str | None = None, wanted: Column | None = None) -> DataFrame:
    """Streaming twin of ``logmetrics.label_sets``: a third aggregation counts the label sets of each closed range."""
    # A range goes on as numbers: a stream has one event-time column, here the time of the closed range.
    found = _ranges(logs, span, by, step, wanted).select(
        F.window_time("window").alias("at"), F.unix_seconds("window.start").alias("start"), F.unix_seconds("window.end").alias("end"))
    counted = found.groupBy(F.window("at", f"{lm.seconds_of(step or span)} seconds"), "start", "end").agg(F.count(F.lit(1)).alias("value"))
    return counted.select(F.timestamp_seconds("start").alias("window_start"), F.timestamp_seconds("end").alias("window_end"), "value")


def run_panel(logs: DataFrame, panel: Panel, delay: str = DELAY) -> DataFrame:
    """The panel's metric of a stream of lines, with the columns of ``panels.run_panel``; quantiles come from sketches."""
    timed = logs.withWatermark("ts", delay)
    wanted = lm.condition(panel.equal, panel.matching, panel.line)
    span, step, measure = panel.span, panel.step, panel.measure
    if measure == "lines":
        return timed.where(wanted).select("ts", "container", "stream", "line")
    if measure in ("live_containers", "series"):
        return label_sets(timed, span, ["container"] if measure == "live_containers" else SERIES, step, wanted)
    if measure == "jobs":
        named = timed.withColumn("job_name", F.regexp_extract("line", JOB_NAME, 1))
        return label_sets(named, span, ["job_name"], step, wanted & (F.col("job_name") != ""))
    if measure == "checkpoint_p95":
        return sketches.quantiles(sketches.value_sketches(timed, CHECKPOINT_MS, span, SERIES, wanted), 0.95, SERIES)
    if measure == "entries_by_series":
        return over_time(timed, span, SERIES, step, wanted).select(*SERIES, *TIMES, F.col("entries").alias("value"))

    by = ["container"] if measure.endswith("_by_container") else []
    amount = "volume" if measure.startswith("bytes") else "entries"
    per_second = measure in ("rate", "rate_by_container", "bytes_by_container")

    def shown(column):
        return lm.per_second(column, span) if per_second else column

    metric = over_time(timed, span, by, step, wanted).select(*by, *TIMES, shown(F.col(amount)).alias("value"))
    if panel.default is None:
        return metric
    # Steps are those of all lines: a bin that has any, with what of them the panel wants.
    width = lm.seconds_of(span)
    size = F.octet_length("line") if amount == "volume" else F.lit(1)
    counted = timed.groupBy(F.window("ts", f"{width} seconds")).agg(F.sum(F.when(wanted, size)).alias("amount"))
    value = F.lit(None) if by else shown(F.col("amount"))
    steps = at_every_step(counted, value, width, panel.default)
    kind = "double" if per_second else "long"
    steps = steps.withColumn("value", F.col("value").cast(kind))
    if not by:
        return steps
    return metric.unionByName(steps.withColumn("container", F.lit(None).cast("string")))


def start_logs(spark: SparkSession, source: Callable[[], DataFrame], cfg: JobConfig, names: Sequence[str] = tuple(PANELS)) -> dict[str, StreamingQuery]:
    """Start panels side by side; each appends its rows to the Parquet table ``<tables>/<name>``."""
    spark.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    return {name: append_panel(run_panel(source(), PANELS[name]), cfg, name) for name in names}


def append_panel(rows: DataFrame, cfg: JobConfig, name: str) -> StreamingQuery:
    return (
        rows.writeStream.queryName(name).outputMode("append").format("parquet").option("path", f"{cfg.tables}/{name}")
        .option("checkpointLocation", f"{cfg.checkpoints}/{name}").trigger(**dict(cfg.trigger)).start()
    )
