"""The log panels of the two dashboards, as parameters over :mod:`fleetlens.operators.logmetrics`."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.operators import logmetrics as lm


@dataclass(frozen=True)
class Panel:
    """One panel: which lines it reads, what it measures over which range, and its value when there are none."""

    measure: str
    span: str = ""
    equal: dict[str, str] = field(default_factory=dict)
    matching: dict[str, str] = field(default_factory=dict)
    line: str | None = None
    default: float | None = None
    step: str | None = None


_FLINK = {"container": ".*flink.*"}
_BROKER = {"container": ".*kafka.*|.*python.*"}
_BROKER_ALL = {"container": ".*kafka.*|.*python.*|.*schema-registry.*"}
_JOB_MANAGER = {"container": "flink-jobmanager"}
_KAFKA = {"container": "kafka"}
_REGISTRY = {"container": "schema-registry"}

# Selectors, line patterns, ranges and placeholders of the panels. Placeholders above zero are what the
# dashboards show for "no lines". The job-name class is written as intended; the sink names it matches are lower case.
JOB_NAME = r"Sink: (sink_[a-z_]+)"
CHECKPOINT_MS = r"completed in ([0-9]+) ms"
PANELS: dict[str, Panel] = {
    "flink_live_containers": Panel("live_containers", "24h", matching=_FLINK, step="1h"),
    "flink_running_jobs": Panel("jobs", "1h", equal=_JOB_MANAGER, line="(?i)Sink: sink_"),
    "flink_checkpoints": Panel("entries_by_series", "1h", equal=_JOB_MANAGER, line="(?i)(checkpoint|completed)"),
    "flink_checkpoint_p95": Panel("checkpoint_p95", "5m", equal=_JOB_MANAGER),
    "flink_failures": Panel(
        "entries", "5m", matching=_FLINK, default=0,
        line="(?i)(JobFailedException|JobAbortedException|FatalError|TaskException)",
    ),
    "flink_out_of_memory": Panel("entries", "5m", matching=_FLINK, line="(?i)(outofmemory|overflow)", default=0),
    "flink_throughput": Panel("rate", "1m", matching=_FLINK, default=0),
    "flink_rate_by_container": Panel("rate_by_container", "1m", matching=_FLINK, default=0),
    "flink_bytes_by_container": Panel("bytes_by_container", "1m", matching=_FLINK, default=0),
    "flink_feed": Panel("lines", matching=_FLINK),
    "kafka_live_containers": Panel("live_containers", "24h", equal=_KAFKA, step="1h"),
    "kafka_replicas": Panel("entries", "5m", equal=_KAFKA, line="(?i)(isr|replica)", default=18),
    "kafka_topics": Panel("series", "1h", equal=_KAFKA, line="(?i)posicoes"),
    "kafka_partitions": Panel("entries", "5m", equal=_KAFKA, line="(?i)partition", default=18),
    "kafka_messages_in": Panel(
        "rate", "1m", matching=_BROKER, line="(?i)(mensagem enviada|produced|record|partition)"
    ),
    "kafka_client_events": Panel(
        "rate", "1m", matching=_BROKER, line="(?i)(node|connection|client|channel|network|info|kafka)"
    ),
    "kafka_publishes": Panel("rate", "1m", matching=_BROKER, line="(?i)(mensagem enviada|producer|tópico)"),
    "registry_live_containers": Panel("live_containers", "24h", equal=_REGISTRY, step="1h"),
    "registry_schemas": Panel(
        "entries_by_series", "24h", equal=_REGISTRY, line="(?i)Registering new schema", step="1h"
    ),
    "registry_schema_ids": Panel("entries", "1h", equal=_REGISTRY, line="(?i)schemas/ids", default=1),
    "registry_http": Panel("entries", "5m", equal=_REGISTRY, line="(?i)HTTP", default=4),
    "registry_errors": Panel(
        "entries", "5m", equal=_REGISTRY, default=0,
        line="(?i)(SchemaSerializationException|DeserializationException|FatalError)",
    ),
    "registry_http_rate": Panel("rate", "1m", equal=_REGISTRY, line="(?i)HTTP", default=0),
    "registry_method_rate": Panel("rate", "1m", equal=_REGISTRY, line="(?i)(GET|POST)", default=0),
    "kafka_log_bytes": Panel("bytes", "1h", matching=_BROKER),
    "kafka_bytes_by_container": Panel("bytes_by_container", "5m", matching=_BROKER),
    "kafka_feed": Panel("lines", matching=_BROKER_ALL),
}

SERIES = ("container", "stream")


def run_panel(logs: DataFrame, panel: Panel) -> DataFrame:
    """The panel's metric: ``window_start, window_end, value`` with the labels it keeps, or the lines themselves."""
    chosen = lm.select_logs(logs, panel.equal, panel.matching, panel.line)
    span, step, measure = panel.span, panel.step, panel.measure
    times = ["window_start", "window_end"]
    if measure == "lines":
        return chosen.select("ts", "container", "stream", "line")
    if measure == "live_containers":
        return lm.label_sets(chosen, span, ["container"], step)
    if measure == "series":
        return lm.label_sets(chosen, span, SERIES, step)
    if measure == "jobs":
        return lm.label_sets(lm.extract(chosen, JOB_NAME, "job_name"), span, ["job_name"], step)
    if measure == "checkpoint_p95":
        return lm.quantile_over_time(chosen, CHECKPOINT_MS, 0.95, span, SERIES)
    if measure == "entries_by_series":
        return lm.over_time(chosen, span, SERIES, step).select(*SERIES, *times, F.col("entries").alias("value"))

    by = ["container"] if measure.endswith("_by_container") else []
    ranges = lm.over_time(chosen, span, by, step)
    amount = F.col("volume" if measure.startswith("bytes") else "entries")
    per_second = measure in ("rate", "rate_by_container", "bytes_by_container")
    value = lm.per_second(amount, span) if per_second else amount
    metric = ranges.select(*by, *times, value.alias("value"))
    if panel.default is None:
        return metric
    steps = lm.steps_of(logs, step or span)
    default = float(panel.default) if per_second else int(panel.default)
    if by:
        return lm.or_unlabelled(metric, steps, default, "container")
    return lm.or_default(metric, steps, default)
