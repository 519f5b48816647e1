"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` (default all). Every query runs once to
warm up and once timed, in full, into a sink that keeps nothing. A continuous job reads all reports from an empty start.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlens.catalog import QUERIES  # noqa: E402
from fleetlens.session import build_session  # noqa: E402

HEADLINE = [
    "active_vehicles", "speed_by_line", "speed_history", "headway_by_line", "headway_history", "latest_position",
    "vehicle_status", "line_catalogue", "vehicle_motion_left", "operations_panel", "nearest_shape", "route_spacing",
    "route_length_all", "flatten_feed", "dead_letter", "upsert_merge", "constraint_violations", "log_count_default",
    "log_quantile", "log_rate_by_container", "log_live_containers", "log_bytes_over_time", "adjacent_lag",
    "adjacent_lag_chunked", "headway_by_line_chunked", "dead_payloads", "ingest_messages", "nearest_shape_stored",
    "route_spacing_stored",
]
# The eight jobs, apart and through one reader, and a log panel of each kind.
STREAMING = [
    "stream_active_vehicles", "stream_speed_by_line", "stream_speed_history", "stream_headway_by_line", "stream_headway_history",
    "stream_latest_position", "stream_vehicle_status", "stream_line_catalogue", "stream_all_jobs", "stream_log_rate",
    "stream_log_count_default",
]


def _run(spark, folder: str, name: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    names = sys.argv[1:] or HEADLINE + STREAMING
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        _run(spark, folder, name)
        times[name] = _run(spark, folder, name)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale[1]) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
