"""A value at every time step of a stream, also where nothing came: event-time timers stand in for the lines.

The input is one row per step that has any line at all, so a task gets a row per step and never the lines. A gap is sent on
as one row that names its first and last step, whatever its length, and Spark spreads it into steps behind the operator; so
what a trigger's timers send is bounded by the rows that came and one gap. After every step a timer is set for the end of
the next one. When the watermark passes it without a row, the step was empty; the timer sends the gap up to the watermark
and sets itself anew.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Workers get the processor itself and need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class StepFiller(StatefulProcessor):
    """Rows ``(start, until, value)`` in seconds: steps from ``start`` to ``until`` share a value, NULL for empty ones."""

    def __init__(self, width: int):
        self._width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # Start of the first step that has not been sent on.
        self._next = handle.getValueState("next", "step long")

    def _wait(self, step: int) -> None:
        self._next.update((step,))
        self._handle.registerTimer((step + self._width) * 1000)

    def _out(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            frame = pd.DataFrame({"start": [r[0] for r in rows], "until": [r[1] for r in rows]}, dtype="int64")
            frame["value"] = pd.Series([r[2] for r in rows], dtype="float64")
            yield frame

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        steps = sorted(pair for batch in rows for pair in zip(batch["step"].tolist(), batch["value"].tolist()))
        next_, out = self._next.get()[0] if self._next.exists() else None, []
        for step, value in steps:
            if next_ is not None and step < next_:
                continue
            if next_ is not None and step > next_:
                out.append((next_, step, None))
            out.append((step, step + self._width, value))
            next_ = step + self._width
        if next_ is not None:
            self._wait(next_)
        yield from self._out(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        next_ = self._next.get()[0]
        passed = timerValues.getCurrentWatermarkInMs() // 1000 // self._width * self._width
        # A timer of a step whose row came after all finds nothing to do.
        if passed > next_:
            self._wait(passed)
            yield from self._out([(next_, passed, None)])

    def close(self) -> None:
        pass


def at_every_step(counted: DataFrame, value: Column, width: int, default: float) -> DataFrame:
    """``window_start``, ``window_end``, ``value`` (double) of every step from the first that has a row up to the watermark.

    ``counted`` is a watermarked stream with ``window``, one row per step; where its ``value`` is NULL, or there is no row,
    the step has the default.
    """
    given = counted.select(F.lit(0).alias("series"), F.unix_seconds("window.start").alias("step"), value.cast("double").alias("value"),
                           F.window_time("window").alias("at"))
    filled = given.groupBy("series").transformWithStateInPandas(
        statefulProcessor=StepFiller(width), outputStructType="start long, until long, value double", outputMode="append",
        timeMode="eventTime")
    each = filled.select(F.explode(F.sequence(F.col("start"), F.col("until") - width, F.lit(width).cast("long"))).alias("at"), "value")
    start = F.timestamp_seconds("at")
    return each.select(start.alias("window_start"), (start + F.expr(f"INTERVAL {width} SECONDS")).alias("window_end"),
                       F.coalesce("value", F.lit(float(default))).alias("value"))
