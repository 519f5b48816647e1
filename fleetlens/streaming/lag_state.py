"""LAG in event-time order over a stream.

Streams reject ``lag`` because a row's predecessor may still arrive, so rows wait until the watermark passes them and are
then sorted and sent on with their predecessor. This is the only Python-worker code of the package; the built-in
operators have no ordered per-key state.

Keys may be many, so they share buckets: calls, timers and state entries are counted by bucket, and a bucket's rows are
sorted and shifted as columns. A key may be hot, so its rows are not gathered in one place. Buckets are split by time slot:

* :class:`SlotLag` runs per (bucket, slot). It sorts the slot's rows by key and finds every predecessor inside the slot.
  When the watermark reaches the slot's end it adds one boundary row per key, a copy of the key's last row there, and
  forgets the slot.
* :class:`SlotStitch` runs per bucket on slot-first and boundary rows only, two per key and slot, and gives every
  slot-first row the boundary row before it. All other rows pass through it in lanes of their own, spread like the slots.

With a time to live a key whose last row is older is forgotten: its next row has no predecessor, and an event-time timer
clears what is kept of it once the watermark is that far on. The result is the same whenever the timer fires, because a row
behind the watermark can only follow at a longer gap.

A task thus holds one slot of one bucket at a time, however many rows a key has, and state is one row per key plus the
slots the watermark has not closed. Rows cross to the workers without NULL numbers, whose places a column of bits names:
pandas would turn whole numbers beside a NULL into floats.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DecimalType,
    IntegerType,
    LongType,
    NumericType,
    StructField,
    StructType,
    TimestampType,
)

# Buckets of keys; more of them let more tasks work on the rows of one open slot. A checkpoint belongs to its number.
BUCKETS = 32

# Helper columns: real event time in microseconds, bucket, slot start, what a row is for, and bits of its NULL numbers.
_US, _BUCKET, _SLOT, _ROLE, _LANE, _NULLS = "event_us", "key_bucket", "slot_us", "slot_role", "lane", "null_bits"
_PLAIN, _FIRST, _BOUNDARY = 0, 1, 2
_ROWS_PER_FRAME = 10_000
_PACKED = StructType([StructField("rows", BinaryType())])

# Workers get the processors themselves and need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Columns = dict[str, np.ndarray]


class Layout(NamedTuple):
    """Columns of a row: its keys, all that is kept of it, the tie-breaker, new columns with their sources, and the bit of
    every column whose NULLs are told by bits."""

    keys: list[str]
    names: list[str]
    tie: str
    values: dict[str, str]
    bits: dict[str, int]


def _columns(frame: pd.DataFrame, names: Sequence[str]) -> Columns:
    return {n: frame[n].to_numpy() for n in names}


def _taken(rows: Columns, at: np.ndarray) -> Columns:
    return {n: v[at] for n, v in rows.items()}


def _joined(parts: Sequence[Columns]) -> Columns:
    return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}


def _pack(rows: Columns) -> tuple[bytes]:
    return (pickle.dumps(rows, protocol=pickle.HIGHEST_PROTOCOL),)


def _codes(rows: Columns, names: Sequence[str], layout: Layout) -> list[np.ndarray]:
    """Numbers that compare as the columns do, least significant first as ``lexsort`` takes them; NULL comes first."""
    out = []
    for name in reversed(names):
        if name in layout.bits:
            known = (rows[_NULLS] >> layout.bits[name]) & 1 == 0
            out += [rows[name], known]
        else:
            out.append(pd.factorize(rows[name], sort=True)[0])
    return out


def _starts(rows: Columns, layout: Layout, *within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by key and then by ``within`` (least significant first), and which of them begin a key."""
    codes = _codes(rows, layout.keys, layout)
    order = np.lexsort((*within, *codes))
    begins = np.zeros(len(order), dtype=bool)
    begins[:1] = True
    for code in codes:
        code = code[order]
        begins[1:] |= code[1:] != code[:-1]
    return order, begins


def _with_previous(rows: Columns, at: np.ndarray, before: np.ndarray, layout: Layout) -> Columns:
    """Rows ``at`` with the new columns from rows ``before``; below 0 there is none."""
    out, missing, source = _taken(rows, at), before < 0, np.maximum(before, 0)
    for new, old in layout.values.items():
        found = rows[old][source]
        if new in layout.bits:
            lost = missing
            if old in layout.bits:
                lost = missing | ((rows[_NULLS][source] >> layout.bits[old]) & 1 == 1)
            found[lost] = 0
            out[_NULLS] = out[_NULLS] | lost.astype(np.int64) << layout.bits[new]
        else:
            found = found.astype(object)
            found[missing] = None
        out[new] = found
    return out


def _frames(rows: Columns, names: Sequence[str]) -> Iterator[pd.DataFrame]:
    frame = pd.DataFrame({n: rows[n] for n in names}, copy=False)
    for i in range(0, len(frame), _ROWS_PER_FRAME):
        yield frame.iloc[i:i + _ROWS_PER_FRAME]


class SlotLag(StatefulProcessor):
    """Predecessors within one slot of one bucket of keys."""

    def __init__(self, layout: Layout, output: Sequence[str], slot_us: int, ttl_us: int | None = None):
        self._layout, self._output = layout, list(output)
        self._width, self._ttl = slot_us, ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # One state entry per arriving batch, column by column.
        self._ahead = handle.getListState("ahead", _PACKED)
        # The last row sent of every key.
        self._last = handle.getValueState("last", _PACKED)

    def _wait_for(self, event_us: int) -> None:
        """Set a timer at the first whole millisecond not before ``event_us``; one that finds nothing to do is harmless."""
        self._handle.registerTimer(-(-int(event_us) // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for batch in rows:
            self._ahead.appendValue(_pack(_columns(batch, self._layout.names)))
            first = int(batch[_US].min())
            earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self._wait_for(earliest)
        return iter(())

    def _sorted(self, rows: Columns, fresh: np.ndarray) -> tuple[Columns, np.ndarray, np.ndarray]:
        """Rows by key and time, which of them begin a key, and which are not rows sent before; those come first."""
        order, begins = _starts(rows, self._layout, *_codes(rows, [self._layout.tie], self._layout), rows[_US], fresh)
        return _taken(rows, order), begins, fresh[order]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        bucket, slot = int(key[0]), int(key[1])
        end = slot + self._width
        packed = [pickle.loads(rows) for rows, in self._ahead.get()]
        sent = pickle.loads(self._last.get()[0]) if self._last.exists() else None
        if not packed and sent is None:
            return  # the slot is closed already
        waiting = _joined(packed) if packed else _taken(sent, np.arange(0))
        passed = waiting[_US] <= limit
        if limit < end and not passed.any():
            self._wait_for(waiting[_US].min() if len(passed) else end)
            return
        ready, waiting = _taken(waiting, passed), _taken(waiting, ~passed)
        fresh = np.ones(int(passed.sum()), dtype=bool)
        if sent is not None:
            fresh = np.concatenate([np.zeros(len(sent[_US]), dtype=bool), fresh])
            ready = _joined([sent, ready])
        rows, begins, fresh = self._sorted(ready, fresh)
        # Rows not after what was already sent on are late, as they are for any event-time window.
        first = np.maximum.accumulate(np.where(begins, np.arange(len(begins)), 0))
        late = fresh & ~fresh[first] & (rows[_US] <= rows[_US][first])
        if late.any():
            rows, begins, fresh = self._sorted(_taken(rows, ~late), fresh[~late])
        last = _taken(rows, np.flatnonzero(np.append(begins[1:], True)))

        at = np.flatnonzero(fresh)
        before = np.where(begins[at], -1, at - 1)
        if self._ttl is not None:
            before[rows[_US][at] - rows[_US][before] > self._ttl] = -1
        out = _with_previous(rows, at, before, self._layout)
        out[_ROLE] = np.where(begins[at], _FIRST, _PLAIN)
        yield from self._sent(out, bucket, slot, out[_US])
        if limit >= end:
            bounds = _with_previous(last, np.arange(len(last[_US])), np.full(len(last[_US]), -1), self._layout)
            bounds[_ROLE] = np.full(len(last[_US]), _BOUNDARY)
            yield from self._sent(bounds, bucket, slot, np.full(len(last[_US]), end))
            self._ahead.clear()
            self._last.clear()
        else:
            self._last.update(_pack(last))
            if len(waiting[_US]):
                self._ahead.put([_pack(waiting)])
            else:
                self._ahead.clear()
            self._wait_for(waiting[_US].min() if len(waiting[_US]) else end)

    def _sent(self, rows: Columns, bucket: int, slot: int, when: np.ndarray) -> Iterator[pd.DataFrame]:
        count = len(when)
        lane = np.where(rows[_ROLE] == _PLAIN, slot, -1)
        told = {_BUCKET: np.full(count, bucket), _LANE: lane, "event_time": when.astype("datetime64[us]")}
        return _frames({**rows, **told}, self._output)

    def close(self) -> None:
        pass


class SlotStitch(StatefulProcessor):
    """Predecessors of slot-first rows: the boundary row before them. Waits for nothing, because a boundary row never
    comes in a later micro-batch than the rows after it; timers only clear last rows that have outlived their time."""

    def __init__(self, layout: Layout, output: Sequence[str], ttl_us: int | None = None):
        self._layout, self._output, self._ttl = layout, list(output), ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # The last boundary row of every key.
        self._last = handle.getValueState("last", _PACKED)

    def _ends(self, last: Columns) -> np.ndarray:
        """Watermarks in milliseconds at which last rows have no follower any more."""
        return (last[_US] + self._ttl) // 1000 + 1

    def _keep(self, last: Columns) -> None:
        if len(last[_US]):
            self._last.update(_pack(last))
            if self._ttl is not None:
                self._handle.registerTimer(int(self._ends(last).min()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[1] >= 0:
            for batch in rows:
                yield batch[self._output]
            return
        # Two rows per key and slot of this micro-batch.
        edges = pd.concat(list(rows), ignore_index=True)
        all_rows = _columns(edges, self._layout.names)
        role, when = edges[_ROLE].to_numpy(), edges["event_time"].to_numpy().astype("datetime64[us]").astype(np.int64)
        if self._last.exists():
            kept = pickle.loads(self._last.get()[0])
            count = len(kept[_US])
            all_rows = _joined([kept, all_rows])
            # Before all others of their keys.
            role = np.concatenate([np.full(count, _BOUNDARY), role])
            when = np.concatenate([np.full(count, np.iinfo(np.int64).min), when])
        order, begins = _starts(all_rows, self._layout, role != _BOUNDARY, when)
        all_rows, role, when = _taken(all_rows, order), role[order], when[order]
        places = np.arange(len(order))
        start = np.maximum.accumulate(np.where(begins, places, 0))
        bound = np.maximum.accumulate(np.where(role == _BOUNDARY, places, -1))
        bound[bound < start] = -1
        ends = bound[np.append(begins[1:], True)]
        self._keep(_taken(all_rows, ends[ends >= 0]))

        at = np.flatnonzero(role == _FIRST)
        before = bound[at]
        if self._ttl is not None:
            before[all_rows[_US][at] - all_rows[_US][before] > self._ttl] = -1
        # These rows came with the bits of a row without predecessor.
        mine = ~sum(1 << self._layout.bits[new] for new in self._layout.values if new in self._layout.bits)
        out = _taken(all_rows, np.arange(len(order)))
        out[_NULLS] = out[_NULLS] & mine
        out = _with_previous(out, at, before, self._layout)
        out["event_time"] = when[at].astype("datetime64[us]")
        yield from _frames(out, self._output)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self._last.exists():
            last = pickle.loads(self._last.get()[0])
            going = self._ends(last) <= timerValues.getCurrentWatermarkInMs()
            if going.all():
                self._last.clear()
            elif going.any():
                self._keep(_taken(last, ~going))
        return iter(())

    def close(self) -> None:
        pass


def _told_by_bits(field: StructField) -> bool:
    return isinstance(field.dataType, (NumericType, BooleanType)) and not isinstance(field.dataType, DecimalType)


def _nulls(layout: Layout, given: Sequence[str]) -> Column:
    """Bits of the NULLs of a row's numbers."""
    bits = F.lit(0).cast("long")
    for name in given:
        bits = bits.bitwiseOR(F.when(F.col(name).isNull(), F.lit(1 << layout.bits[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def stream_lag(
    positions: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    values: dict[str, str],
    slot_seconds: int,
    tie: str = "event_id",
    ttl_seconds: float | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming twin of ``lag_over``: ``columns`` of every report with ``values`` of the key's previous report.

    ``positions`` must carry a watermark on ``event_time``. A source named ``event_time`` gives the previous time, as
    microseconds. Rows come out once the watermark has passed them; those without a time never do. ``slot_seconds`` and
    ``buckets`` change how the work is split, never the result. A row that follows more than ``ttl_seconds`` after its
    key's last one has no predecessor.
    """
    ttl_us = None if ttl_seconds is None else int(ttl_seconds * 1_000_000)
    width = slot_seconds * 1_000_000
    kept = [c for c in dict.fromkeys([*columns, tie]) if c != "event_time" and c not in keys]
    timed = positions.where(F.col("event_time").isNotNull())
    sources = {new: _US if old == "event_time" else old for new, old in values.items()}
    fields = {c: timed.schema[c] for c in [*keys, *kept]} | {_US: StructField(_US, LongType())}
    added = {new: StructField(new, fields[old].dataType) for new, old in sources.items()}
    marked = [name for name, field in (fields | added).items() if name != _US and _told_by_bits(field)]
    layout = Layout([*keys], [*fields, _NULLS], tie, sources, {name: bit for bit, name in enumerate(marked)})

    at = F.unix_micros("event_time")
    zero = {c: F.coalesce(c, F.lit(0).cast(fields[c].dataType)).alias(c) for c in marked if c in fields}
    slim = timed.select(
        "event_time", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(_BUCKET), (at - F.pmod(at, F.lit(width))).alias(_SLOT),
        *[zero.get(c, F.col(c)) for c in [*keys, *kept]], at.alias(_US), _nulls(layout, list(zero)).alias(_NULLS))
    when = StructField("event_time", TimestampType())
    sent = StructType([*fields.values(), StructField(_NULLS, LongType()), *added.values(), when])
    inner = StructType([StructField(_BUCKET, IntegerType()), StructField(_LANE, LongType()), *sent.fields, StructField(_ROLE, IntegerType())])
    in_slots = slim.groupBy(_BUCKET, _SLOT).transformWithStateInPandas(
        statefulProcessor=SlotLag(layout, inner.names, width, ttl_us), outputStructType=inner, outputMode="append",
        timeMode="eventTime", eventTimeColumnName="event_time",
    )
    rows = in_slots.groupBy(_BUCKET, _LANE).transformWithStateInPandas(
        statefulProcessor=SlotStitch(layout, sent.names, ttl_us), outputStructType=sent, outputMode="append",
        timeMode="eventTime", eventTimeColumnName="event_time",
    )
    known = {c: F.when(F.col(_NULLS).bitwiseAND(F.lit(1 << bit)) == 0, F.col(c)).alias(c) for c, bit in layout.bits.items()}
    return rows.select(*[known.get(c, F.col(c)) for c in [*keys, *kept, *added]], "event_time")
