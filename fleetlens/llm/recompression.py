"""Recompression of word sequences: rounds that rename runs and pairs, so that equal substrings get equal inner symbols."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from fleetlens.llm.words import mix

_LEVELS = mix(np.arange(1, 65, dtype=np.uint64))
_RUN, _LEFT, _RIGHT, _LEVEL = (np.uint64(x) for x in (
    0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xE7037ED1A0B428DB))


class Symbols(NamedTuple):
    """Symbols in order: name, the words [start, end) they stand for, and the words [seen_from, seen_to) their being there
    depends on. A border between texts is a symbol that never joins another."""

    names: np.ndarray
    start: np.ndarray
    end: np.ndarray
    seen_from: np.ndarray
    seen_to: np.ndarray
    border: np.ndarray


def words_as_symbols(names: np.ndarray, border: np.ndarray) -> Symbols:
    at = np.arange(len(names), dtype=np.int32)
    return Symbols(names, at, at + 1, at, at + 1, border)


def next_round(old: Symbols, number: int) -> Symbols:
    """One round: runs of one symbol get a name of symbol and length; then the alphabet is parted by a hash into left and
    right symbols, and every left one followed by a right one becomes a pair. Names are hashes of what they stand for, so
    they are the same everywhere. A decision looks at one symbol beyond those it joins, on either side."""
    first = np.ones(len(old.names), bool)
    first[1:] = (old.names[1:] != old.names[:-1]) | old.border[1:] | old.border[:-1]
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(old.names)) - 1
    base = old.names[at]
    border = old.border[at]
    right = (mix(base + np.uint64(number)) & np.uint64(1)).astype(bool)
    joins = np.zeros(len(at), bool)
    joins[:-1] = ~right[:-1] & right[1:] & ~border[:-1] & ~border[1:]
    length = last - at + 1
    named = np.where(length > 1, mix(base * _RUN + length.astype(np.uint64)), base)
    keep = np.ones(len(at), bool)
    keep[1:] = ~joins[:-1]
    head = np.flatnonzero(keep)
    tail = head + joins[head]
    pair = mix(named[head] * _LEFT + named[tail] * _RIGHT + np.uint64(1))
    names = np.where(joins[head], pair, named[head])
    low, high = at[head], last[tail]
    before, after = np.maximum(low - 1, 0), np.minimum(high + 1, len(old.names) - 1)
    border = border[head]
    return Symbols(names, old.start[low], old.end[high], np.where(border, old.seen_from[low], old.seen_from[before]),
                   np.where(border, old.seen_to[high], old.seen_to[after]), border)


def _least(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Leftmost place of the least key in each range [low, high], by a table of ranges of two, four, ... keys."""
    width = high - low + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    table = [np.arange(len(keys), dtype=np.int32)]
    for step in range(int(level.max()) if len(level) else 0):
        past = table[-1]
        ahead = past[1 << step:]
        past = past[:len(ahead)]
        table.append(np.where(keys[past] <= keys[ahead], past, ahead))
    out = np.empty(len(low), np.int32)
    for step, row in enumerate(table):
        here = np.flatnonzero(level == step)
        if len(here):
            one, two = row[low[here]], row[high[here] - (1 << step) + 1]
            out[here] = np.where(keys[one] <= keys[two], one, two)
    return out


def anchors(names: np.ndarray, border: np.ndarray, window: int, levels: tuple[int, ...]):
    """For every window of words without a border: its start, and name and place of its anchor.

    The anchor is a symbol whose being there depends on words of the window alone: of the highest of ``levels`` that has
    any, the longest, then the one with the least name. So equal windows have equal anchors at equal places, wherever they
    stand; level 0 always has some.
    """
    count = len(names) - window + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none
    borders = np.concatenate([[0], np.cumsum(border)])
    open_ = np.flatnonzero(borders[window:] == borders[:-window]) if count > 0 else np.zeros(0, np.int64)
    name = np.zeros(len(open_), np.uint64)
    place = np.zeros(len(open_), np.int64)
    left = np.ones(len(open_), bool)
    symbols, by_level = words_as_symbols(names, border), {}
    for number in range(max(levels) + 1):
        if number:
            symbols = next_round(symbols, number)
        if number in levels:
            by_level[number] = symbols
    for number in sorted(levels, reverse=True):
        these = by_level[number]
        rest = np.flatnonzero(left)
        if not len(rest):
            break
        start = open_[rest]
        low = np.cumsum(np.bincount(these.seen_from + 1, minlength=len(names) + 2))[start]
        high = np.cumsum(np.bincount(these.seen_to, minlength=len(names) + 2))[start + window] - 1
        some = low <= high
        rest, low, high = rest[some], low[some], high[some]
        if not len(rest):
            continue
        size = np.minimum(these.end - these.start, 255).astype(np.uint64)
        keys = ((np.uint64(255) - size) << np.uint64(56)) | (mix(these.names + _LEVEL) >> np.uint64(8))
        best = _least(keys, low, high)
        name[rest] = mix(these.names[best] + _LEVELS[number])
        place[rest] = these.start[best]
        left[rest] = False
    return open_, name, place
