"""Words and their 64-bit names, made with numpy from the bytes of Arrow string columns.

A word rule is a table of 256 byte classes: bytes of class 0 separate, and a word is a longest run of bytes of one other
class. UTF-8 bytes of characters beyond ASCII are all 0x80 or more, so rules over ASCII characters hold bytewise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes handled at once; arrays of eight bytes a byte stay in a few megabytes.
SEGMENT = 1 << 19
CHUNK = 1 << 20

_ASCII = np.arange(256)
_UPPER = (_ASCII >= ord("A")) & (_ASCII <= ord("Z"))
FOLD = np.where(_UPPER, _ASCII + 32, _ASCII).astype(np.uint8)
PLAIN = _ASCII.astype(np.uint8)

_rng = np.random.Generator(np.random.PCG64(20240601))
_BYTE_NAMES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 1 << 60)) * 8 + 5
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEPS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE, SEGMENT)
_INVERSES = _powers(_BASE_INVERSE, SEGMENT)


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``count`` powers of the base of sequence names and of its inverse."""
    if count <= SEGMENT:
        return _POWERS[:count], _INVERSES[:count]
    return _powers(_BASE, count), _powers(_BASE_INVERSE, count)


def space_words() -> np.ndarray:
    """Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return."""
    return (~((_ASCII == 32) | ((_ASCII >= 9) & (_ASCII <= 13)))).astype(np.uint8)


def alnum_words() -> np.ndarray:
    """Words are runs of ASCII digits, ASCII letters and characters beyond ASCII."""
    letters = _UPPER | ((_ASCII >= ord("a")) & (_ASCII <= ord("z")))
    return (letters | ((_ASCII >= 48) & (_ASCII <= 57)) | (_ASCII >= 128)).astype(np.uint8)


def mixed_words() -> np.ndarray:
    """As ``alnum_words``, and runs of other visible characters are words too."""
    out = alnum_words()
    out[(out == 0) & (_ASCII > 32) & (_ASCII != 127)] = 2
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit names, one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def text_column(column) -> pa.Array:
    """Strings as one array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    return column


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = pa.types.is_large_string(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, edges, data = texts.buffers()
    edges = np.frombuffer(edges, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[edges[0]:edges[-1]], edges.astype(np.int64) - int(edges[0])


def row_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text each, or one row."""
    column = batch.column(batch.schema.get_field_index(column))
    _, edges = _buffer(text_column(column))
    begin, rows = 0, batch.num_rows
    while begin < rows:
        end = int(np.searchsorted(edges, edges[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), rows)
        yield batch.slice(begin, end - begin)
        begin = end


def _segment(data: np.ndarray, breaks: np.ndarray, classes: np.ndarray, names: np.ndarray):
    """Words of at most SEGMENT bytes. ``breaks``: places where a word may not go on."""
    return name_runs(data, classes[data], breaks, names)


def name_runs(data: np.ndarray, kind: np.ndarray, breaks: np.ndarray, names: np.ndarray = _BYTE_NAMES):
    """Names, starts and ends of the runs of one kind other than 0, in at most SEGMENT bytes; runs also end at ``breaks``."""
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[breaks] = True
    at = np.flatnonzero(edge)
    ends = np.append(at[1:], len(data))
    keep = kind[at] != 0
    at, ends = at[keep], ends[keep]
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(names[data] * _POWERS[:len(data)], out=total[1:])
    return mix((total[ends] - total[at]) * _INVERSES[at] + (ends - at).astype(np.uint64)), at, ends


def word_names(texts: pa.Array, classes: np.ndarray, fold: np.ndarray = FOLD):
    """Names of all words, and the number of words of each text.

    A word of over SEGMENT bytes is named by the chain of its parts, so equal words still have equal names.
    """
    names, _, _, counts = located_words(texts, classes, fold)
    return names, counts


def located_words(texts: pa.Array, classes: np.ndarray, fold: np.ndarray = FOLD):
    """As ``word_names``, with the byte span of each word counted from the start of its text: names, starts, ends, counts."""
    data, edges = _buffer(texts)
    table = _BYTE_NAMES[fold]
    out, starts, stops = [], [], []
    begin, size = 0, len(data)
    while begin < size:
        end = min(begin + SEGMENT, size)
        if end < size:
            tail = data[begin:end]
            same = classes[tail[1:]] == classes[tail[:-1]]
            cut = np.flatnonzero(~same)
            doc = edges[np.searchsorted(edges, end, "right") - 1]
            last = max(int(cut[-1]) + 1 if len(cut) else 0, int(doc) - begin)
            if classes[data[end]] == classes[tail[-1]] and doc != end and last > 0:
                end = begin + last
        inside = edges[np.searchsorted(edges, begin):np.searchsorted(edges, end)] - begin
        found, at, stop = _segment(data[begin:end], inside[inside < end - begin], classes, table)
        out.append(found)
        starts.append(at + begin)
        stops.append(stop + begin)
        begin = end
    if not out:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(texts), np.int64)
    names, first, last = np.concatenate(out), np.concatenate(starts), np.concatenate(stops)
    # Parts of one word that is longer than a segment touch each other at the edge of a segment.
    glued = np.flatnonzero((first[1:] == last[:-1]) & (classes[data[first[1:]]] == classes[data[last[:-1] - 1]]))
    if len(glued):
        glued = glued[~np.isin(first[glued + 1], edges)]
    if len(glued):
        keep = np.ones(len(names), bool)
        for i in glued[::-1]:
            names[i] = mix(np.array([names[i]], np.uint64) * _STEPS[0] + names[i + 1])[0]
            last[i] = last[i + 1]
            keep[i + 1] = False
        names, first, last = names[keep], first[keep], last[keep]
    # A text owns the words that start in it.
    owner = np.searchsorted(first, edges)
    counts = np.diff(owner)
    shift = np.repeat(edges[:-1], counts)
    return names, first - shift, last - shift, counts


def shingle_names(words: np.ndarray, size: int) -> np.ndarray:
    """Name of every run of ``size`` words of one array."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out += words[k:k + count] * _STEPS[k + 1]
    return mix(out)


def sequence_name(words: np.ndarray) -> np.ndarray:
    """Name of a whole array of words, as an array of one."""
    powers = _powers(_BASE, len(words)) if len(words) else np.zeros(0, np.uint64)
    return mix(np.array([np.sum(words * powers, dtype=np.uint64) + np.uint64(len(words))], np.uint64))


def long_names(names: np.ndarray) -> np.ndarray:
    return names.view(np.int64)
