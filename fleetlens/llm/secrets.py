"""Secret scans: pattern spans, and a linear-chain conditional random field over the tokens around them.

Base spans come from three fixed patterns. The field tags tokens as secret begin, inside or outside from their shape,
neighbouring words and features of the whole file, and Viterbi decoding gives further spans, which are added where they
touch no base span. A text is one chain of all its tokens (runs of ASCII letters, digits and characters beyond ASCII, and
single signs; a run of over ``LONGEST`` bytes is several), of any length. Tokens, their names, shapes and features are made
with numpy from the bytes of whole batches, so no Python runs for a token, known or new. Tokens that are outside on every
best path, whatever their neighbours are, cut a chain into short ones, which are decoded one by one with the result of the
whole. Texts of more than a segment are scored segment by segment, with the few tokens around each that features reach to:
the same scores, and memory beside the text stays that of a segment (and of open tokens that follow one another).

The field is trained on a bounded sample of rows (``SAMPLE_ROWS``): pieces around base spans, pieces without any, most of
those around tokens that look like values, and pieces in which the cue is hidden or changed. In these a value of a base
span stands behind another key word, another separator or none at all, is cut short, respelled or split by signs, or words
of the text stand in its place; so shapes and neighbours must carry what the patterns' own words cannot. Pieces in which
key words lead to nothing, or short values stand without any cue, are outside.

Defined cases: null and empty texts have no span; repeated rows are scanned each; other columns are ignored, whatever
their names; an empty table gives an empty result and an untrained field, which adds nothing.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.stored import written
from fleetlens.llm.words import FOLD, SEGMENT, mix, name_runs, row_chunks, text_column
from fleetlens.llm.words import _buffer as buffer_of

# What counts as a secret without the field.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

ADDED = "field"
SAMPLE_ROWS = 20_000
# Pieces with a secret that the field learns from, of the text and with hidden cues; and times as many without.
SAMPLE_RUNS, PER_SECRET = 2_000, 3
# Rounds of pieces with hidden cues for each value: so many at most, and fewer in a sample of many rows.
HIDDEN, HIDDEN_ROWS = 40, 40_000
# Tokens of a piece of text that the field learns from, and those of them before a base span.
PIECE, LEAD = 16, 6
LONGEST_RUN = 40
ROUNDS = 80

# Words and signs that stand before secrets besides those of the patterns, for pieces with a changed cue.
KEY_WORDS = ("password", "passwd", "pwd", "pass", "passphrase", "passcode", "secret", "token", "key", "apikey", "credential",
             "credentials", "auth", "bearer", "pin", "login", "signature", "session")
SEPARATORS = (": ", " = ", "=", " is ", " was ", " -> ", " => ", " := ", " ", " is: ")
QUOTES = ("", "", '"', "'", "`")

OUT, BEGIN, INSIDE = range(3)
_SETTING = re.compile(r"^[ \t]*[A-Za-z_][A-Za-z0-9_.-]*[ \t]*[:=]", re.MULTILINE)
_FEATURES = 1 << 16
LONGEST = 4096


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost spans of each pattern that do not overlap within a kind, by start and then kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[kind], start, end) for start, kind, end in sorted(spans)]


def value_runs(text: str) -> Iterator[tuple[int, int]]:
    """Ranges of text that are a chain of tokens each: the whole text, if it is not empty."""
    if text:
        yield 0, len(text)


def file_features(text: str, has_base: bool) -> list[str]:
    settings = bool(_SETTING.search(text))
    return [f"file-settings={settings}", f"file-base={has_base}", f"file-lines={min(text.count(chr(10)), 16).bit_length()}"]


# Tokens ---------------------------------------------------------------------------------------------------------------

_BYTES = np.arange(256)
_DIGITS = (_BYTES >= 48) & (_BYTES <= 57)
_LOWER, _UPPER = (_BYTES >= 97) & (_BYTES <= 122), (_BYTES >= 65) & (_BYTES <= 90)
_LETTERS = _LOWER | _UPPER
# Kind of a byte: 1 in words, 2 signs.
_KIND = np.where(_DIGITS | _LETTERS | (_BYTES >= 128), 1, np.where((_BYTES > 32) & (_BYTES < 127), 2, 0)).astype(np.uint8)
# Kinds of characters as bits: digits, a-f, g-z, A-F, G-Z, beyond ASCII.
_BITS = (_DIGITS + 2 * (_LOWER & (_BYTES <= 102)) + 4 * (_LOWER & (_BYTES > 102)) + 8 * (_UPPER & (_BYTES <= 70))
         + 16 * (_UPPER & (_BYTES > 70)) + 32 * (_BYTES >= 128)).astype(np.uint8)
_LENGTHS = np.array([1, 4, 8, 16, 32])
# Shapes of words are bits, class of length and class of turns between digits and letters; signs are their bytes.
_WORD_SHAPES = 64 * 24
_SHAPES = _WORD_SHAPES + 256
# Tokens around a token whose words are features of it.
_BEFORE, _AFTER = 4, 2
# Bytes around a token that its run of touching tokens is measured in, and tokens kept before a segment.
_RUN, _KEPT = 128, 160


class Tokens(NamedTuple):
    """Tokens in order: byte spans, number of the text, name (or shape, where words differ too much), shape."""

    starts: np.ndarray
    ends: np.ndarray
    texts: np.ndarray
    values: np.ndarray
    shapes: np.ndarray

    def part(self, low: int, high: int) -> Tokens:
        return Tokens(*[column[low:high] for column in self])


def joined(parts: list[Tokens]) -> Tokens:
    return Tokens(*[np.concatenate(columns) for columns in zip(*parts, strict=True)])


def tokens_of(data: np.ndarray, edges: np.ndarray) -> Tokens:
    """Tokens of texts in one buffer of at most SEGMENT bytes; ``edges`` are the places where a text begins, and the end."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Tokens(none, none, none, none.astype(np.uint64), none)
    kind, folded = _KIND[data], FOLD[data]
    signs = np.flatnonzero(kind == 2)
    breaks = np.concatenate([edges[edges < len(data)], signs])
    names, starts, ends = name_runs(folded, kind, breaks)
    long_ = np.flatnonzero(ends - starts > LONGEST)
    if len(long_):
        cuts = [np.arange(starts[i] + LONGEST, ends[i], LONGEST) for i in long_]
        names, starts, ends = name_runs(folded, kind, np.concatenate([breaks, *cuts]))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Tokens(none, none, none, none.astype(np.uint64), none)
    # Between tokens stand bytes without bits only.
    bits = np.bitwise_or.reduceat(_BITS[data], starts)
    digit, letter = _DIGITS[data], _LETTERS[data]
    turn = np.zeros(len(data), np.int32)
    turn[1:] = (digit[1:] & letter[:-1]) | (letter[1:] & digit[:-1])
    turns = np.add.reduceat(turn, starts) - turn[starts]
    sizes = ends - starts
    length = np.searchsorted(_LENGTHS, sizes, "left")
    shapes = bits.astype(np.int64) * 24 + length * 4 + np.minimum(turns, 6) // 2
    sign = kind[starts] == 2
    shapes = np.where(sign, _WORD_SHAPES + data[starts].astype(np.int64), shapes)
    plain = sign | ((bits & 1 == 0) & (sizes <= 24))
    values = np.where(plain, names, mix(shapes.astype(np.uint64) + np.uint64(1 << 40)))
    return Tokens(starts, ends, np.searchsorted(edges, starts, "right") - 1, values, shapes)


def run_sizes(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Whether a token touches the one before it, and the size class of the run of touching tokens that it stands in."""
    touches = np.zeros(len(tokens.starts), bool)
    touches[1:] = (tokens.starts[1:] == tokens.ends[:-1]) & (tokens.texts[1:] == tokens.texts[:-1])
    head = np.flatnonzero(~touches)
    last = np.append(head[1:], len(touches)) - 1
    runs = last - head + 1
    before = np.minimum(tokens.starts - np.repeat(tokens.starts[head], runs), _RUN)
    after = np.minimum(np.repeat(tokens.ends[last], runs) - tokens.ends, _RUN)
    return touches, np.minimum((before + after + tokens.ends - tokens.starts) // 8, 16)


# Features -------------------------------------------------------------------------------------------------------------


def _slot(name: str) -> int:
    """Feature number by a hash that is the same in every process."""
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % _FEATURES


_SALTS = mix(np.arange(1, 32, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _hashed(values: np.ndarray, place: int) -> np.ndarray:
    return (mix(values ^ _SALTS[place]) >> np.uint64(48)).astype(np.int64)


def _shape_slots() -> tuple[np.ndarray, np.ndarray]:
    """Features of every shape: of the token itself, and of the next and last token, without and with a gap between."""
    shapes = np.arange(_SHAPES, dtype=np.uint64)
    word = shapes < _WORD_SHAPES
    kinds, rest = shapes // np.uint64(24), shapes % np.uint64(24)
    own = [np.full(_SHAPES, _slot("bias")), _hashed(shapes, 8), np.where(word, _hashed(kinds, 9), _FEATURES),
           np.where(word, _hashed(rest // np.uint64(4), 10), _FEATURES), np.where(word, _hashed(rest % np.uint64(4), 11), _FEATURES)]
    own += [np.where(word & ((kinds >> np.uint64(k)) & np.uint64(1) == 1), _slot(f"has={k}"), _FEATURES) for k in range(6)]
    sides = [_hashed(shapes, place) for place in (12, 13, 14, 15)]
    return np.stack(own, axis=1), np.stack(sides)


_OWN, _SIDES = _shape_slots()
_LEFT, _RIGHT = 0, 2
_LEFT_EDGE, _RIGHT_EDGE = _slot("left=edge"), _slot("right=edge")
_RUN_SLOTS = np.array([_slot(f"run={k}") for k in range(17)])


def _neighbours(tokens: Tokens) -> list[np.ndarray]:
    """For each place around a token, whether a token of the same text stands there: before 1 to 4, after 1 and 2."""
    out, count = [], len(tokens.texts)
    for k in range(1, _BEFORE + 1):
        near = np.zeros(count, bool)
        near[k:] = tokens.texts[k:] == tokens.texts[:-k]
        out.append(near)
    for k in range(1, _AFTER + 1):
        near = np.zeros(count, bool)
        near[:-k] = tokens.texts[k:] == tokens.texts[:-k]
        out.append(near)
    return out


def _moved(values: np.ndarray, by: int) -> np.ndarray:
    """``values`` of the token ``by`` places before each (after it, if negative); the ends wrap and are to be masked."""
    return np.roll(values, by, axis=0)


def token_slots(tokens: Tokens, of_file: np.ndarray) -> np.ndarray:
    """Feature numbers of every token, a row each; ``_FEATURES`` is none. ``of_file`` has the file's for each token."""
    touches, sizes = run_sizes(tokens)
    near = _neighbours(tokens)
    after = np.append(touches[1:], False)
    left = _SIDES[np.where(touches, _LEFT, _LEFT + 1), _moved(tokens.shapes, 1)]
    right = _SIDES[np.where(after, _RIGHT, _RIGHT + 1), _moved(tokens.shapes, -1)]
    columns = [_OWN[tokens.shapes], _RUN_SLOTS[sizes][:, None], of_file,
               np.where(near[0], left, _LEFT_EDGE)[:, None], np.where(near[_BEFORE], right, _RIGHT_EDGE)[:, None]]
    for k, there in enumerate(near):
        by = k + 1 if k < _BEFORE else _BEFORE - k - 1
        columns.append(np.where(there, _moved(_hashed(tokens.values, k), by), _FEATURES)[:, None])
    return np.concatenate(columns, axis=1)


def file_slots(text: str, has_base: bool) -> list[int]:
    return [_slot(name) for name in file_features(text, has_base)]


class Emissions:
    """Scores of tokens: the weights of ``token_slots`` summed, those of shapes from tables."""

    def __init__(self, weights: np.ndarray):
        self.weights = np.vstack([weights[:_FEATURES], np.zeros((1, 3))])
        self.own = self.weights[_OWN].sum(1)
        self.sides = self.weights[_SIDES]
        self.runs = self.weights[_RUN_SLOTS]

    def of_file(self, text: str, has_base: bool) -> np.ndarray:
        return self.weights[file_slots(text, has_base)].sum(0)

    def scores(self, tokens: Tokens, of_file: np.ndarray) -> np.ndarray:
        """Three scores a token; ``of_file`` has a row for each text."""
        touches, sizes = run_sizes(tokens)
        near = _neighbours(tokens)
        emit = self.own[tokens.shapes] + self.runs[sizes] + of_file[tokens.texts]
        first, last = ~near[0], ~near[_BEFORE]
        emit[first] += self.weights[_LEFT_EDGE]
        emit[last] += self.weights[_RIGHT_EDGE]
        emit[1:] += np.where(near[0][1:, None], self.sides[np.where(touches[1:], _LEFT, _LEFT + 1), tokens.shapes[:-1]], 0.0)
        emit[:-1] += np.where(near[_BEFORE][:-1, None], self.sides[np.where(touches[1:], _RIGHT, _RIGHT + 1), tokens.shapes[1:]], 0.0)
        for k, there in enumerate(near):
            slots = np.where(there, _moved(_hashed(tokens.values, k), k + 1 if k < _BEFORE else _BEFORE - k - 1), _FEATURES)
            emit += self.weights[slots]
        return emit


# Decoding -------------------------------------------------------------------------------------------------------------


def sure_outside(emit: np.ndarray, step: np.ndarray, last: np.ndarray | None = None) -> np.ndarray:
    """Tokens that are outside on every best path: outside in their place gains more than any transition can cost.

    An inside token behind them would have to begin then, which is counted too. ``last``: tokens that end a text.
    """
    enter = (step[:, 1:] - step[:, :1])[step[:, 1:] > -1e8].max()
    leave = max((step[label, after] - step[OUT, after]) for label in (BEGIN, INSIDE) for after in (OUT, BEGIN))
    into = max(step[label, INSIDE] - step[OUT, BEGIN] for label in (BEGIN, INSIDE))
    further = max(0.0, (step[INSIDE] - step[BEGIN]).max())
    gain = emit[:, OUT] - np.maximum(emit[:, BEGIN], emit[:, INSIDE])
    behind = np.full(len(emit), max(leave, 0.0))
    follow = into + further + emit[1:, INSIDE] - emit[1:, BEGIN]
    behind[:-1] = np.maximum(behind[:-1], follow if last is None else np.where(last[:-1], -np.inf, follow))
    return gain > enter + behind + 1e-9


def best_path(emit: np.ndarray, step: np.ndarray, last: np.ndarray | None = None, sure: np.ndarray | None = None) -> np.ndarray:
    """The path of ``viterbi``, decoded between the tokens that are outside for sure. Stretches of one length go together.

    ``last``: tokens that end a text, by default the last one only.
    """
    path = np.full(len(emit), OUT)
    if last is None:
        last = np.arange(len(emit)) == len(emit) - 1
    open_ = np.flatnonzero(~(sure_outside(emit, step, last) if sure is None else sure))
    if not len(open_):
        return path
    cuts = np.flatnonzero((np.diff(open_) > 1) | last[open_[:-1]]) + 1
    firsts = np.concatenate([[0], cuts])
    lengths = np.diff(np.append(firsts, len(open_)))
    for length in np.unique(lengths):
        places = open_[firsts[lengths == length]][:, None] + np.arange(length)
        path[places] = _paths(emit[places], step, ~last[places[:, -1]])
    return path


def _paths(emit: np.ndarray, step: np.ndarray, followed: np.ndarray) -> np.ndarray:
    """Best paths of stretches of one length; each begins, and where ``followed`` also ends, next to an outside token."""
    best = emit[:, 0] + step[OUT]
    back = np.zeros(emit.shape, np.uint8)
    for i in range(1, emit.shape[1]):
        options = best[:, :, None] + step
        back[:, i] = options.argmax(1)
        best = options.max(1) + emit[:, i]
    path = np.empty(emit.shape[:2], np.int64)
    path[:, -1] = np.where(followed[:, None], best + step[:, OUT], best).argmax(1)
    each = np.arange(len(emit))
    for i in range(emit.shape[1] - 1, 0, -1):
        path[:, i - 1] = back[each, i, path[:, i]]
    return path


def viterbi(emit: np.ndarray, step: np.ndarray) -> list[int]:
    """Best path; it starts and ends next to outside tokens, and inside may not follow outside."""
    best, back = emit[0] + step[OUT], np.zeros((len(emit), 3), np.uint8)
    for i in range(1, len(emit)):
        options = best[:, None] + step
        back[i] = options.argmax(0)
        best = options.max(0) + emit[i]
    path = [int(best.argmax())]
    for i in range(len(emit) - 1, 0, -1):
        path.append(int(back[i, path[-1]]))
    return path[::-1]


def _steps(weights: np.ndarray) -> np.ndarray:
    step = weights[-3:].copy()
    step[OUT, INSIDE] = -1e9
    return step


def _spans_of(path: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans that begin and go on inside."""
    begins = np.flatnonzero(path == BEGIN)
    if not len(begins):
        return []
    outside = np.append(np.flatnonzero(path != INSIDE), len(path))
    lasts = outside[np.searchsorted(outside, begins, "right")] - 1
    return list(zip(starts[begins].tolist(), ends[lasts].tolist(), strict=True))


def _batch_secrets(data: np.ndarray, edges: np.ndarray, field: Emissions, step: np.ndarray, of_file: np.ndarray):
    """Byte spans in each of several texts in one buffer of at most a segment."""
    found = [[] for _ in range(len(edges) - 1)]
    tokens = tokens_of(data, edges[:-1])
    if not len(tokens.starts):
        return found
    last = np.append(tokens.texts[1:] != tokens.texts[:-1], True)
    path = best_path(field.scores(tokens, of_file), step, last)
    for begin, end in _spans_of(path, tokens.starts, tokens.ends):
        text = int(np.searchsorted(edges, begin, "right")) - 1
        found[text].append((begin - int(edges[text]), end - int(edges[text])))
    return found


def segments(data: np.ndarray, size: int = SEGMENT) -> Iterator[tuple[Tokens, int, int, bool]]:
    """Tokens of one long text, window by window: the window's tokens, and the range of them that is to be scored here.

    A window has the tokens before and after that range which features reach to. The last value tells the end of the text.
    ``size`` is more than ``LONGEST``.
    """
    carried, low, position = [], 0, 0
    while True:
        end = min(position + size, len(data))
        final = end == len(data)
        new = tokens_of(data[position:end], np.zeros(1, np.int64))
        new = new._replace(starts=new.starts + position, ends=new.ends + position)
        position = end
        if not final and len(new.ends) and new.ends[-1] == end:
            # The last token may go on.
            position = int(new.starts[-1])
            new = new.part(0, len(new.ends) - 1)
        tokens = joined([*carried, new])
        high = len(tokens.ends)
        if not final:
            high = max(low, min(int(np.searchsorted(tokens.ends, end - 2 * _RUN, "right")), high - _AFTER - 1))
        yield tokens, low, high, final
        if final:
            return
        keep = max(0, high - _KEPT)
        carried, low = [tokens.part(keep, len(tokens.ends))], high - keep


def _long_secrets(data: np.ndarray, field: Emissions, step: np.ndarray, of_file: np.ndarray, size: int = SEGMENT) -> list[tuple[int, int]]:
    """Byte spans in one text of any length."""
    found: list[tuple[int, int]] = []
    # Scores, spans and openness of the tokens of the stretch that goes on where a segment ends.
    held = []
    for tokens, low, high, final in segments(data, size):
        last = np.zeros(len(tokens.ends), bool)
        last[-1:] = final
        if high > low:
            emit = field.scores(tokens, of_file[None])
            held.append((emit[low:high], tokens.starts[low:high], tokens.ends[low:high], sure_outside(emit, step, last)[low:high]))
        if not held:
            continue
        emit, starts, ends, sure = [np.concatenate(parts) for parts in zip(*held, strict=True)]
        done = len(sure) if final else int(np.append(0, np.flatnonzero(sure) + 1)[-1])
        found += _spans_of(best_path(emit[:done], step, None if final else np.zeros(done, bool), sure[:done]), starts[:done], ends[:done])
        held = [(emit[done:], starts[done:], ends[done:], sure[done:])]
    return found


def _as_characters(data: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans, in order and apart, as spans of code points."""
    out, at, count = [], 0, 0
    for span in spans:
        both = []
        for place in span:
            count += int(np.count_nonzero((data[at:place] & 0xC0) != 0x80))
            at = place
            both.append(count)
        out.append(tuple(both))
    return out


def _apart(spans: list[tuple[int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the field that touch no base span."""
    ordered, at, reach, found = sorted((s, e) for _, s, e in base), 0, 0, []
    for begin, end in spans:
        # Furthest end of the base spans that start before the end of this one.
        while at < len(ordered) and ordered[at][0] < end:
            reach = max(reach, ordered[at][1])
            at += 1
        if reach <= begin:
            found.append((ADDED, begin, end))
    return found


_ORDER = {kind: k for k, kind in enumerate((*KINDS, ADDED))}


def batch_spans(texts: pa.Array, field: Emissions, step: np.ndarray) -> list[list[tuple[str, int, int]]]:
    """All spans of each text, by start and then kind. The texts are at most a segment of bytes together, or one text."""
    if not len(texts):
        return []
    values = texts.to_pylist()
    base = [base_spans(value) for value in values]
    of_file = np.stack([field.of_file(value, bool(spans)) for value, spans in zip(values, base, strict=True)])
    data, edges = buffer_of(texts)
    raw = [data[begin:end] for begin, end in zip(edges[:-1], edges[1:], strict=True)]
    if len(data) <= SEGMENT:
        found = _batch_secrets(data, edges, field, step, of_file)
    else:
        found = [_long_secrets(r, field, step, f) for r, f in zip(raw, of_file, strict=True)]
    return [sorted(own + _apart(_as_characters(r, more), own), key=lambda s: (s[1], _ORDER[s[0]])) if more else own
            for r, own, more in zip(raw, base, found, strict=True)]


def text_spans(text: str, weights: np.ndarray | Emissions, step: np.ndarray) -> list[tuple[str, int, int]]:
    field = weights if isinstance(weights, Emissions) else Emissions(weights)
    return batch_spans(pa.array([text]), field, step)[0]


# Training -------------------------------------------------------------------------------------------------------------


def _text_tokens(text: str) -> tuple[np.ndarray, Tokens]:
    """Bytes and tokens of one text of any length."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) <= SEGMENT:
        return data, tokens_of(data, np.zeros(1, np.int64))
    return data, joined([tokens.part(low, high) for tokens, low, high, _ in segments(data)])


def _character_spans(data: np.ndarray, tokens: Tokens) -> np.ndarray:
    """Code point spans of tokens, a row each."""
    ahead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.stack([ahead[tokens.starts], ahead[tokens.ends]], axis=1)


def run_features(text: str, start: int, end: int, of_file: list[str]) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Token spans of a chain and the feature numbers of each token."""
    data, tokens = _text_tokens(text[start:end])
    if not len(tokens.starts):
        return [], []
    slots = token_slots(tokens, np.tile([_slot(name) for name in of_file], (len(tokens.starts), 1)))
    spans = [(start + int(a), start + int(b)) for a, b in _character_spans(data, tokens)]
    return spans, [[int(s) for s in row if s != _FEATURES] for row in slots]


def _value_starts(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The values of base spans: without the key word and separator of an assignment."""
    return [(ASSIGN.match(text, s).start(2) if kind == "assign" else s, e) for kind, s, e in base]


def _tags(spans: np.ndarray, values: list[tuple[int, int]]) -> np.ndarray:
    """Labels of tokens: those that lie in a value are begin or inside."""
    gold = np.zeros(len(spans), np.int64)
    for begin, end in sorted(set(values)):
        inside = np.arange(np.searchsorted(spans[:, 0], begin), np.searchsorted(spans[:, 1], end, "right"))
        inside = inside[gold[inside] == OUT]
        if len(inside):
            gold[inside] = INSIDE
            gold[inside[0]] = BEGIN
    return gold


def _labels(spans: list[tuple[int, int]], base: list[tuple[str, int, int]], text: str) -> list[int]:
    """Weak labels: tokens in the value of a base span are begin or inside."""
    return _tags(np.array(spans).reshape(-1, 2), _value_starts(text, base)).tolist()


_LETTERS_DIGITS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def _respelled(value: str, rng: random.Random) -> str:
    """Another secret like ``value``: cut short, of other letters, or split by signs."""
    kind = rng.random()
    if kind < 0.25:
        return value[:rng.randint(8, max(8, len(value)))]
    size = rng.choice((8, 9, 10, 12, 14, 16, 20, 24, 32))
    letters = rng.choice((_LETTERS_DIGITS, _LETTERS_DIGITS[:26] + _LETTERS_DIGITS[52:], _LETTERS_DIGITS[26:]))
    made = "".join(rng.choice(letters) for _ in range(size))
    if kind < 0.6:
        return made
    if kind < 0.75:
        # Words with digits and signs in them, as people choose.
        return "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) + rng.choice(
            ("", "!", "-", "_", "@", "#", "$", "&")) + str(rng.randint(1, 9999)) + rng.choice(("", "", "x", "!", "abc"))
    cut = rng.randint(3, size - 3)
    return made[:cut] + rng.choice("-_.&+/!$#@") + made[cut:]


def hidden_cues(words: list[str], value: str, rng: random.Random) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Texts made of ``words`` around it and ``value``, with what is secret in them."""
    def some(low: int, high: int) -> str:
        at = rng.randrange(max(1, len(words) - high))
        return " ".join(words[at:at + rng.randint(low, high)])

    def behind(cue: str, secret: str):
        quote = rng.choice(QUOTES)
        text = f"{some(2, 5)} {cue}{quote}"
        return f"{text}{secret}{quote} {some(3, 6)}", [(len(text), len(text) + len(secret))]

    def spelled(key: str) -> str:
        return rng.choice((key, key, key.upper(), key.capitalize(), f"{rng.choice(words)}_{key}", f"{key}_{rng.choice(words)}"))

    key, separator = spelled(rng.choice(KEY_WORDS)), rng.choice(SEPARATORS)
    yield behind(key + separator, _respelled(value, rng))
    # An unknown word as the key, with a sign of assignment.
    yield behind(rng.choice(words) + rng.choice(SEPARATORS[:3]), _respelled(value, rng))
    # Words in place of the value: a phrase joined by signs, behind a key word and a separator.
    phrase = rng.choice("-_.").join(rng.choice(words) for _ in range(rng.randint(3, 4)))
    yield behind(spelled(rng.choice(KEY_WORDS[:7])) + rng.choice(SEPARATORS[:6]), phrase)
    # Not secret: key words that lead to words, a phrase or a short value without a cue, numbers behind a separator.
    word = rng.choice(KEY_WORDS)
    yield f"{some(2, 5)} {word}{rng.choice((' ', ' is ', ' was ', ', ', ' of the ', ': '))}{some(4, 8)}", []
    yield f"{some(2, 5)} {phrase if rng.random() < 0.5 else _respelled(value, rng)[:12]} {some(3, 6)}", []
    number = str(rng.randrange(10 ** rng.randint(1, 12)))
    yield f"{some(2, 5)}{rng.choice(SEPARATORS[:3])}{number} {some(3, 6)}", []


_PLAIN_WORD = re.compile(r"[^\W\d_]{2,14}")


def _pieces_of(value: str, key: int, rate: int, rounds: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a text to learn from: a number, feature numbers by token, labels."""
    data, tokens = _text_tokens(value)
    count = len(tokens.starts)
    if not count:
        return
    base = base_spans(value)
    of_file = file_slots(value, bool(base))
    spans = _character_spans(data, tokens)
    values = _value_starts(value, base)
    gold = _tags(spans, values)
    firsts = np.flatnonzero(gold == BEGIN)
    chosen = {max(0, int(i) - LEAD) for i in firsts}
    # Pieces without a secret: those at every step, by chance, and more of those around what looks like a value.
    begins = np.arange(0, count, PIECE)
    secret = np.add.reduceat(gold != OUT, begins) > 0
    kinds = np.where(tokens.shapes < _WORD_SHAPES, tokens.shapes // 24, 0)
    mixed = ((kinds & 1) > 0) | ((tokens.shapes < _WORD_SHAPES) & (tokens.shapes // 4 % 6 >= 4))
    odd = np.add.reduceat(mixed, begins) > 0
    chance = mix(begins.astype(np.uint64) + np.uint64(key & (1 << 62) - 1) * np.uint64(1 << 20)) >> np.uint64(32)
    taken = ~secret & (chance % np.where(odd, max(1, rate // 16), rate).astype(np.uint64) == 0)
    chosen |= set(begins[taken].tolist())
    slots_of = {}
    for begin in sorted(chosen):
        low, high = max(0, begin - _KEPT), min(count, begin + PIECE + _KEPT)
        near = tokens.part(low, high)
        slots_of[begin] = token_slots(near, np.tile(of_file, (high - low, 1)))[begin - low:begin - low + PIECE]
    for begin, slots in slots_of.items():
        tags = gold[begin:begin + PIECE]
        skip = 0
        if tags[0] == INSIDE:
            # A piece begins behind a value, not in it.
            skip = next((k for k, tag in enumerate(tags) if tag != INSIDE), len(tags))
        if skip < len(tags):
            yield begin, slots[skip:], tags[skip:]
    words = _PLAIN_WORD.findall(value[:1 << 16]) or ["x"]
    rng = random.Random(zlib.crc32(f"{key}/{len(value)}".encode()))
    for n, (begin, end) in enumerate(sorted(set(values)) * rounds):
        for m, (text, secrets) in enumerate(hidden_cues(words, value[begin:end], rng)):
            made, tokens = _text_tokens(text)
            lines = [_slot(f"file-settings={rng.random() < 0.5}"), _slot("file-base=False"), of_file[2]]
            slots = token_slots(tokens, np.tile(lines, (len(tokens.starts), 1)))
            yield -(n * 8 + m + 1), slots, _tags(_character_spans(made, tokens), secrets)


def train(runs: list[tuple[Sequence, Sequence]]) -> np.ndarray:
    """Weights by full-batch Adam on the conditional log-likelihood: a row for each feature, then three for transitions.
    ``runs`` are feature numbers by token (lists, or rows of an array) and labels."""
    weights = np.zeros((_FEATURES + 3, 3))
    if not any(np.any(labels) for _, labels in runs):
        weights[_slot("bias"), OUT] = 1.0
        return weights
    # Chains are padded to one length; padding is outside and masked. Features stand token after token.
    runs = [(rows[:LONGEST_RUN], labels[:LONGEST_RUN]) for rows, labels in runs]
    counts = np.array([len(labels) for _, labels in runs])
    longest, width = counts.max(), max(len(row) for rows, _ in runs for row in rows)
    ids = np.full((counts.sum(), width), _FEATURES, np.int64)
    for at, row in enumerate(row for rows, _ in runs for row in rows):
        ids[at, :len(row)] = row
    mask = (np.arange(longest) < counts[:, None]).astype(np.float64)
    real = mask > 0
    gold = np.zeros((len(runs), longest), np.int64)
    gold[real] = np.concatenate([np.asarray(labels) for _, labels in runs])
    flat, one = ids.reshape(-1), np.eye(3)
    first = second = 0.0
    for t in range(1, ROUNDS + 1):
        table = np.vstack([weights[:-3], np.zeros(3)])
        emit, step = np.zeros((len(runs), longest, 3)), _steps(weights)
        total = np.zeros((len(ids), 3))
        for k in range(width):
            total += table[ids[:, k]]
        emit[real] = total
        alpha = np.empty_like(emit)
        beta = np.zeros_like(emit)
        alpha[:, 0] = emit[:, 0] + step[OUT]
        for i in range(1, longest):
            on = np.logaddexp.reduce(alpha[:, i - 1, :, None] + step, axis=1) + emit[:, i]
            alpha[:, i] = np.where(mask[:, i, None] > 0, on, alpha[:, i - 1])
        for i in range(longest - 2, -1, -1):
            on = np.logaddexp.reduce(step + (emit[:, i + 1] + beta[:, i + 1])[:, None, :], axis=2)
            beta[:, i] = np.where(mask[:, i + 1, None] > 0, on, 0.0)
        norm = np.logaddexp.reduce(alpha[:, -1], axis=1)
        node = np.exp(alpha + beta - norm[:, None, None]) * mask[:, :, None]
        gradient = np.zeros_like(weights)
        delta = (one[gold] * mask[:, :, None] - node)
        for label in range(3):
            gradient[:-3, label] = np.bincount(flat, np.repeat(delta[:, :, label][real], width), _FEATURES + 1)[:-1]
        start = np.zeros((3, 3))
        start[OUT] = (one[gold[:, 0]] - node[:, 0]).sum(0)
        gradient[-3:] += start
        if longest > 1:
            both, ahead = mask[:, 1:], emit + beta
            seen = np.einsum("nia,nib,ni->ab", one[gold[:, :-1]], one[gold[:, 1:]], both)
            # Place by place, so that no table of all places and pairs of labels is held.
            for i in range(longest - 1):
                pair = np.exp(alpha[:, i, :, None] + step + ahead[:, i + 1, None, :] - norm[:, None, None])
                seen -= (pair * both[:, i, None, None]).sum(0)
            gradient[-3:] += seen
        gradient = gradient / len(runs) - 1e-4 * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights = weights + 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return weights


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def learn(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights from at most ``sample_rows`` rows (the least by a hash of the key) and bounded numbers of pieces of them."""
    ids = docs.select(F.col(key).cast("long").alias("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = ids.agg(F.max(F.struct(F.xxhash64("doc_id").alias("h"), "doc_id"))["h"].alias("h"), F.count(F.lit(1)).alias("n"))
    chosen, count = sample.first()
    if chosen is None:
        return train([])
    rows = _rows(docs, text, key).where(F.xxhash64("doc_id") <= F.lit(chosen))
    # One in so many pieces without a secret.
    rate = max(1, count // 100)
    rounds = max(2, min(HIDDEN, HIDDEN_ROWS // count))

    def runs(batches):
        for batch in batches:
            for part in row_chunks(batch, "text", SEGMENT):
                at, slots, labels, secret = [], [], [], []
                for key_, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for begin, features, tags in _pieces_of(value, key_ or 0, rate, rounds):
                        at.append((key_ or 0) * 31 + begin)
                        slots.append(features[:LONGEST_RUN].astype(np.int32).tobytes())
                        labels.append(tags[:LONGEST_RUN].astype(np.int8).tobytes())
                        secret.append(bool((tags != OUT).any()))
                yield pa.record_batch([
                    pa.array(at, pa.int64()), pa.array(slots, pa.binary()), pa.array(labels, pa.binary()), pa.array(secret, pa.bool_()),
                ], names=["at", "features", "labels", "secret"])

    found = written(rows.mapInArrow(runs, "at long, features binary, labels binary, secret boolean"), "pieces")
    # The driver gets a bounded number of pieces, packed.
    kept = [r for some, most in (("secret", SAMPLE_RUNS), ("NOT secret", PER_SECRET * SAMPLE_RUNS))
            for r in found.where(some).orderBy(F.xxhash64("at"), "at", "labels").limit(most).select("features", "labels").collect()]
    unpacked = ((np.frombuffer(r["features"], np.int32), np.frombuffer(r["labels"], np.int8)) for r in kept)
    return train([(features.reshape(len(labels), -1), labels) for features, labels in unpacked])


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan_secrets(docs: DataFrame, weights: np.ndarray, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its key and all spans (code points, end exclusive), by start and kind."""
    step = _steps(weights)

    def scan(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        field = Emissions(weights)
        for batch in batches:
            for part in row_chunks(batch, "text", SEGMENT):
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in found]
                         for found in batch_spans(text_column(part.column(1)), field, step)]
                yield pa.record_batch([part.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return _rows(docs, text, key).mapInArrow(scan, f"doc_id long, spans {SPANS}")


def _without(value: str, spans: list[tuple[str, int, int]], mark: str) -> str | None:
    """The text with ``mark`` in place of its spans, null where it has none."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [value[at:start], mark]
        at = max(at, end)
    return "".join(out) + value[at:] if out else None


def _redacted(values: pa.Array, field: Emissions, step: np.ndarray, mark: str) -> pa.Array:
    """The texts that change, null in place of all others. A segment of texts at a time becomes Python strings."""
    out = []
    for part in row_chunks(pa.record_batch([values], names=["text"]), "text", SEGMENT):
        spans = batch_spans(text_column(part.column(0)), field, step)
        out += [_without(value, found, mark) if value else None
                for value, found in zip(part.column(0).to_pylist(), spans, strict=True)]
    return pa.array(out, pa.string())


def redact_secrets(docs: DataFrame, weights: np.ndarray, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` written as ``mark``; null texts stay null and all columns stay."""
    step = _steps(weights)

    @F.arrow_udf("string")
    def redacted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        field = Emissions(weights)
        for values in batches:
            yield _redacted(values, field, step, mark)

    return docs.withColumn(text, F.coalesce(redacted(F.col(text)), F.col(text)))


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan_secrets(docs, learn(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    counts = [F.size(F.filter("spans", _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
