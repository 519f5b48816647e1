"""Benchmark decontamination with a generalised suffix automaton of normalised test items.

The automaton holds every run of words of every item. Training words stream through it while the longest match that ends
at each word is tracked; a match of ``window`` words or more, or of a whole item that is shorter, marks its words. Texts
are read in segments, so a long text needs no more memory than a short one.

Items are the small side: they are dealt into shards of about ``SHARD_BYTES`` of text by a hash of the item, so an item is
never divided, and a task builds the automaton of each shard and writes it to the shared folder. A pass over the documents
takes ``PER_PASS`` automata, which are all that the driver and the tasks hold of the items at once. A benchmark of so many
shards needs one pass and no shuffle. A larger one is matched pass by pass: all but the last write what they hit, by a
128-bit hash of the text and only for texts that are hit, and the last takes that up.

Defined cases: null texts and items have no words; an item without words matches nothing; equal items all count, an item
id that occurs twice counts once, and items without an id count under the empty name; repeated rows are matched each; other
columns are ignored whatever their names; without documents or items nothing is hit.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.stored import written
from fleetlens.llm.words import FOLD, alnum_words, row_chunks, text_column

WINDOW = 10
SHARD_BYTES = 1 << 20
PER_PASS = 4
SEGMENT = 1 << 20
# A text with more than this share of its words in test items is dropped, not cut.
MAX_COVERAGE = 0.5

_CLASSES = alnum_words()
_FOLDED = bytes(int(FOLD[b]) if _CLASSES[b] else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLDED).split()


class SuffixAutomaton:
    """States of all runs of words of the items; ``moves[s]`` leads on, ``link[s]`` to the longest proper suffix."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.moves: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[set[str]] = [set()]
        texts = []
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            texts.append((name, ids))
            last = 0
            for word in ids:
                last = self._extend(last, word)
                self.items[last].add(name)
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True)
        for state in by_length:
            parent = self.link[state]
            if self.length[parent] >= window:
                self.items[parent] |= self.items[state]
        # The state of the last ``window`` words of a match, by the state of the match.
        self.window_state = [0] * len(self.link)
        self.whole: list[list[tuple[int, str]]] = [[] for _ in self.link]
        for name, ids in texts:
            if 0 < len(ids) < window:
                state = 0
                for word in ids:
                    state = self.moves[state][word]
                self.whole[state].append((len(ids), name))
        for state in reversed(by_length):
            parent = self.link[state]
            self.window_state[state] = self.window_state[parent] if self.length[parent] >= window else state
            self.whole[state] = self.whole[state] + self.whole[parent]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.moves.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.items.append(set())
        return len(self.link) - 1

    def _split(self, before: int, state: int, word: int) -> int:
        """The part of ``state`` whose runs have at most one word more than ``before``."""
        if self.length[state] == self.length[before] + 1:
            return state
        copy = self._state(self.length[before] + 1, dict(self.moves[state]), self.link[state])
        self.link[state] = copy
        while before >= 0 and self.moves[before].get(word) == state:
            self.moves[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.moves[last]:
            return self._split(last, self.moves[last][word], word)
        state = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.moves[at]:
            self.moves[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split(at, self.moves[at][word], word)
        return state

    def match(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, spans of hit words (counted in words, apart from each other), and names of the items."""
        data = text.encode().translate(_FOLDED)
        moves, link, length, whole, window = self.moves, self.link, self.length, self.whole, self.window
        find = self.vocabulary.get
        spans: list[tuple[int, int]] = []
        states, names = set(), set()
        state = size = place = begin = 0

        def mark(start: int, end: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, end))

        while begin < len(data):
            end = data.find(b" ", begin + SEGMENT)
            end = len(data) if end < 0 else end
            for place, word in enumerate(map(find, data[begin:end].split()), place + 1):
                if word is None:
                    state = size = 0
                    continue
                while state and word not in moves[state]:
                    state = link[state]
                    size = length[state]
                if word not in moves[state]:
                    continue
                state = moves[state][word]
                size += 1
                if size >= window:
                    mark(place - window, place)
                    states.add(state)
                if whole[state]:
                    for count, name in whole[state]:
                        if count <= size:
                            mark(place - count, place)
                            names.add(name)
            begin = end
        for state in states:
            names |= self.items[self.window_state[state]]
        return place, spans, names


def _union(one: list[tuple[int, int]], two: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted([*one, *two]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


class _Packed:
    """An automaton as bytes, which is unpacked where it is used and not on the driver."""

    def __init__(self, data: bytes):
        self.data = data

    def __reduce__(self):
        return pickle.loads, (self.data,)


def built_shards(items: DataFrame, text: str, key: str, window: int, shard_bytes: int) -> tuple[DataFrame, int]:
    """A stored table of ``shard`` and its packed ``automaton``, and the number of shards."""
    rows = items.select(F.col(key).cast("string").alias("name"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    count = max(1, -(-size // shard_bytes))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        held = frame.sort_values(["name", "text"], na_position="first")
        automaton = SuffixAutomaton([(name or "", split_words(value)) for name, value in zip(held["name"], held["text"], strict=True)], window)
        return pd.DataFrame({"shard": frame["shard"].iloc[:1], "automaton": [pickle.dumps(automaton, pickle.HIGHEST_PROTOCOL)]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("name", "text"), F.lit(count)).cast("int"))
    return written(dealt.groupBy("shard").applyInPandas(build, "shard int, automaton binary"), "automata"), count


def _passes(spark: SparkSession, built: DataFrame, count: int, per_pass: int) -> Iterator[tuple[list, bool]]:
    """Broadcast automata of each pass in turn, and whether it is the last. Shards without items are not there."""
    for begin in range(0, count, per_pass):
        rows = built.where(F.col("shard").between(begin, begin + per_pass - 1)).orderBy("shard").collect()
        yield [spark.sparkContext.broadcast(_Packed(bytes(r["automaton"]))) for r in rows], begin + per_pass >= count


def _match_all(shared: Sequence, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
    """What several automata find in a text together."""
    count, spans, names = 0, [], set()
    for automaton in shared:
        count, new, hit = automaton.match(text)
        spans = _union(spans, new) if spans else new
        names |= hit
    # Without any automaton the words still count.
    return count if shared else len(split_words(text)), spans, names


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SPANS = "array<struct<start:long,end:long>>"
_HIT = f"h1 long, h2 long, spans {_SPANS}, items array<string>"
# Two hashes name a text.
_NAMED = {"h1": (17,), "h2": (42,)}


def _named(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumns({name: F.xxhash64(F.col(text), *[F.lit(v) for v in salt]) for name, salt in _NAMED.items()})


def _hits(texts: DataFrame, shared: list) -> DataFrame:
    """The texts that a pass hits, by name, once each."""

    def match(batches):
        automata = [s.value for s in shared]
        for batch in batches:
            for part in row_chunks(batch, "text"):
                rows = []
                for h1, h2, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), text_column(part.column(2)).to_pylist(), strict=True):
                    _, spans, names = _match_all(automata, value)
                    if spans:
                        rows.append((h1, h2, [{"start": s, "end": e} for s, e in spans], sorted(names)))
                h1, h2, spans, names = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield pa.record_batch([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(spans, _SPAN),
                                       pa.array(names, pa.list_(pa.string()))], names=["h1", "h2", "spans", "items"])

    return texts.mapInArrow(match, _HIT).dropDuplicates(["h1", "h2"])


def _earlier_hits(docs: DataFrame, text: str, items: DataFrame, item_text: str, item_key: str, window: int, shard_bytes: int,
                  per_pass: int) -> tuple[list, DataFrame | None]:
    """The automata of the last pass, and by name of the text what the passes before it hit, if there are any."""
    built, count = built_shards(items, item_text, item_key, window, shard_bytes)
    texts = _named(docs.select(F.col(text).alias("text")), "text").select("h1", "h2", "text")
    found = []
    for shared, last in _passes(docs.sparkSession, built, count, per_pass):
        if last:
            break
        found.append(written(_hits(texts, shared), "hits"))
        for automaton in shared:
            automaton.destroy()
    if not found:
        return shared, None
    # A text has a row of each pass at most.
    both = reduce(DataFrame.unionByName, found).groupBy("h1", "h2").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return shared, both


def match_items(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
                item_key: str = "item_id", window: int = WINDOW, shard_bytes: int = SHARD_BYTES, per_pass: int = PER_PASS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, hit ``spans`` in words and names of ``items``."""
    shared, before = _earlier_hits(docs, text, items, item_text, item_key, window, shard_bytes, per_pass)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if before is None:
        rows = rows.withColumns({"spans": F.lit(None).cast(_SPANS), "items": F.lit(None).cast("array<string>")})
    else:
        rows = _named(rows, "text").join(before, ["h1", "h2"], "left").select("doc_id", "text", "spans", "items")

    def match(batches):
        automata = [s.value for s in shared]
        for batch in batches:
            for part in row_chunks(batch, "text"):
                counts, spans, names = [], [], []
                columns = (text_column(part.column(1)), part.column(2), part.column(3))
                for value, old, known in zip(*(c.to_pylist() for c in columns), strict=True):
                    count, new, hit = _match_all(automata, value)
                    merged = _union([(s["start"], s["end"]) for s in old], new) if old else new
                    counts.append(count)
                    spans.append([{"start": s, "end": e} for s, e in merged])
                    names.append(sorted(hit | set(known or ())))
                yield pa.record_batch([part.column(0), pa.array(counts, pa.int64()), pa.array(spans, _SPAN),
                                       pa.array(names, pa.list_(pa.string()))], names=["doc_id", "n_words", "spans", "items"])

    return rows.mapInArrow(match, f"doc_id long, n_words long, spans {_SPANS}, items array<string>")


def hit_words(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from the first to the last word of each span."""
    data = text.encode()
    edges = [m.span() for m in _WORD.finditer(data.translate(_FOLDED))]
    out, at = [], 0
    for start, end in spans:
        out.append(data[at:edges[start][0]])
        at = edges[end - 1][1]
    return b"".join([*out, data[at:]]).decode()


def _cleaned(values: pa.Array, earlier: pa.Array, automata: Sequence, max_coverage: float) -> pa.Array:
    """For each text, itself without its spans (null where it stays as it is) and whether its row goes. ``earlier``: starts
    and ends of spans in turn. Texts become Python strings a megabyte at a time, and only those that change are returned."""
    cuts, dropped = [], []
    for part in row_chunks(pa.record_batch([values, earlier], names=["text", "earlier"]), "text"):
        for value, flat in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            if not value:
                cuts.append(None)
                dropped.append(False)
                continue
            count, spans, _ = _match_all(automata, value)
            if flat:
                spans = _union(list(zip(flat[::2], flat[1::2], strict=True)), spans)
            covered = sum(end - start for start, end in spans)
            cuts.append(cut_spans(value, spans) if spans else None)
            dropped.append(bool(covered) and covered > max_coverage * count)
    return pa.StructArray.from_arrays([pa.array(cuts, pa.string()), pa.array(dropped, pa.bool_())], names=["cut", "dropped"])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", max_coverage: float = MAX_COVERAGE,
                  window: int = WINDOW, shard_bytes: int = SHARD_BYTES, per_pass: int = PER_PASS) -> DataFrame:
    """``docs`` without rows covered over ``max_coverage`` and without the hit spans of the others; all columns stay."""
    shared, before = _earlier_hits(docs, text, items, "text", "item_id", window, shard_bytes, per_pass)

    @F.arrow_udf("struct<cut:string,dropped:boolean>")
    def cleaned(values: pa.Array, earlier: pa.Array) -> pa.Array:
        return _cleaned(values, earlier, [s.value for s in shared], max_coverage)

    # Whole rows travel as one column, so that no column of theirs can clash.
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    flat = F.lit(None).cast("array<long>")
    if before is not None:
        rows = _named(rows, "text").join(before, ["h1", "h2"], "left")
        flat = F.flatten(F.transform("spans", lambda s: F.array(s["start"], s["end"])))
    # Said to be nondeterministic so that it runs once for the filter and the text.
    done = rows.select("row", cleaned.asNondeterministic()(F.col("text"), flat).alias("clean")).where(~F.col("clean.dropped"))
    cut = F.coalesce(F.col("clean.cut"), F.col("row")[text])
    return done.select(*[cut.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = match_items(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hits = found.select("doc_id", "n_words", hit_words().alias("n_hit"), "items")
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = rf"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark),
windows AS (
  SELECT id, least(len(w), {WINDOW}) AS n, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS i, w
  FROM item_words WHERE len(w) > 0),
runs AS (SELECT DISTINCT id, n, md5_number(array_to_string(w[i:i + n - 1], ' ')) AS h FROM windows),
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
places AS (
  SELECT doc_id, n, unnest(generate_series(1, len(w) - n + 1)) AS i, w
  FROM words, (SELECT DISTINCT n FROM runs) WHERE len(w) >= n),
hits AS (
  SELECT p.doc_id, p.n, p.i, r.id
  FROM (SELECT doc_id, n, i, md5_number(array_to_string(w[i:i + n - 1], ' ')) AS h FROM places) p JOIN runs r
    ON p.n = r.n AND p.h = r.h),
hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS j FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, id FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words h ON h.doc_id = w.doc_id LEFT JOIN hit_items t ON t.doc_id = w.doc_id
"""
