"""Removal of word sequences that repeat, found by recompression.

A window is ``WINDOW`` consecutive words of one document; a word goes if it lies in a window whose words also start
anywhere else, the same document included. All windows are judged on the input.

Rounds of recompression (``recompression.py``) name runs and pairs of tokens globally, so equal windows share a high-level
symbol, their anchor, at the same place. Names are hashes of what they stand for, which makes a round local: what crosses
the cluster are the anchors, one row for a stretch of windows with the same one. Then

1. names of anchors are counted (equal stretches within a chunk of rows, then by the aggregation before the shuffle); a name
   that occurs once has no repeat;
2. stretches of one name that spell the same words repeat each other, and nothing more is asked of them;
3. the other stretches of such a name, and one of each kind of those in 2, are spelled out as hashes of the words of each
   window, and these are counted;
4. documents drop the words of the windows that repeat.

Texts are shuffled once, compressed, and that shuffle serves steps 3 and 4. Equal stretches are found by looking at the
neighbour in sorted order, in constant memory, and hot windows by a join on counts, whose skewed keys Spark splits; nothing
is grouped but the stretches of one document. Long documents are named in parts
that overlap by a window.

Defined cases: null, empty and short texts have no window and keep their words; repeated rows repeat each other's windows;
rows with a null key are documents too; other columns are ignored, whatever their names; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.recompression import anchors
from fleetlens.llm.words import PLAIN, long_names, mix, powers, row_chunks, space_words, text_column, word_names

WINDOW = 35
LEVELS = (0, 3)
# Words named at once; longer documents are named in parts.
PART = 1 << 17
# Bits below the first window in a packed place: two for the times, the others for the number of windows.
_PLACE_BITS = 20
_CLASSES = space_words()


def _spelled(words: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Names of the word sequences of ``count`` words from ``start``."""
    ahead, back = powers(len(words) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * ahead[:len(words)], dtype=np.uint64)])
    return mix((total[start + count] - total[start]) * back[start] + count.astype(np.uint64))


def _groups(counts: np.ndarray, window: int):
    """Ranges of words to be named at once, as lists of (document, first word, last word) of PART words about."""
    group, size = [], 0
    for doc, count in enumerate(counts.tolist()):
        begin = 0
        while count - begin >= window:
            end = min(count, begin + PART)
            if group and size + end - begin > PART:
                yield group
                group, size = [], 0
            group.append((doc, begin, end))
            size += end - begin
            if end == count:
                break
            begin = end - window + 1
    if group:
        yield group


def stretches(names: np.ndarray, counts: np.ndarray, window: int = WINDOW):
    """Stretches of windows with one anchor: document, first window, number of windows, anchor name, name of the words."""
    first = np.cumsum(counts) - counts
    out = []
    for group in _groups(counts, window):
        parts, border, doc, word = [np.zeros(1, np.uint64)], [np.ones(1, bool)], [[0]], [[0]]
        for d, begin, end in group:
            parts += [names[first[d] + begin:first[d] + end], np.zeros(1, np.uint64)]
            border += [np.zeros(end - begin, bool), np.ones(1, bool)]
            doc.append(np.full(end - begin + 1, d))
            word.append(np.arange(begin, end + 1))
        words, doc, word = np.concatenate(parts), np.concatenate(doc), np.concatenate(word)
        start, name, place = anchors(words, np.concatenate(border), window, LEVELS)
        new = np.ones(len(start), bool)
        new[1:] = (name[1:] != name[:-1]) | (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(start)))
        at = start[head]
        out.append((doc[at], word[at], count, name[head], _spelled(words, at, count + window - 1)))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Rows with a join key: the document's key and a 64-bit hash of its text, for null keys and keys of several rows."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("t"), "text")


def _first_of_kind(anchor: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For the first of each kind of equal stretches, how many there are; 0 for the others."""
    _, first, times = np.unique(mix(anchor) + words, return_index=True, return_counts=True)
    out = np.zeros(len(anchor), np.int32)
    out[first] = times
    return out


def _anchored(rows: DataFrame, window: int) -> DataFrame:
    """Stretches of all rows. ``place`` packs the first window, the number of windows and how often the stretch occurs in
    its chunk of rows (2 for more): equal ones are counted at the first of them. The others (0) are known to repeat, so
    their anchors are replaced by what spreads them."""

    def name(batches):
        for batch in batches:
            for part in row_chunks(batch, "text"):
                names, counts = word_names(text_column(part.column(2)), _CLASSES, PLAIN)
                doc, start, count, anchor, words = stretches(names, counts, window)
                at, times = pa.array(doc), _first_of_kind(anchor, words)
                keys = part.column(0).take(at)
                spread = mix(mix(keys.to_numpy().view(np.uint64)) + start.astype(np.uint64))
                place = (start.astype(np.int64) << _PLACE_BITS) + count * 4 + np.minimum(times, 2)
                yield pa.record_batch([
                    keys, part.column(1).take(at), pa.array(place), pa.array(long_names(np.where(times > 0, anchor, spread))),
                    pa.array(long_names(np.where(times > 0, words, np.uint64(0)))),
                ], names=["k", "t", "place", "anchor", "words"])

    return rows.select("k", "t", "text").mapInArrow(name, "k long, t long, place long, anchor long, words long")


def _compressed(rows: DataFrame) -> DataFrame:
    """Texts as they cross the cluster."""

    def press(batches):
        compressor = zstandard.ZstdCompressor(level=5)
        for batch in batches:
            for part in row_chunks(batch, "text"):
                packed = [compressor.compress(value.encode()) for value in text_column(part.column(3)).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(1), part.column(2), pa.array(packed, pa.binary())],
                                      names=["doc_id", "k", "t", "packed"])

    return rows.mapInArrow(press, "doc_id long, k long, t long, packed binary")


def _unpacked(column) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(value) for value in column.to_pylist()]


def _small(batch: pa.RecordBatch):
    for begin in range(0, batch.num_rows, 256):
        yield batch.slice(begin, 256)


def _spelled_windows(doubtful: DataFrame, window: int) -> DataFrame:
    """Hashes of the windows of the stretches to be spelled out."""

    def spell(batches):
        for batch in batches:
            for part in _small(batch):
                texts = pa.array([value.decode() for value in _unpacked(part.column(2))], pa.large_string())
                names, counts = word_names(texts, _CLASSES, PLAIN)
                ends = np.cumsum(counts)
                rows, starts, hashes = [], [], []
                for row, ranges in enumerate(part.column(3).to_pylist()):
                    words = names[ends[row] - counts[row]:ends[row]]
                    at = [np.arange(r["start"], r["start"] + r["n"]) for r in ranges if r["spell"]]
                    at = np.unique(np.concatenate(at)) if at else np.zeros(0, np.int64)
                    for begin in range(0, len(at), PART):
                        some = at[begin:begin + PART]
                        low = int(some[0])
                        near = words[low:int(some[-1]) + window]
                        hashes.append(_spelled(near, some - low, np.full(len(some), window)))
                    starts.append(at.astype(np.int32))
                    rows.append(np.full(len(at), row))
                if hashes:
                    at = pa.array(np.concatenate(rows))
                    yield pa.record_batch([
                        part.column(0).take(at), part.column(1).take(at), pa.array(np.concatenate(starts)),
                        pa.array(long_names(np.concatenate(hashes))),
                    ], names=["k", "t", "start", "words"])

    return doubtful.mapInArrow(spell, "k long, t long, start int, words long")


def repeated_mask(count: int, ranges, singles, window: int) -> np.ndarray:
    """Words in any of the repeated windows, given as stretches and as single starts."""
    edge = np.zeros(count + 1, np.int64)
    for r in ranges or ():
        if r["sure"]:
            edge[r["start"]] += 1
            edge[min(count, r["start"] + r["n"] + window - 1)] -= 1
    singles = np.asarray(singles if singles is not None else (), np.int64)
    np.add.at(edge, singles, 1)
    np.add.at(edge, np.minimum(count, singles + window), -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and the ``kept`` words, joined by spaces."""
    rows = _keyed(docs, text, key)
    found = _anchored(rows, window)
    times = F.col("place") % 4
    counted = found.where(times > 0).groupBy("anchor").agg(
        F.sum(times).alias("total"), (F.min("words") != F.max("words")).alias("mixed"))
    repeated = found.join(counted.where("total > 1").select("anchor", "mixed"), "anchor", "left")
    repeated = repeated.where(F.col("mixed").isNotNull() | (times == 0))
    alike = Window.partitionBy("anchor", "words").orderBy("k", "t", "place")
    repeated = repeated.withColumns({
        "first": F.lag("place").over(alike).isNull(), "last": F.lead("place").over(alike).isNull(), "times": times,
        "start": F.shiftright("place", _PLACE_BITS).cast("int"),
        "n": (F.shiftright("place", 2) % (1 << _PLACE_BITS - 2)).cast("int"),
    })
    sure = (F.col("times") != 1) | ~(F.col("first") & F.col("last"))
    spell = F.coalesce(F.col("mixed") & F.col("first"), F.lit(False))
    stretch = F.struct("start", "n", sure.alias("sure"), spell.alias("spell"))
    ranges = repeated.groupBy("k", "t").agg(F.collect_set(stretch).alias("ranges"))
    texts = _compressed(rows)
    doubtful = texts.join(ranges.where(F.exists("ranges", lambda r: r["spell"])), ["k", "t"]).select("k", "t", "packed", "ranges")
    windows = _spelled_windows(doubtful, window)
    twice = windows.groupBy("words").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    # Joined by the complement: both sides are shuffled for the join then, and Spark can split a skewed key.
    singles = windows.select("k", "t", "start", F.bitwise_not("words").alias("w")).join(
        twice.select(F.bitwise_not("words").alias("w")), "w").groupBy("k", "t").agg(F.collect_set("start").alias("singles"))
    whole = texts.join(ranges, ["k", "t"], "left").join(singles, ["k", "t"], "left")

    def cut(batches):
        for batch in batches:
            for part in _small(batch):
                totals, removed, kept = [], [], []
                columns = (part.column(2).to_pylist(), part.column(3).to_pylist())
                for value, *gone in zip(_unpacked(part.column(1)), *columns, strict=True):
                    words = value.split()
                    mask = repeated_mask(len(words), *gone, window) if any(gone) else np.zeros(len(words), bool)
                    totals.append(len(words))
                    removed.append(int(mask.sum()))
                    left = words if not removed[-1] else [words[i] for i in np.flatnonzero(~mask)]
                    kept.append(b" ".join(left))
                yield pa.record_batch([part.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                                       pa.array(kept, pa.binary()).cast(pa.string())],
                                      names=["doc_id", "n_words", "n_removed", "kept"])

    return whole.select("doc_id", "packed", "ranges", "singles").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = rf"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i, w FROM words WHERE len(w) >= {WINDOW}),
hashed AS (SELECT doc_id, i, md5_number(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h FROM windows),
twice AS (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + {WINDOW - 1})) AS i FROM hashed JOIN twice USING (h)),
marked AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_transform(list_filter(list_zip(w, generate_series(1, len(w))),
    lambda p: gone IS NULL OR NOT list_contains(gone, p[2])), lambda p: p[1]), ' ')) AS kept_sha256
FROM words d LEFT JOIN marked m USING (doc_id)
"""
