"""MinHash near-duplicates with tensored banding, every link confirmed on full shingle sets.

Texts with equal shingle sets form one class, found by a hash of the whole set, and only classes go on. Each class has two
collections of ``SIDES`` short keys (``HALF`` minhashes each); a table key is a pair with one of either, so ``SIDES ** 2``
tables of ``2 * HALF`` minhashes cost ``2 * SIDES * HALF`` of them, about a square root of what separate tables would. A
pair of similarity s meets in some table with probability ``(1 - (1 - s ** HALF) ** SIDES) ** 2``: 0.999 at 0.85, 0.9999
at 0.9.

Classes that only share boilerplate meet as well, and components of all that meet would run together. So those that meet
are held against each other by codes first: a set's hashes fall into ``BINS`` bins, and the code keeps one bit of the least
hash of each. Codes of linked sets differ in more than ``_limit`` bins less than once in 100,000 pairs; of longer sets those of
similarity 0.65 pass about as rarely, of short ones more do, which cost little to compare. A bucket is searched from class to class among those not reached yet, so n copies
cost n comparisons, and only classes that do not look alike are held against all others; a bucket beyond ``ROWS`` is cut
into blocks, and each pair of blocks is a task.

Components of what is left are the clusters, and each is compared in full on the sets. A cluster beyond ``BLOCK`` is cut by
size class, as sets of too different size cannot be linked, and into blocks, and each pair of blocks is a task. A task
counts common shingles of all its pairs at once, but returns only a spanning forest of the links, so a group of n copies
gives n rows, never n squared. Memory of a task is bounded by two blocks or one document.

Defined cases: a text with fewer words than a shingle is one shingle; null, empty and blank texts have none and are linked
with nothing, not even with each other; rows with equal text, repeated keys among them, are one class; a null key never
names a component unless all keys there are null; other columns are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.components import components
from fleetlens.llm.labelled import text_rows
from fleetlens.llm.words import (
    FOLD, long_names, mix, row_chunks, sequence_name, shingle_names, space_words, text_column, word_names,
)
from fleetlens.session import ensure_checkpoint_dir

SHINGLE = 5
PERCENT = 85
HALF, SIDES = 3, 8
# Bins of a set's code (a power of two), and the deviations that codes of linked sets may lie beyond what is expected.
BINS = 1024
DEVIATIONS = 4.5
# Classes of a block in which codes are compared.
ROWS = 8192
# Shingles of a block; a document weighs DOC_WEIGHT more than its shingles, which bounds the documents too.
BLOCK = 200_000
DOC_WEIGHT = 256
# Sets of linked documents lie in the same or in neighbouring classes of this width.
_SIZE_STEP = math.log(100 / (PERCENT - 1))
_COLUMNS = 4096
_CLASSES = space_words()
_rng = np.random.Generator(np.random.PCG64(85))
_FLIPS = _rng.integers(0, 1 << 63, 2 * SIDES * HALF, dtype=np.uint64)
_FACTORS = _rng.integers(0, 1 << 63, 2 * SIDES * HALF, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# Shingles of a set that are hashed at once.
_STRIP = 1 << 14


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle names of each text."""
    names, counts = word_names(texts, _CLASSES, FOLD)
    out, begin = [], 0
    for count in counts.tolist():
        words = names[begin:begin + count]
        begin += count
        if count >= SHINGLE:
            out.append(np.unique(shingle_names(words, SHINGLE)))
        else:
            out.append(sequence_name(words) if count else np.zeros(0, np.uint64))
    return out


def short_keys(found: np.ndarray) -> np.ndarray:
    """The 2 * SIDES short keys of a set."""
    least = np.full(len(_FLIPS), np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(found), _STRIP):
        hashed = (found[begin:begin + _STRIP, None] ^ _FLIPS) * _FACTORS
        hashed ^= hashed >> np.uint64(32)
        np.minimum(least, hashed.min(0), out=least)
    keys = np.zeros(2 * SIDES, np.uint64)
    for column in least.reshape(2 * SIDES, HALF).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys


def code(found: np.ndarray) -> np.ndarray:
    """One bit of the least hash in each bin, zero where the bin is empty, as BINS / 64 names."""
    hashed = np.sort(mix(found ^ np.uint64(0x2545F4914F6CDD1D)))
    bins = (hashed >> np.uint64(65 - BINS.bit_length())).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    bits = np.zeros(BINS, np.uint8)
    bits[bins[first]] = hashed[first].astype(np.uint8) & 1
    return np.packbits(bits).view(np.uint64)


def set_name(found: np.ndarray) -> int:
    """Name of a whole set, the same for equal sets."""
    total = np.array([np.sum(mix(found ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64) + np.uint64(len(found))], np.uint64)
    return int(long_names(mix(total))[0])


def _signed(rows: DataFrame) -> DataFrame:
    def sign(batches):
        for batch in batches:
            for part in row_chunks(batch, "text"):
                sets = shingle_sets(text_column(part.column(1)))
                keys = [long_names(short_keys(found)) if len(found) else [] for found in sets]
                yield pa.record_batch([
                    part.column(0), part.column(2), pa.array([len(found) for found in sets], pa.int64()),
                    pa.array([set_name(found) for found in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                    pa.array([long_names(code(found)) if len(found) else [] for found in sets], pa.list_(pa.int64())),
                ], names=["doc_id", "text_hash", "n_shingles", "name", "keys", "code"])

    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    return hashed.mapInArrow(
        sign, "doc_id long, text_hash long, n_shingles long, name long, keys array<long>, code array<long>")


def _limit(least, exp, sqrt):
    """How many bins the codes of two linked sets may differ in, the smaller of ``least`` shingles. Their union has at most
    100 / PERCENT as many, which fill so many bins; in a share of these the least hashes differ, every second in its bit."""
    filled = BINS * (1 - exp(least * (-100 / PERCENT / BINS)))
    share = (100 - PERCENT) / 200
    return filled * share + sqrt(filled * (share * (1 - share))) * DEVIATIONS + 1


def look_alike(size: int, own: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Which sets may be linked with the one of this size and code."""
    differ = np.bitwise_count(codes ^ own).sum(1, dtype=np.int64)
    least, most = np.minimum(sizes, size), np.maximum(sizes, size)
    return (differ <= _limit(least, np.exp, np.sqrt)) & (100 * least >= PERCENT * most)


def alike_forest(sizes: np.ndarray, codes: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Edges that keep the components of sets that look alike; where there are two sides, of pairs across them."""
    left, out, across = np.arange(len(sizes)), [], bool(side.any())
    while len(left):
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            node = frontier.pop()
            hit = look_alike(sizes[node], codes[node], sizes[left], codes[left])
            if across:
                hit &= side[left] != side[node]
            reached, left = left[hit].tolist(), left[~hit]
            out += [(node, other) for other in reached]
            frontier += reached
    return out


def _alike(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("key", kind="stable")
    names, sizes, side = (group[column].to_numpy() for column in ("name", "n_shingles", "side"))
    codes = np.stack(group["code"].to_numpy()).view(np.uint64)
    edges, begins = [], np.flatnonzero(np.diff(group["key"].to_numpy()) != 0) + 1
    for low, high in zip([0, *begins.tolist()], [*begins.tolist(), len(names)], strict=True):
        edges += [(low + u, low + v) for u, v in alike_forest(sizes[low:high], codes[low:high], side[low:high])]
    found = np.array(edges, np.int64).reshape(-1, 2)
    return pd.DataFrame({"u": names[found[:, 0]], "v": names[found[:, 1]]})


def _candidates(classes: DataFrame) -> DataFrame:
    """Edges between classes that share a table key and look alike, a spanning forest of each bucket."""
    table = F.transform(F.sequence(F.lit(0), F.lit(SIDES**2 - 1)), lambda t: F.xxhash64(
        t, F.element_at("keys", (t / SIDES).cast("int") + 1), F.element_at("keys", SIDES + 1 + t % SIDES)))
    keyed = classes.select("name", F.explode(table).alias("key"))
    codes = classes.select("name", "n_shingles", "code")
    # Two names of a bucket's members: buckets of the same members, as copies make in many tables, are searched once.
    buckets = keyed.groupBy("key").agg(
        F.min("name").alias("u"), F.max("name").alias("v"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("name")).alias("a"), F.bit_xor(F.xxhash64("name", F.lit(1))).alias("b")).where("n > 1").checkpoint()

    pairs = buckets.where("n = 2").select("u", "v").distinct()
    for end in "uv":
        pairs = pairs.join(codes.select(F.col("name").alias(end), F.col("n_shingles").alias(f"n_{end}"),
                                        F.col("code").alias(f"code_{end}")), end)
    differ = F.aggregate(F.zip_with("code_u", "code_v", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    least, most = F.least("n_u", "n_v"), F.greatest("n_u", "n_v")
    near = pairs.where((differ <= _limit(least, F.exp, F.sqrt)) & (100 * least >= PERCENT * most)).select("u", "v")

    larger = buckets.where("n > 2").groupBy("n", "a", "b").agg(F.min("key").alias("key"))
    own, blocks = F.col("block"), F.ceil(F.col("n") / ROWS).cast("int")
    tasks = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(
        F.least(b, own).alias("low"), F.greatest(b, own).alias("high"), (b < own).cast("int").alias("side")))
    members = keyed.join(larger.select("key", blocks.alias("blocks")), "key").withColumn(
        "block", F.pmod(F.xxhash64("name", "key"), F.col("blocks")).cast("int"))
    # Most buckets are small: those that need no blocks share a group with others, about ROWS classes in each.
    packs = (buckets.where("n > 2").agg(F.sum("n")).first()[0] or 0) // ROWS + 1
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("key", F.lit(2)), F.lit(packs))).otherwise(F.col("key"))
    dealt = members.withColumn("pack", pack).join(codes, "name").select(
        "key", "pack", "name", "n_shingles", "code", F.explode(tasks).alias("task")).select(
        "key", "pack", "task.*", "name", "n_shingles", "code")
    stars = dealt.groupBy("pack", "low", "high").applyInPandas(_alike, "u long, v long")
    return near.union(stars).distinct()


def _tasks(members: DataFrame) -> DataFrame:
    """``name``, ``first_doc`` and the ``tasks`` that compare each member with all others it could be linked with."""
    weight = F.col("n_shingles") + DOC_WEIGHT
    level = F.floor(F.log(F.col("n_shingles").cast("double")) / _SIZE_STEP).cast("int")
    placed = members.withColumns({"weight": weight, "level": level})
    levels = placed.groupBy("cluster", "level").agg(F.sum("weight").alias("weight"))
    blocks = levels.withColumn("blocks", F.ceil(F.col("weight") / BLOCK).cast("int")).groupBy("cluster").agg(
        F.sum("weight").alias("total"), F.map_from_entries(F.collect_list(F.struct("level", "blocks"))).alias("blocks"))
    placed = placed.join(blocks, "cluster")

    def parts(level):
        return F.coalesce(F.try_element_at("blocks", level), F.lit(0))

    own = F.col("level")
    block = F.pmod(F.xxhash64("name"), parts(own)).cast("int")

    def numbers(level):
        return F.filter(F.sequence(F.lit(0), F.greatest(parts(level) - 1, F.lit(0))), lambda b: b < parts(level))

    def task(low, low_block, high, high_block, side):
        return F.struct(low.alias("low"), low_block.alias("low_block"), high.alias("high"), high_block.alias("high_block"),
                        side.alias("side"))

    one, zero = F.lit(1), F.lit(0)
    among = F.transform(numbers(own), lambda b: task(own, F.least(b, F.col("block")), own, F.greatest(b, F.col("block")),
                                                     F.when(b < F.col("block"), one).otherwise(zero)))
    above = F.transform(numbers(own + 1), lambda b: task(own, F.col("block"), own + 1, b, zero))
    below = F.transform(numbers(own - 1), lambda b: task(own - 1, b, own, F.col("block"), one))
    whole = F.array(task(F.lit(-1), zero, F.lit(-1), zero, zero))
    placed = placed.withColumn("block", block)
    tasks = F.when(F.col("total") <= BLOCK, whole).otherwise(F.concat(among, above, below))
    return placed.select("name", "first_doc", "cluster", tasks.alias("tasks"))


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Number of common shingles of every pair."""
    sizes = [len(found) for found in sets]
    names, slot, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    column = np.full(len(names), -1)
    column[shared] = np.arange(len(shared))
    where, row = column[slot], np.repeat(np.arange(len(sets)), sizes)
    row, where = row[where >= 0], where[where >= 0]
    order = np.argsort(where, kind="stable")
    row, where = row[order], where[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for begin in range(0, len(shared), _COLUMNS):
        low, high = np.searchsorted(where, [begin, begin + _COLUMNS])
        strip = np.zeros((len(sets), min(_COLUMNS, len(shared) - begin)), np.float32)
        strip[row[low:high], where[low:high] - begin] = 1
        total += strip @ strip.T
    return total.astype(np.int64)


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Which pairs are linked; counts below 2 ** 24 are exact in single precision, longer sets are counted one by one."""
    sizes = np.array([len(found) for found in sets], np.int64)
    if len(sets) > 8 and sizes.max() < 1 << 24:
        common = common_counts(sets)
    else:
        common = np.zeros((len(sets), len(sets)), np.int64)
        for i in range(len(sets)):
            for j in range(i):
                common[i, j] = common[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    union = sizes[:, None] + sizes[None, :] - common
    return 100 * common >= PERCENT * union


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges that keep the components of a symmetric link matrix."""
    left, out = np.ones(len(links), bool), []
    for root in range(len(links)):
        if not left[root]:
            continue
        left[root] = False
        frontier = np.array([root])
        while len(frontier):
            reached = np.flatnonzero(links[frontier].any(0) & left)
            left[reached] = False
            out += [(root, int(node)) for node in reached]
            frontier = reached
    return out


def _confirm(group: pd.DataFrame) -> pd.DataFrame:
    group = group.drop_duplicates(["name", "side"])
    names, side = group["name"].to_numpy(), group["side"].to_numpy()
    links = linked([np.frombuffer(found, np.uint64) for found in group["shingles"]])
    if side.any():
        links &= side[:, None] != side[None, :]
    edges = np.array(forest(links), np.int64).reshape(-1, 2)
    return pd.DataFrame({"u": names[edges[:, 0]], "v": names[edges[:, 1]]})


def _links(rows: DataFrame, tasks: DataFrame) -> DataFrame:
    """Confirmed links between classes, a spanning forest of each task."""
    # The text of one document of each class; a key that stands on rows with other texts is told apart by the set's name.
    texts = rows.withColumn("first_doc", F.coalesce("doc_id", F.lit(-(1 << 63)))).drop("doc_id").join(tasks, "first_doc")

    def sets(batches):
        for batch in batches:
            for part in row_chunks(batch, "text"):
                found = shingle_sets(text_column(part.column(0)))
                same = [set_name(f) == n for f, n in zip(found, part.column(1).to_pylist(), strict=True)]
                made = pa.record_batch([part.column(1), part.column(2), part.column(3),
                                        pa.array([f.tobytes() for f in found], pa.binary())],
                                       names=["name", "cluster", "tasks", "shingles"])
                yield made.filter(pa.array(same))

    kind = "array<struct<low:int,low_block:int,high:int,high_block:int,side:int>>"
    made = texts.select("text", "name", "cluster", "tasks").mapInArrow(
        sets, f"name long, cluster long, tasks {kind}, shingles binary")
    dealt = made.select("name", "cluster", F.explode("tasks").alias("task"), "shingles").select(
        "name", "cluster", "task.*", "shingles")
    return dealt.groupBy("cluster", "low", "low_block", "high", "high_block").applyInPandas(_confirm, "u long, v long")


def _grouped(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the name of their set, and for each name its component's name (``root``) and least key."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = text_rows(docs, text, key)
    signed = _signed(rows).checkpoint()
    classes = signed.where("n_shingles > 0").groupBy("name").agg(
        F.min("doc_id").alias("least_doc"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"),
        F.first("code").alias("code")).checkpoint()
    clusters = components(_candidates(classes)).select(F.col("node").alias("name"), F.col("component").alias("cluster"))
    sized = classes.select("name", F.coalesce("least_doc", F.lit(-(1 << 63))).alias("first_doc"), "least_doc", "n_shingles")
    members = clusters.join(sized, "name").checkpoint()
    groups = components(_links(rows, _tasks(members)))
    named = groups.join(members.select(F.col("name").alias("node"), "least_doc"), "node")
    roots = named.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    joined = named.join(roots, "component").select(F.col("node").alias("name"), F.col("component").alias("root"), "component_id")
    of_class = classes.select("name", "least_doc").join(joined, "name", "left").select(
        "name", F.coalesce("root", "name").alias("root"), F.coalesce("component_id", "least_doc").alias("component_id"))
    # Written, so that the join with all rows has a shuffle on either side, whose skewed parts Spark can split.
    return signed, of_class.checkpoint()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (least key reachable) and ``kept``."""
    signed, of_class = _grouped(docs, text, key)
    filled = signed.where("n_shingles > 0").select("doc_id", "n_shingles", "name").join(of_class, "name").select(
        "doc_id", "n_shingles", "component_id")
    empty = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return filled.union(empty).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: that of the least key (null last), then of the least hash of the text; of
    rows equal in both, any. Rows without words all stay. All columns stay."""
    signed, of_class = _grouped(docs, text, key)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash").alias("h"))
    ranked = signed.where("n_shingles > 0").select("doc_id", "text_hash", "name").join(of_class.select("name", "root"), "name")
    kept = ranked.groupBy("root").agg(F.min(order).alias("least")).select(
        F.coalesce("least.doc_id", F.lit(-(1 << 63))).alias("_key"), F.col("least.h").alias("_hash")).distinct()
    has_words = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = docs.where(has_words).withColumns({
        "_key": F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))), "_hash": F.xxhash64(F.col(text))})
    stay = marked.join(kept, ["_key", "_hash"]).dropDuplicates(["_key", "_hash"]).select(*docs.columns)
    return stay.union(docs.where(~has_words))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sized AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, s FROM sets),
classes AS (SELECT min(doc_id) AS class, any_value(n) AS n, list_sort(s) AS s FROM sized WHERE n > 0 GROUP BY list_sort(s)),
members AS (SELECT d.doc_id, c.class FROM sized d JOIN classes c ON list_sort(d.s) = c.s),
shingles AS (SELECT class, n, md5_number(unnest(s)) AS x FROM classes),
common AS (SELECT a.class AS u, b.class AS v, a.n AS nu, b.n AS nv, count(*) AS k FROM shingles a JOIN shingles b
  ON a.x = b.x AND a.class < b.class AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT u, v FROM common WHERE 100 * k >= 85 * (nu + nv - k)),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT class AS u, class AS v FROM classes UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u),
roots AS (SELECT u AS class, min(v) AS root FROM reach GROUP BY u)
SELECT d.doc_id, d.n AS n_shingles, coalesce(r.root, d.doc_id) AS component_id, d.doc_id = coalesce(r.root, d.doc_id) AS kept
FROM sized d LEFT JOIN members m ON m.doc_id = d.doc_id LEFT JOIN roots r ON r.class = m.class
"""
