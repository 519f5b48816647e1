"""Near-duplicates, repeated passages and components against plain versions and DuckDB."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import near_duplicates as N
from fleetlens.llm import queries
from fleetlens.llm import substring_dedup as S
from fleetlens.llm import words as W
from fleetlens.llm.components import components
from fleetlens.llm.recompression import next_round, words_as_symbols
from tests.conftest import SMALL, rows_of
from tests.llm.conftest import LONG, ODD
from tools.check import compare, connect


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_statement(spark, name):
    assert compare(spark, connect(SMALL), SMALL, name, queries.QUERIES[name], queries.ORACLES[name]).startswith("ok")


# Words


@pytest.mark.parametrize("segment", [7, 64, 1 << 19])
def test_words_are_those_of_a_plain_split(monkeypatch, segment):
    monkeypatch.setattr(W, "SEGMENT", segment)
    rng = random.Random(segment)
    parts = ["a", "B", "é", " ", "\n", "\t", "日本", "xyz" * 9, ".", "\x0b", "\x1c", "1"]
    names = {}
    for _ in range(300):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 5))]
        found, starts, ends, counts = W.located_words(pa.array(texts, pa.string()), W.space_words())
        words = [t.encode().lower().split() for t in texts]
        assert counts.tolist() == [len(w) for w in words]
        flat = [w for ws in words for w in ws]
        data = [t.encode().lower() for t, ws in zip(texts, words, strict=True) for _ in ws]
        assert [d[s:e] for d, s, e in zip(data, starts, ends, strict=True)] == flat
        for word, name in zip(flat, found.tolist(), strict=True):
            assert names.setdefault(word, name) == name
    assert len(set(names.values())) == len(names)


# Components


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 40)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    rng.shuffle(edges)
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges] + edges[:5]
    got = dict(rows_of(components(spark.createDataFrame(edges, "u long, v long"))))
    expect = {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 40)} | {i: 200 for i in range(200, 203)}
    assert got == expect
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


# Near-duplicates


def plain_components(texts):
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        few = {tuple(words)} if words else set()
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else few)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def edited(rng, words, share):
    return " ".join(rng.choice("uvw") + str(rng.randint(0, 10**6)) if rng.random() < share else w for w in words)


@pytest.mark.parametrize("block", [N.BLOCK, 3_000])
def test_groups_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rng = random.Random(block)
    texts = []
    for base in range(4):
        words = [f"w{base}x{rng.randint(0, 10**6)}" for _ in range(rng.choice([40, 200]))]
        for _ in range(15):
            text = edited(rng, words, rng.choice([0, 0.004, 0.01, 0.03, 0.2]))
            texts.append(text if rng.random() < 0.7 else text.upper() + " tail" * rng.randint(0, 30))
    sizes, roots = plain_components(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in N.near_duplicates(docs).collect()}
    for i in range(len(texts)):
        assert (rows[i]["n_shingles"], rows[i]["component_id"], rows[i]["kept"]) == (sizes[i], roots[i], roots[i] == i)
    kept = sorted(r["doc_id"] for r in N.keep_one(docs).collect())
    assert kept == sorted(set(roots))


def _set(rng, size):
    return rng.integers(0, 1 << 63, size, dtype=np.uint64)


@pytest.mark.parametrize("size", [1, 3, 20, 150, 700, 5_000])
def test_codes_of_linked_sets_look_alike(size):
    rng = np.random.default_rng(size)
    linked = unlike = 0
    for _ in range(300):
        union = _set(rng, size + 17 * size // 100)
        apart = int(0.15 * len(union))
        cut = rng.integers(0, apart + 1)
        pair = [np.unique(union[cut:]), np.unique(np.concatenate([union[:cut], union[apart:]]))]
        if min(map(len, pair)):
            codes = np.stack([N.code(s) for s in pair])
            sizes = np.array([len(s) for s in pair])
            if N.linked(pair)[0, 1]:
                linked += 1
                assert N.look_alike(sizes[0], codes[0], sizes[1:], codes[1:]).all()
        half = [np.concatenate([union[:len(union) // 2], _set(rng, len(union) // 2)]) for _ in range(2)]
        codes = np.stack([N.code(s) for s in half])
        unlike += int(N.look_alike(len(half[0]), codes[0], np.array([len(half[1])]), codes[1:])[0])
    assert linked >= 300 or size == 1
    assert size < 700 or unlike == 0


@pytest.mark.parametrize("rows", [N.ROWS, 5])
def test_alike_forest_keeps_components(spark, monkeypatch, rows):
    monkeypatch.setattr(N, "ROWS", rows)
    rng = np.random.default_rng(9)
    sets, groups = [], []
    for group in range(6):
        base = _set(rng, 900)
        for _ in range(12):
            sets.append(np.unique(np.concatenate([base[rng.random(900) > 0.02], _set(rng, 9)])))
            groups.append(group)
    schema = "name long, n_shingles long, keys array<long>, code array<long>"
    data = [(i, len(s), [group % 2] * (2 * N.SIDES), W.long_names(N.code(s)).tolist())
            for i, (s, group) in enumerate(zip(sets, groups, strict=True))]
    edges = [tuple(r) for r in N._candidates(spark.createDataFrame(data, schema)).collect()]
    assert {frozenset(g) for g in _groups(72, edges)} == {frozenset(range(12 * g, 12 * g + 12)) for g in range(6)}
    # One search of the two buckets, however many tables hold them.
    assert len(edges) == 66 or rows == 5


def test_a_chain_of_boilerplate_is_not_one_cluster(spark):
    """5,000 texts that share over half of their shingles with those near them in a chain, and 40 near copies among them."""
    rng = random.Random(14)
    passages = [[f"p{i}w{j}" for j in range(60)] for i in range(250)]
    texts = []
    for i in range(5_000):
        shared = [w for p in range(3) for w in passages[(i // 20 + p) % 250]]
        texts.append(" ".join(shared + [f"own{i}w{j}" for j in range(rng.randint(70, 90))]))
    copied = rng.sample(range(5_000), 40)
    texts += [texts[i] + " one tail more" for i in copied]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = N._signed(docs).groupBy("name").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("code").alias("code"))
    clusters = components(N._candidates(classes)).groupBy("component").count().agg(F.max("count"), F.sum("count")).first()
    assert clusters[0] <= 40 and clusters[1] <= 1_000
    roots = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(docs).collect()}
    assert roots == {i: i for i in range(5_000)} | {5_000 + at: i for at, i in enumerate(copied)}


def test_common_counts_and_forest():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    counts = N.common_counts(sets)
    assert all(counts[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(40) for j in range(40))
    links = counts > 18
    edges = N.forest(links)
    assert len(edges) < 40
    reach = lambda pairs: {frozenset(g) for g in _groups(40, pairs)}
    assert reach(edges) == reach(list(zip(*np.nonzero(links), strict=True)))


def _groups(count, pairs):
    group = {i: {i} for i in range(count)}
    for a, b in pairs:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for i in group[b]:
                group[i] = group[a]
    return group.values()


def test_near_duplicates_of_odd_rows(odd_docs, docs_of):
    rows = rows_of(N.near_duplicates(odd_docs))
    assert rows == sorted([
        (None, 8, None, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 5, True),
        (6, 1, 6, True), (6, 1, 6, True), (7, 1, 6, False), (6, 2, 6, True)], key=repr)
    kept = rows_of(N.keep_one(odd_docs).select("doc_id", "text"))
    assert kept == sorted([ODD[0], *ODD[1:7], ODD[9]], key=repr)
    assert N.keep_one(odd_docs).columns == odd_docs.columns
    assert N.near_duplicates(docs_of([])).collect() == [] and N.keep_one(docs_of([])).collect() == []


# Repeated passages


def test_rounds_shorten_and_name_alike():
    rng = np.random.default_rng(5)
    part = rng.integers(1, 1 << 60, 400).astype(np.uint64)
    words = np.concatenate([[0], part, rng.integers(1, 1 << 60, 31).astype(np.uint64), part, np.full(50, 9, np.uint64), [0]]).astype(np.uint64)
    border = words == 0
    symbols = words_as_symbols(words, border)
    for number in range(1, 5):
        after = next_round(symbols, number)
        assert len(after.names) < 0.9 * len(symbols.names)
        assert (after.start[1:] == after.end[:-1]).all()
        symbols = after
    inner = {(int(n), int(s)) for n, s in zip(symbols.names, symbols.start, strict=True)}
    again = {(n, s + 431) for n, s in inner if 20 < s < 380}
    assert len(again - inner) == 0


def test_equal_windows_share_their_anchor(monkeypatch):
    rng = random.Random(4)
    for _ in range(300):
        monkeypatch.setattr(S, "PART", rng.choice([12, 30, 1 << 17]))
        window, kinds = rng.choice([3, 5, 9, 12]), rng.choice([1, 2, 3, 30])
        base = [rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ"[:kinds]) for _ in range(80)]
        docs = []
        for _ in range(6):
            words = []
            while len(words) < rng.randint(0, 70):
                at = rng.randrange(80)
                words += base[at:at + rng.randint(1, 25)] if rng.random() < 0.5 else [rng.choice("abcxyz")] * rng.randint(1, 30)
            docs.append(words)
        names, counts = W.word_names(pa.array([" ".join(d) for d in docs], pa.large_string()), W.space_words(), W.PLAIN)
        doc, start, count, anchor, spelled = S.stretches(names, counts, window)
        seen, wins, times, said = Counter(), defaultdict(list), Counter(anchor.tolist()), defaultdict(set)
        for d, s, n, a, w in zip(doc.tolist(), start.tolist(), count.tolist(), anchor.tolist(), spelled.tolist(), strict=True):
            said[a].add(w)
            for i in range(s, s + n):
                seen[d, i] += 1
                wins[tuple(docs[d][i:i + window])].append(a)
        assert set(seen.values()) <= {1} and len(seen) == sum(max(0, len(d) - window + 1) for d in docs)
        for names_of in wins.values():
            assert len(set(names_of)) == 1
            once = len(names_of) == 1
            assert times[names_of[0]] > 1 or once
            assert not once or times[names_of[0]] == 1 or len(said[names_of[0]]) > 1


def plain_repeats(texts, window):
    words = [(t or "").split(" ") if t else [] for t in texts]
    times = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {k for i in range(len(w) - window + 1) if times[tuple(w[i:i + window])] > 1 for k in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_removed_words_are_those_of_repeated_windows(spark):
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 300)}" for _ in range(400)]
    texts = []
    for _ in range(40):
        words = []
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(400)
            words += base[at:at + rng.randint(1, 60)] if rng.random() < 0.6 else [rng.choice(["x", "y"])] * rng.randint(1, 50)
        texts.append(" ".join(words))
    texts += [texts[0], "same " * 80 + "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in S.remove_repeats(docs, window=12).collect()}
    for i, expect in enumerate(plain_repeats(texts, 12)):
        assert (rows[i]["n_words"], rows[i]["n_removed"], rows[i]["kept"]) == expect


def test_repeats_of_odd_rows(odd_docs, docs_of):
    rows = rows_of(S.remove_repeats(odd_docs).select("doc_id", "n_words", "n_removed"))
    assert rows == sorted([(None, 12, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (5, 30000, 30000), (6, 3, 0), (6, 3, 0),
                           (7, 3, 0), (6, 6, 0)], key=repr)
    assert S.remove_repeats(docs_of([])).collect() == []
    twice = docs_of([(1, LONG[:400]), (None, "p " + " ".join(f"q{i}" for i in range(50))), (None, " ".join(f"q{i}" for i in range(50)))])
    assert rows_of(S.remove_repeats(twice).select("n_words", "n_removed")) == [(50, 50), (51, 50), (80, 80)]


def test_texts_of_one_key_with_equal_short_hashes_keep_their_own_ranges(spark, docs_of):
    passage, other = " ".join(f"p{i}" for i in range(40)), " ".join(f"q{i}" for i in range(60))
    pair = [f"{passage} a13146", f"{other} b243593"]
    hashes = spark.createDataFrame([(t,) for t in pair], "text string").selectExpr("hash(text)").distinct()
    assert hashes.count() == 1
    for key in (None, 6):
        rows = S.remove_repeats(docs_of([*((key, t) for t in pair), (7, f"{passage} c")]))
        assert rows_of(rows.select("n_words", "n_removed", "kept")) == sorted(
            [(41, 40, "a13146"), (61, 0, pair[1]), (41, 40, "c")], key=repr)
