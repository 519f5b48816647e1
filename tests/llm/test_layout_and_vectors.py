"""Shards along the curve, whitening and vector codes against plain versions."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import eigen, sharding, stored, vector_codes, whitening
from tests.conftest import SMALL, rows_of
from tests.llm.conftest import ODD

CLASHING = ("size", "curve", "shard", "slot", "row", "d0", "d1", "_range", "_row", "_tie", "x", "part", "entry", "code", "error", "n",
            "place", "lane", "total", "deviation")


def with_clashes(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING})


# Order and shards


def test_running_total_over_ranges(spark):
    rows = spark.createDataFrame([(i % 7, i) for i in range(500)], "k int, w long")
    ranged = stored.in_ranges(rows, ["k"], "test")
    got = sorted((r["k"], r["before"], r["w"]) for r in stored.running_total(ranged, "w", "before").collect())
    total = 0
    for k, before, w in got:
        assert before == total
        total += w
    assert [k for k, *_ in got] == sorted(i % 7 for i in range(500))


def placed_of(docs, shards=sharding.SHARDS, law="rows"):
    return sharding.assign(sharding.ordered_rows(docs), shards, law)


def check_shards(pairs, rows, shards, law):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in pairs)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    assert set(by_shard) <= set(range(shards))
    previous = -1
    for number in sorted(by_shard):
        held = sorted(by_shard[number], key=lambda r: r["slot"])
        assert [r["slot"] for r in held] == list(range(len(held)))
        curve = [r["curve"] for r in held]
        assert curve == sorted(curve) and curve[0] >= previous
        previous = curve[-1]
    if law == "rows":
        counts = [len(by_shard.get(n, ())) for n in range(shards)]
        assert max(counts) - min(counts) <= 1
    else:
        total, most = sum(r["size"] for r in rows), max(r["size"] for r in rows)
        assert all(abs(sum(r["size"] for r in by_shard.get(n, ())) - total / shards) <= most for n in range(shards))


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards_hold_runs_of_the_curve(docs_of, law):
    pairs = [(i, "w" * (i * 37 % 900)) for i in range(700)] + [(None, "same")] * 300 + [(5, None), (5, ""), (6, "é" * 10)]
    rows = placed_of(docs_of(pairs), 24, law).collect()
    check_shards(pairs, rows, 24, law)
    assert len({r["curve"] for r in rows}) > 100


def test_shards_of_odd_tables(docs_of, odd_docs):
    check_shards(ODD, placed_of(with_clashes(odd_docs)).collect(), 24, "rows")
    assert placed_of(docs_of([])).collect() == []
    one = placed_of(docs_of([(1, None)])).collect()
    assert [(r["shard"], r["slot"], r["size"], r["text_crc32"]) for r in one] == [(0, 0, 8, 0)]
    with pytest.raises(ValueError, match="law"):
        placed_of(docs_of([]), law="keys")


def test_levels_are_quantiles(docs_of, spark):
    docs = docs_of([(i, "x") for i in range(1000)]).withColumn("source", F.concat(F.lit("s"), F.lpad((F.col("doc_id") % 10).cast("string"), 2, "0")))
    rows = sharding._sized(docs, "text", "doc_id", ("source", "doc_id", "lang"), False)
    names, numbers, nothing = sharding.level_edges(rows, 3, 3)
    assert names == ["s00", "s02", "s03", "s05", "s06", "s08", "s09"] or names[0] == "s00" and len(names) <= 7
    assert len(numbers) == 7 and all(abs(e - i * 1000 / 7) <= 2 for i, e in enumerate(numbers))
    assert nothing == []


def test_written_shards_keep_rows_and_prune(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("shard", F.lit(7))
    boxes = sharding.write_shards(docs, str(tmp_path / "out"), 24).collect()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(back.select(docs.columns)) == rows_of(docs)
    counts = {r["shard_"]: r["count"] for r in back.groupBy("shard_").count().collect()}
    assert counts == {r["shard"]: r["rows"] for r in boxes} and max(counts.values()) - min(counts.values()) <= 1
    table = sharding.shard_boxes(placed_of(docs)).persist()
    by_id = docs.where("doc_id is not null").orderBy("doc_id").collect()
    # A filter on any dimension reaches all its rows.
    for wanted, holds in (({"source": ("src3", "src3")}, lambda r: r["source"] == "src3"),
                          ({"lang": ("fr", "fr")}, lambda r: r["lang"] == "fr"),
                          ({"doc_id": (20, 40), "lang": ("en", "en")}, lambda r: 20 <= r["doc_id"] <= 40 and r["lang"] == "en")):
        open_ = {r["shard"] for r in sharding.shards_within(table, wanted).collect()}
        held = {r["doc_id"]: r["shard"] for r in placed_of(docs).select("doc_id", "shard").collect()}
        assert {held[r["doc_id"]] for r in by_id if holds(r)} <= open_


def test_every_dimension_prunes(docs_of):
    docs = docs_of([(i * 7919 % 2048, "x") for i in range(2048)]).withColumn(
        "source", F.concat(F.lit("s"), F.lpad(F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("string"), 2, "0")))
    ordered = sharding.ordered_rows(docs, dimensions=("source", "doc_id"))
    boxes = sharding.shard_boxes(sharding.assign(ordered, 64), ("source", "doc_id")).persist()

    def reached(**wanted):
        return sharding.shards_within(boxes, wanted).count()

    # 64 shards of a square: a strip along either side meets under half of them (a shard that ends inside a source counts
    # for it), and both at once very few.
    assert reached(doc_id=(512, 639)) <= 20 and reached(source=("s04", "s04")) <= 28
    assert reached(doc_id=(512, 639), source=("s04", "s04")) <= 6


# Eigenpairs and whitening


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64])
def test_eigenpairs(size):
    made = np.random.default_rng(size).standard_normal((size, size + 3))
    matrix = made @ made.T
    values, vectors = eigen.leading_pairs(matrix, 16)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:16], rtol=0, atol=1e-13 * values[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * values[0]


def test_eigenpairs_of_clusters():
    turn, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((40, 40)))
    spectrum = np.r_[np.full(8, 5.0), np.full(8, 5.0 - 1e-13), np.linspace(1, 2, 24)]
    for matrix in ((turn * spectrum) @ turn.T, np.eye(40), np.diag(spectrum), np.zeros((40, 40))):
        matrix = (matrix + matrix.T) / 2
        values, vectors = eigen.leading_pairs(matrix, 16)
        assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-11
        assert np.abs(matrix @ vectors - vectors * values).max() < 1e-11


def test_sturm_counts():
    diagonal, off = np.array([2.0, -1.0, 0.5, 3.0]), np.array([1.0, 0.0, -2.0])
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    points = np.linspace(-4, 6, 51)
    assert eigen.below(diagonal, off, points).tolist() == [(values < p).sum() for p in points]


VECTORS = "vec_id long, embedding array<float>, label int"
BAD = [(900, None, 1), (901, [1.0, None, 2.0, 0.5] * 2, 1), (902, [float("nan")] * 8, None), (903, [float("inf")] + [1.0] * 7, 2), (904, [], 3)]


def vectors_of(count, width, seed=0, scale=1.0):
    made = np.random.default_rng(seed).standard_normal((count, width)) * scale * np.linspace(0.5, 2, width)
    return made.astype(np.float32).astype(float).tolist()


def test_whitening_equals_the_plain_way(spark):
    given = [(i, v, i % 3) for i, v in enumerate(vectors_of(300, 8))]
    given += [(1000 + i, given[0][1], 9) for i in range(150)] + [(None, given[1][1], None)] + BAD
    table = with_clashes(spark.createDataFrame(given, VECTORS))
    got = whitening.whiten(table).collect()
    kept = [(k, v) for k, v, _ in given if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centre = fit - sums / n
    covariance = centre.T @ centre / n
    values, vectors = np.linalg.eigh(covariance)
    plain = np.abs(((n * x - sums) / n) @ vectors[:, ::-1] / np.sqrt(values[::-1]))
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    key = lambda r: (repr(r[0]), r[1], [round(w, 6) for w in r[2]])
    ours = sorted([(r["vec_id"], r["deviation"], np.abs(r["whitened"]).tolist()) for r in got], key=key)
    theirs = sorted([(k, d, w.tolist()) for (k, _), d, w in zip(kept, deviation, plain)], key=key)
    assert [r[:2] for r in ours] == [r[:2] for r in theirs]
    assert np.allclose([r[2] for r in ours], [r[2] for r in theirs], rtol=0, atol=1e-9)
    assert {r["n"] for r in got} == {n} and {r["identity_error"] for r in got}.pop() < 1e-9
    assert np.allclose(got[0]["explained"], values[::-1] / values.sum(), rtol=1e-10)
    # One sign for all rows: the rows are one linear image of the centred vectors.
    by_key = {k: v for (k, _), v in zip(kept, (n * x - sums) / n)}
    rows = [r for r in got if r["vec_id"] is not None]
    inputs, white = np.array([by_key[r["vec_id"]] for r in rows]), np.array([r["whitened"] for r in rows])
    turn = np.linalg.lstsq(inputs, white, rcond=None)[0]
    assert np.abs(inputs @ turn - white).max() < 1e-9


def test_whitening_of_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.whiten(empty).collect() == []
    assert whitening.whiten(spark.createDataFrame(BAD, VECTORS)).collect() == []
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(9)], VECTORS)).collect()
    assert len(same) == 9 and all(r["whitened"] == [] and r["deviation"] == 0 and r["n"] == 1 for r in same)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], 0) for i in range(9)], VECTORS)).collect()
    assert all(len(r["whitened"]) == 1 for r in line) and line[0]["explained"] == [pytest.approx(1.0)]
    with pytest.raises(ValueError, match="wide"):
        whitening.whiten(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0)], VECTORS))


def test_centres_and_sums_beyond_a_long_stay_exact(spark):
    big = np.array([[1 << 60, 3], [-(1 << 60), 5]])
    assert whitening.centred(big, 100, np.array([7, 8], object)).tolist() == [[100 * (1 << 60) - 7, 292], [-100 * (1 << 60) - 7, 492]]
    rows = spark.createDataFrame([([1 << 62, 1],), ([1 << 62, 2],)], "x array<long>")
    assert whitening.column_sums(rows, 2)[1].tolist() == [1 << 63, 3]


# Vector codes


def plain_codes(rows, parts, entries, rounds):
    x = np.array([v for _, v in rows], object)
    width = x.shape[1] // parts
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books, codes, errors = [], [], [0] * len(rows)
    for p in range(parts):
        mine = x[:, p * width:(p + 1) * width]
        book = [list(mine[i]) for i in first]
        for step in range(rounds + 1):
            distances = [[sum((a - b) ** 2 for a, b in zip(row, e)) for e in book] for row in mine]
            at = [d.index(min(d)) for d in distances]
            if step < rounds:
                for e in range(len(book)):
                    held = [mine[i] for i in range(len(rows)) if at[i] == e]
                    if held:
                        book[e] = [sum(column) // len(held) for column in zip(*held)]
        books.append(book)
        codes.append(at)
        errors = [e + distances[i][at[i]] for i, e in enumerate(errors)]
    digest = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    return ["".join(f"{codes[p][i]:02x}" for p in range(parts)) for i in range(len(rows))], errors, digest


@pytest.mark.parametrize("scale", [1.0, 3e4])
def test_codes_equal_the_plain_way(spark, scale):
    given = [(i, v, [None, 1, 2][i % 3]) for i, v in enumerate(vectors_of(220, 8, 5, scale))]
    given += [(3, given[0][1], 1)] * 60 + [(None, given[7][1], None)] + BAD
    table = with_clashes(spark.createDataFrame(given, "vec_id long, embedding array<double>, label int"))
    got = vector_codes.compress(table, parts=4, entries=16, rounds=3).collect()
    kept = [(k, [math.floor(1024 * c) for c in v], label) for k, v, label in given
            if v and all(c is not None and math.isfinite(c) for c in v)]
    codes, errors, digest = plain_codes([(k, v) for k, v, _ in kept], 4, 16, 3)
    of_label = Counter()
    for (_, _, label), error in zip(kept, errors):
        of_label[label] += error
    key = repr
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=key) == sorted(
        ((k, code, error, of_label[label]) for (k, _, label), code, error in zip(kept, codes, errors)), key=key)
    assert {r["codebooks_sha256"] for r in got} == {digest}


def test_codes_of_odd_tables(spark):
    empty = vector_codes.compress(spark.createDataFrame([], VECTORS))
    assert empty.collect() == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes.compress(spark.createDataFrame(BAD, VECTORS)).collect() == []
    few = vector_codes.compress(spark.createDataFrame([(2, [1.0] * 4, None), (1, [0.5] * 4, 1), (2, [1.0] * 4, None)], VECTORS)).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in few) == [(1, "00000000", 0), (2, "01010101", 0), (2, "01010101", 0)]
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 6, 0)], VECTORS))
    with pytest.raises(ValueError, match="wide"):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 4, 0), (2, [1.0] * 8, 0)], VECTORS))


def test_shortlists_hold_every_nearest_entry():
    draw = np.random.default_rng(2)
    shorter = 0
    for _ in range(200):
        x = draw.integers(-40, 40, (1, 4)) + draw.integers(-6, 7, (30, 4))
        book = draw.integers(-50, 50, (64, 4))
        book[10] = book[3]
        near = vector_codes.shortlist(x.min(0), x.max(0), book)
        all_at, error = vector_codes.nearest_entries(x, book)
        at, same = vector_codes.nearest_entries(x, book[near])
        assert (near[at] == all_at).all() and (same == error).all()
        shorter += len(near) < len(book) / 2
    assert shorter > 150
    huge = np.array([[1 << 40, -(1 << 41)], [5, 7]])
    at, error = vector_codes.nearest_entries(huge, np.array([[0, 0], [1 << 40, 0]]))
    assert at.tolist() == [1, 0] and error.tolist() == [1 << 82, 74]


def test_blocks_keep_rows_boxes_and_sums(spark):
    rows = spark.createDataFrame([(i, [i % 5, -i, 3 * i, 7]) for i in range(1000)], "row long, x array<long>")
    shape = vector_codes._shape(rows, 2)
    blocks = vector_codes.flat_blocks(rows, shape, 2, 64).collect()
    seen = Counter()
    for b in blocks:
        x = np.frombuffer(b["entries"], shape.kind).reshape(-1, 2)
        assert 0 < len(x) == len(b["rows"]) <= 64
        assert (x.min(0).tolist(), x.max(0).tolist(), x.sum(0).tolist()) == (b["low"], b["high"], [int(s) for s in b["sums"]])
        for row, entry in zip(b["rows"], x.tolist()):
            assert entry == [[row % 5, -row], [3 * row, 7]][b["part"]]
            seen[row, b["part"]] += 1
    assert len(seen) == 2000 and set(seen.values()) == {1}
