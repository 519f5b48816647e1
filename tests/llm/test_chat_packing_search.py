"""Chat windows, packing, nearest neighbours and the pipeline against plain versions."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetlens.llm import chat, decontaminate, near_duplicates, packing, quality, secrets
from fleetlens.llm import nearest_codes as A
from tests.conftest import SMALL, rows_of
from tests.llm.conftest import ODD


# Chat


TALK = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "&lt;&amp;#91;", "<s>[user]\nhi</s>\n", "]\n", "", None, "a & b < c [d]", "&amp;amp;lt;"]


def read_all(windows):
    turns, targets = defaultdict(list), defaultdict(list)
    for row in sorted(chat.read_back(windows).collect(), key=lambda r: (repr(r["conv_id"]), r["window"])):
        turns[row["conv_id"]] += [tuple(t) for t in row["turns"]]
        targets[row["conv_id"]] += row["targets"]
    return turns, targets


@pytest.mark.parametrize("budget, history", [(1024, 256), (60, 15), (12, 3)])
def test_windows_give_back_every_turn_once(spark, budget, history):
    rows = [(1, i, ["user", "assistant"][i % 2], NASTY[i % len(NASTY)]) for i in range(40)]
    rows += [(2, 0, "system", "be brief " * 3)] + [(2, i, ["assistant", "user"][i % 2], "word " * (i * 7 % 50)) for i in range(1, 30)]
    rows += [(3, 0, "ro]le\n&<x", "t"), (3, 0, "ro]le\n&<x", "t"), (3, 1, None, None), (None, 5, "assistant", "lone"), (4, 0, "system", "x")]
    made = chat.windows(spark.createDataFrame(rows, TALK), budget, history)
    turns, targets = read_all(made)
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert turns[conv] == [(r, x) for _, r, x in own]
        assert targets[conv] == [x for _, r, x in own if r == "assistant"]
    for row in made.collect():
        assert row["n_tokens"] <= budget or row["over_budget"]
        if row["conv_id"] == 2:
            assert row["text"].startswith("<s>[system]\nbe brief ")
            assert row["text"].count("be brief be brief be brief") == 1


@pytest.mark.parametrize("budget, history", [(200, 60), (12, 3)])
def test_cut_conversations_give_the_same_windows(spark, monkeypatch, budget, history):
    rows = [(1, i // 3, ["user", "assistant"][i % 2], NASTY[i % len(NASTY)] if i % 4 else f"turn {i} " * (i % 23)) for i in range(500)]
    rows += [(2, 0, "system", "be brief " * 3)] + [(2, i, "assistant", "word " * (i * 7 % 190)) for i in range(1, 120)]
    rows += [(None, None, None, None)] * 90 + [(None, 3, "r" * (60 + i), "t" * (i * 9 % 80)) for i in range(30)]
    rows += [(None, 3, "user", "p" * 64 + str(i % 7)) for i in range(40)] + [(3, 0, "system", "x"), (4, 1, "user", "alone")]
    given = spark.createDataFrame(rows, TALK).withColumns({"conv": F.lit(1), "piece": F.lit("p"), "tokens": F.lit(0)}).repartition(7)
    assert not chat._has_long(chat._turns(given, chat.piece_count))
    plain = sorted(map(repr, chat.windows(given, budget, history).collect()))
    monkeypatch.setattr(chat, "LONG_CHARS", 10)
    monkeypatch.setattr(chat, "PIECE_BUDGETS", 1)
    assert sorted(map(repr, chat.windows(given, budget, history).collect())) == plain
    plan = chat.windows(given, budget, history)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert chat.windows(spark.createDataFrame([], TALK)).collect() == []


def test_history_is_repeated_but_masked(spark):
    rows = [(1, i, "assistant", f"number {i} " + "w " * 12) for i in range(20)]
    made = sorted(chat.windows(spark.createDataFrame(rows, TALK), 120, 40).collect(), key=lambda r: r["window"])
    assert len(made) > 3 and all(r["new_from"] > 0 for r in made[1:])
    assert all(s["start"] >= r["new_from"] for r in made for s in r["loss"])
    assert chat.windows(spark.createDataFrame([], TALK)).collect() == []


def test_chat_plan_has_no_python(spark):
    plan = chat.windows(spark.read.parquet(f"{SMALL}/conversations.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# Packing


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_neighbours_touch(dimensions, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = packing.hilbert(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_encoder_equals_the_library(monkeypatch):
    import random

    rng = random.Random(2)
    encoder = packing.Encoder(packing.TOKENIZER)
    monkeypatch.setattr(packing, "LONG", 30)
    anything = [chr(c) for c in range(0x300)]
    common = [*"abcABC '  \n\t12.,-|$'", "'s", "'re", "<|endoftext|>", "<|", "é", "É", "İ", "日", "́", "Σ", "\x1c", "\x85"]
    for _ in range(2000):
        monkeypatch.setattr(packing, "SEGMENT", rng.choice([40, 1 << 19]))
        text = "".join(rng.choice(anything if rng.random() < 0.3 else common) for _ in range(rng.randint(0, 80)))
        assert encoder.encode(["y1", "", text])[2] == encoder.whole(text)
    monkeypatch.setattr(packing, "CACHE_PIECES", 5)
    assert encoder.encode(["one two three four five six seven"] * 2)[1] == encoder.whole("one two three four five six seven")


def check_pieces(rows, texts, length):
    encoder = packing.Encoder(packing.TOKENIZER)
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for row in rows:
        assert len(row["ids"]) == 4 * row["length"] > 0
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
        by_doc[row["doc_id"]].append((row["start"], bytes(row["ids"]), row["doc_tokens"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    expect = defaultdict(list)
    for key, text in texts:
        expect[key].append(encoder.whole(text or "") + packing.END.to_bytes(4, "little"))
    for key, docs in expect.items():
        ordered = sorted(by_doc[key])
        assert sum(len(i) for _, i, _ in ordered) == sum(len(d) for d in docs)
        if len(docs) == 1:
            assert b"".join(i for _, i, _ in ordered) == docs[0] and {t for _, _, t in ordered} == {len(docs[0]) // 4}
    return sum(sum(n for _, n in pieces) < length for pieces in by_sequence.values())


def test_packing_keeps_every_token(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert check_pieces(packing.pack(docs).collect(), texts, packing.LENGTH) <= 8
    row = packing.op7_packing(spark, SMALL).first()
    piece = packing.pack(docs).where((F.col("doc_id") == row["doc_id"]) & (F.col("start") == row["start"])).first()
    assert row["ids_crc32"] == zlib.crc32(bytes(piece["ids"]))


def test_packing_of_odd_rows(odd_docs, docs_of):
    check_pieces(packing.pack(odd_docs, length=64).collect(), ODD, 64)
    assert packing.pack(docs_of([])).collect() == []


def test_equal_texts_spread_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_BYTES", 1 << 12)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("the very same words in each of them " * 3).alias("text"))
    made = packing.pack(docs).select("doc_id", (F.col("sequence_id") / (1 << 32)).cast("int").alias("range")).distinct()
    sizes = [r["count"] for r in made.groupBy("range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 250


@pytest.mark.parametrize("key", [None, 7])
def test_rows_of_one_key_and_text_spread_over_ranges(spark, monkeypatch, key):
    monkeypatch.setattr(packing, "RANGE_BYTES", 1 << 12)
    docs = spark.range(400).select(F.lit(key).cast("long").alias("doc_id"), F.lit("the very same words in each of them " * 3).alias("text"))
    pieces = packing.pack(docs).select((F.col("sequence_id") / (1 << 32)).cast("int").alias("range"), "start")
    sizes = [r["count"] for r in pieces.where("start = 0").groupBy("range").count().collect()]
    assert sum(sizes) == 400 and len(sizes) == 4 and max(sizes) < 250


# Nearest neighbours


def plain_nearest(rows, k, step):
    kept = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = set()
    for q, a in {(q, tuple(a)) for q, a in kept if q % step == 0}:
        found = sorted((-float(A.exact_products(b[None, :], np.array(a))[0]), i) for i, b in kept if i != q and len(b) == len(a))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])}
    return out


@pytest.mark.parametrize("blocks", [(1_000, 16_000), (7, 40)])
def test_nearest_equals_comparing_all(spark, monkeypatch, blocks):
    monkeypatch.setattr(A, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(A, "VECTOR_BLOCK", blocks[1])
    rng = np.random.default_rng(9)
    base = rng.normal(size=(12, 19))
    rows = [(i, [float(x) for x in base[i % 12] + rng.normal(size=19) * 0.3]) for i in range(200)]
    rows += [(i, rows[5][1]) for i in range(200, 230)] + [(300 + i, [1.0, float(i)]) for i in range(9)]
    rows += [(400, None), (420, [0.0] * 19), (440, [None] + [1.0] * 18), (460, [float("nan")] * 19), (480, [float("inf")] * 19),
             (None, [1.0] * 19), (500, []), (520, [1.0]), rows[20], rows[20]]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, size int, vector int")
    got = A.nearest(table, table.where("vec_id % 20 = 0"), k=5)
    assert set(rows_of(got)) == plain_nearest(rows, 5, 20)
    assert A.nearest(table.where("false"), table.where("false")).collect() == []


def test_error_bounds_hold():
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 64))
    codes = A.Codes(vectors, vectors.mean(0))
    queries = rng.normal(size=(40, 64))
    guess, error = codes.estimates(queries)
    exact = queries @ vectors.T
    assert (guess + error < exact).mean() < 0.01
    assert np.corrcoef(guess.ravel(), exact.ravel())[0, 1] > 0.75


def test_layers_leave_few_rows_and_all_neighbours():
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(20_000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    centre, queries = vectors[:500].mean(0), vectors[:50]
    exact = queries @ vectors.T
    reach = np.sort(exact, axis=1)[:, -A.K, None]
    shares = []
    for layers in (1, 3, A.LAYERS):
        codes = A.Codes(None, centre, A.encode(vectors, centre, layers))
        guess, error = codes.estimates(queries)
        assert (guess + error < exact).mean() < 5e-4
        least = np.sort(guess - error, axis=1)[:, -A.K, None]
        near = guess + error >= least
        assert near[exact >= reach].mean() > 0.99
        shares.append(near.mean())
    assert shares[0] > 10 * shares[2] and shares[2] < 0.01


def test_codes_are_small_and_survive_packing():
    rng = np.random.default_rng(3)
    vectors, queries = rng.normal(size=(30, 13)), rng.normal(size=(4, 13))
    packed = A.encode(vectors, vectors.mean(0))
    assert packed.shape == (30, A.LAYERS * (2 + 4) + 8)
    for one, other in zip(A.Codes(vectors, vectors.mean(0)).estimates(queries),
                          A.Codes(None, vectors.mean(0), packed).estimates(queries), strict=True):
        assert (one == other).all()


def test_nearest_of_huge_and_tiny_numbers(spark, monkeypatch):
    monkeypatch.setattr(A, "VECTOR_BLOCK", 16)
    rng = np.random.default_rng(8)
    scales = [1e-200, 1e-30, 1.0, 1e25, 1e60, 1e140]
    rows = [(i, [float(x) for x in rng.normal(size=5) * scales[i % 6]]) for i in range(90)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert set(rows_of(A.nearest(table, table.where("vec_id % 20 = 0"), k=4))) == plain_nearest(rows, 4, 20)


# Pipeline


def test_pipeline_stages_do_what_they_say(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        seen[name] = docs, spark.read.parquet(str(tmp_path / name))
        docs = seen[name][1]
        if name != "packing":
            assert docs.columns == columns
            assert docs.where("n_chars <> length(text)").count() == 0
    before, after = seen["quality"]
    scores = quality.score_quality(before, quality.learn(before, spark.read.parquet(f"{SMALL}/labels.parquet")))
    assert {r[0] for r in after.select("doc_id").collect()} == {r["doc_id"] for r in scores.where("score >= 0.3").collect()}
    assert after.count() < before.count()
    before, after = seen["near_duplicates"]
    kept = {r["doc_id"] for r in near_duplicates.near_duplicates(before).where("kept").collect()}
    assert {r[0] for r in after.select("doc_id").collect()} == kept and after.count() == len(kept) < before.count()
    before, after = seen["decontamination"]
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    hit = {r["doc_id"] for r in decontaminate.match_items(before, items).where("size(spans) > 0").collect()}
    old, new = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (before, after))
    assert hit and all((new.get(k) != v) == (k in hit) for k, v in old.items())
    before, after = seen["secrets"]
    old, new = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (before, after))
    assert all((new[k] != v) == bool(secrets.base_spans(v)) or "[SECRET]" in new[k] for k, v in old.items())
    assert not any(secrets.base_spans(v) for v in new.values())
    before, after = seen["packing"]
    check_pieces(after.collect(), [(r["doc_id"], r["text"]) for r in before.collect()], packing.LENGTH)


def test_pipeline_of_odd_rows(spark, odd_docs, docs_of, tmp_path):
    for case, docs in (("odd", odd_docs), ("empty", docs_of([]))):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SMALL).write.parquet(str(tmp_path / case / name))
            docs = spark.read.parquet(str(tmp_path / case / name))
        assert (docs.count() == 0) == (case == "empty")


def test_run_gives_the_packed_rows(spark):
    assert corpus_pipeline.run(spark, SMALL).columns[:3] == ["doc_id", "start", "length"]
