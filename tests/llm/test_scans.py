"""Secrets, token counts, decontamination, quality and toxicity against plain versions."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fleetlens.llm import decontaminate as D
from fleetlens.llm import quality, secrets, token_counts, toxicity
from fleetlens.llm.labelled import Rows
from tests.conftest import SMALL, rows_of
from tests.llm.conftest import LONG, ODD

MIDDLE = "/root/testdata/sf0.01"


# Secrets


def plain_base(text):
    out = []
    for m in re.finditer(
        r"(password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text, re.IGNORECASE | re.ASCII
    ):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_base_spans_equal_a_plain_scan():
    rng = random.Random(1)
    parts = ["password", "TOKEN", "api_key", "apikey", '"', "'", " ", "  ", ":", "=", "abc123", "AKIA", "AKIA" + "Q7" * 9, "f" * 23,
             "0f" * 12, "é", "ſecret=abcdefgh", "\n", "x", "-", ".", "secret=", "=="]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert ",".join(f"{k}:{s}:{e}" for k, s, e in secrets.base_spans(text)) == plain_base(text)


def test_secret_query_has_every_row(spark):
    rows = secrets.op1_secret_scans(spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        base = plain_base(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert row["n_hex"] == base.count("hex:") and row["n_assign"] == base.count("assign:")
        assert set(base.split(",")) <= set(row["spans"].split(",")) if base else True


def test_field_learns_shapes_and_adds_spans_apart_from_base_spans():
    rng = random.Random(3)
    runs = []
    for _ in range(60):
        value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        for text in (f'the token = "{value}" and more words', "call 030-1234567890-12345 or 2024-01-01-10.20.30"):
            base = secrets.base_spans(text)
            for start, end in secrets.value_runs(text):
                spans, features = secrets.run_features(text, start, end, secrets.file_features(text, bool(base)))
                runs.append((features, secrets._labels(spans, base, text)))
    weights = secrets.train(runs)
    step = secrets._steps(weights)
    upper = "".join(rng.choice("0123456789ABCDEF") for _ in range(40))
    mixed = "a1f3" + "".join(rng.choice("0123456789abcdef") for _ in range(19))
    found = secrets.text_spans(f'the token is "{mixed}" here', weights, step)
    assert [k for k, _, _ in found] == ["field"] and found[0][2] - found[0][1] == len(mixed)
    assert secrets.text_spans("call 030-1234567890-12345 or 2024-01-01-10.20.30", weights, step) == []
    both = secrets.text_spans(f'token = "{upper}" and', weights, step)
    assert [k for k, _, _ in both] == ["assign"]


def test_field_tags_short_digitless_and_split_secrets():
    rng = random.Random(5)
    runs = []
    for _ in range(150):
        value = "-".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(5, 8))) for _ in range(3))
        short = "".join(rng.choice("abcdefgh0123456789") for _ in range(9))
        words = " ".join(rng.choice(["correct", "horse", "of", "the", "well-known", "day", "my"]) for _ in range(6))
        for text in (f"my password: {value} {words}", f"my password: {short} {words}", f"{words} is {words}"):
            spans, features = secrets.run_features(text, 0, len(text), secrets.file_features(text, False))
            runs.append((features, secrets._labels(spans, secrets.base_spans(text), text)))
    weights = secrets.train(runs)
    step = secrets._steps(weights)
    for text, value in (("my password is correct-horse-battery", "correct-horse-battery"), ("my password is hunter2abc", "hunter2abc")):
        assert ("field", text.index(value), len(text)) in secrets.text_spans(text, weights, step)
    assert secrets.text_spans("the well-known horse is correct of the day", weights, step) == []


def test_tables_and_cuts_give_the_path_of_the_whole_chain():
    rng = np.random.default_rng(4)
    weights = rng.normal(size=(secrets._FEATURES + 3, 3))
    field = secrets.Emissions(weights)
    for text in ("a", "pass word: x9-y/z,, '\u00fc' 12 ab", "one two_three \U0001f600 four" * 9):
        of_file = secrets.file_features(text, False)
        spans, rows = secrets.run_features(text, 0, len(text), of_file)
        _, tokens = secrets._text_tokens(text)
        emit = field.scores(tokens, field.of_file(text, False)[None])
        assert len(spans) == len(emit) and np.allclose(emit, [weights[row].sum(0) for row in rows])
    for _ in range(200):
        step = rng.normal(size=(3, 3)) * 2
        step[secrets.OUT, secrets.INSIDE] = -1e9
        emit = rng.normal(size=(rng.integers(1, 30), 3)) * 5
        emit[:, secrets.OUT] += rng.choice([0, 5, 12])
        assert secrets.best_path(emit, step).tolist() == secrets.viterbi(emit, step)


def test_added_spans_touch_none_of_many_base_spans():
    weights = np.zeros((secrets._FEATURES + 3, 3))
    weights[secrets._slot("bias"), secrets.BEGIN] = 5.0
    text = "-".join(f"{k:024x}" for k in range(12, 24))
    spans = secrets.text_spans(text, weights, secrets._steps(weights))
    base = [(s, e) for kind, s, e in spans if kind != "field"]
    assert len(base) == 12
    assert not any(s < b and a < e for kind, s, e in spans if kind == "field" for a, b in base)


def test_segments_of_long_texts_give_the_spans_of_the_whole():
    rng = random.Random(8)
    words = ["a", "token", "=", "x9y8z7", "\u00fc\u00e9", ",", " ", "  ", "\n", "pass:word", "0f" * 12, "-", "Q" * 40, "9" * 5000, " " * 9000]
    texts = ["".join(rng.choice(words[:-2]) + rng.choice(["", " "]) for _ in range(20_000)), " " * 30_000, "z" * 50_000, "",
             "".join(rng.choice(words) for _ in range(200))]
    draw = np.random.default_rng(8)
    weights = draw.normal(size=(secrets._FEATURES + 3, 3))
    for gain in (0.0, 3.0):
        weights[secrets._slot("bias"), secrets.OUT] = gain
        field, step = secrets.Emissions(weights), secrets._steps(weights)
        for text in texts:
            data = np.frombuffer(text.encode(), np.uint8)
            of_file = draw.normal(size=3)
            edges = np.array([0, len(data)])
            whole = secrets._batch_secrets(data, edges, field, step, of_file[None])[0]
            assert secrets._long_secrets(data, field, step, of_file, 8192) == whole
    # Several texts in one buffer are chains of their own.
    data, edges = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *[len(x.encode()) for x in texts]])
    alone = [secrets._batch_secrets(data[a:b], np.array([0, b - a]), field, step, of_file[None])[0]
             for a, b in zip(edges[:-1], edges[1:])]
    assert secrets._batch_secrets(data, edges, field, step, np.tile(of_file, (len(texts), 1))) == alone


PLANTED = ("my pwd: {}", "the credential is '{}'", 'db_pass = "{}"', "passphrase -> {}", "client_key={}", "the new secret is {}",
           "auth `{}`", "login: {}", "the passkey was {}", "access code => {}")


def planted(texts, seed):
    """Texts with one secret each that the base patterns miss, and where it stands."""
    rng = random.Random(seed)
    letters = "abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    for n, text in enumerate(texts):
        words = text.split(" ")
        value = "".join(rng.choice(letters) for _ in range(rng.randint(9, 22)))
        if n % 3 == 0:
            value = f"{value[:5]}{rng.choice('-_.!$')}{value[5:]}"
        if not any(c.isdigit() for c in value):
            value += "7"
        at = rng.randrange(len(words) + 1)
        before = "".join(w + " " for w in words[:at]) + PLANTED[n % len(PLANTED)].split("{}")[0]
        yield before + value + PLANTED[n % len(PLANTED)].split("{}")[1] + " " + " ".join(words[at:]), (len(before), len(before) + len(value))


def test_field_finds_planted_secrets_that_the_patterns_miss(spark):
    learnt = secrets.learn(spark.read.parquet(f"{MIDDLE}/documents.parquet"))
    field, step = secrets.Emissions(learnt), secrets._steps(learnt)
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) > 100").collect()]
    found = tokens = false = 0
    for text, (begin, end) in planted(texts, 4):
        assert not any(s < end and begin < e for _, s, e in secrets.base_spans(text))
        added = [(s, e) for k, s, e in secrets.text_spans(text, field, step) if k == "field"]
        # Found: its value is covered by at least four fifths.
        found += sum(max(0, min(e, end) - max(s, begin)) for s, e in added) >= 0.8 * (end - begin)
        false += sum(e <= begin or s >= end for s, e in added)
        tokens += len(secrets._text_tokens(text)[1].starts)
    print("recall", found / len(texts), "false spans a million tokens", 1e6 * false / tokens, "tokens", tokens)
    assert found >= 0.8 * len(texts)
    assert false <= max(5, 50 * tokens / 1e6)


def test_hidden_cues_mark_their_secrets():
    rng = random.Random(6)
    for _ in range(300):
        made = list(secrets.hidden_cues(["der", "which", "la", "of"], "9c8b45435718dcc700c184a7e303cdc6", rng))
        assert [len(spans) for _, spans in made] == [1, 1, 1, 0, 0, 0]
        for text, spans in made:
            assert all(text[s:e].strip() == text[s:e] and e - s >= 5 for s, e in spans)


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(2)
    step = rng.normal(size=(3, 3))
    for _ in range(30):
        emit = rng.normal(size=(4, 3))
        paths = [(a, b, c, d) for a in range(3) for b in range(3) for c in range(3) for d in range(3)]
        score = [step[0, p[0]] + sum(emit[i, p[i]] for i in range(4)) + sum(step[p[i], p[i + 1]] for i in range(3)) for p in paths]
        assert tuple(secrets.viterbi(emit, step)) == paths[int(np.argmax(score))]


def test_secrets_of_odd_rows(odd_docs, docs_of):
    weights = secrets.learn(odd_docs)
    assert len(secrets.scan_secrets(odd_docs, weights).collect()) == len(ODD)
    assert secrets.scan_secrets(docs_of([]), secrets.learn(docs_of([]))).collect() == []
    told = docs_of([(1, "my password: hunter22 ok"), (2, None), (3, "")])
    red = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(told, weights).collect()}
    assert red == {1: "my [SECRET] ok", 2: None, 3: ""}


# Token counts


def test_token_counts_equal_the_library(spark, odd_docs, docs_of):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    rows = rows_of(token_counts.count_tokens(odd_docs))
    expect = sorted(((i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096)
                     for i, t in ODD), key=repr)
    assert rows == expect
    assert token_counts.count_tokens(docs_of([])).collect() == []
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for row in token_counts.op5_token_counts(spark, SMALL).collect():
        assert row["n_tokens"] == len(library.encode(texts[row["doc_id"]] or ""))


def test_long_texts_are_cut_where_nothing_changes(monkeypatch):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    monkeypatch.setattr(token_counts, "SPLIT_BYTES", 15)
    rng = random.Random(5)
    parts = ["a", "the", " ", "  ", "\n", "é", "▁", "<s>", "ing", "0", "日本", "\t", "    "]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert token_counts.count_texts([text])[0] == len(library.encode(text))


def test_token_counts_by_the_other_library(docs_of):
    rows = token_counts.count_tokens(docs_of([(1, "Hello there <|endoftext|>"), (2, None)]), model="byte_bpe_50k.json").collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {1: 4, 2: 0}


# Decontamination


def plain_hits(text, items, window):
    words = D.split_words(text)
    hit, names = set(), set()
    for name, item in items:
        item = D.split_words(item)
        runs = [item] if 0 < len(item) < window else [item[i:i + window] for i in range(len(item) - window + 1)]
        for run in runs:
            for i in range(len(words) - len(run) + 1):
                if words[i:i + len(run)] == run:
                    hit |= set(range(i, i + len(run)))
                    names.add(name)
    return len(words), hit, names


def test_automaton_equals_comparing_every_window(monkeypatch):
    rng = random.Random(7)
    for _ in range(600):
        monkeypatch.setattr(D, "SEGMENT", rng.choice([1, 5, 1 << 20]))
        letters = "abcdefgh"[:rng.choice([2, 3, 8])]
        make = lambda n: " ".join(rng.choice(letters) for _ in range(n))
        items = [(str(i), make(rng.randint(0, 12))) for i in range(rng.randint(0, 5))]
        window, text = rng.choice([3, 4, 5]), make(rng.randint(0, 40)) + "."
        count, spans, names = D.SuffixAutomaton([(n, D.split_words(t)) for n, t in items], window).match(text)
        assert (count, {i for s, e in spans for i in range(s, e)}, names) == plain_hits(text, items, window)


def test_decontamination_query_equals_comparing_every_window(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r for r in D.op10_decontamination(spark, SMALL).collect()}
    for doc in docs[::7]:
        count, hit, names = plain_hits(doc["text"], items, D.WINDOW)
        row = rows[doc["doc_id"]]
        assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (count, len(hit), len(names), bool(hit))
        assert row["items_sha256"] == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    assert len(rows) == len(docs) and any(r["contaminated"] for r in rows.values())


def test_many_shards_find_what_one_finds(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    assert rows_of(D.match_items(docs, items)) == rows_of(D.match_items(docs, items, shard_bytes=4_000))


def test_decontamination_of_odd_rows(spark, odd_docs, docs_of):
    items = spark.createDataFrame([(1, "one two three"), (2, None), (3, " "), (1, "text of the same")], "item_id long, text string")
    rows = rows_of(D.match_items(odd_docs, items).select("doc_id", "n_words", D.hit_words().alias("n"), "items"))
    assert rows == sorted([(None, 12, 0, []), (1, 0, 0, []), (2, 0, 0, []), (3, 0, 0, []), (4, 1, 0, []), (5, 30000, 0, []),
                           (6, 3, 3, ["1"]), (6, 3, 3, ["1"]), (7, 3, 3, ["1"]), (6, 6, 4, ["1"])], key=repr)
    none = items.where("false")
    assert {r["n_words"] for r in D.match_items(docs_of([(1, "a b")]), none).collect()} == {2}
    assert D.match_items(docs_of([]), items).collect() == []


def test_cleaned_texts_keep_the_rest(spark, docs_of):
    item = "a b c d e f g h i j"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = docs_of([(1, f"Start here, then: {item.upper()}! End, with a good deal of other words after that."), (2, item), (3, None)])
    got = {r["doc_id"]: r["text"] for r in D.decontaminate(docs, items).collect()}
    assert got == {1: "Start here, then: ! End, with a good deal of other words after that.", 3: None}


# Classifiers


@pytest.mark.parametrize("query, label, cut", [("op8_quality", "quality", 0.3), ("op4_toxicity", "toxic", 0.5)])
def test_held_out_accuracy(spark, query, label, cut):
    run = {"op8_quality": quality.op8_quality, "op4_toxicity": toxicity.op4_toxicity}[query]
    rows = {r["doc_id"]: r for r in run(spark, MIDDLE).collect()}
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    for key, row in rows.items():
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= cut)
    told = [(rows[r["doc_id"]], r[label]) for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect() if r["doc_id"] in rows]
    held = [(row["score"], y) for row, y in told if row["held_out"]]
    pairs = [(a > b) + (a == b) / 2 for a, y in held if y == 1 for b, z in held if z == 0]
    assert np.mean(pairs) > (0.97 if label == "quality" else 0.8)


def test_classifiers_with_odd_rows(spark, odd_docs, docs_of):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(1, 8)] + [(6, 1, 1), (None, 1, 1), (4, None, None), (99, 1, 0)],
        "doc_id long, quality int, toxic int")
    for learn, score in ((quality.learn, quality.score_quality), (toxicity.learn, toxicity.score_toxicity)):
        rows = score(odd_docs, learn(odd_docs, labels)).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
        same = {r["score"] for r in rows if r["doc_id"] in (1, 2)}
        assert len(same) == 1
        assert score(docs_of([]), learn(docs_of([]), labels.where("false"))).collect() == []


def test_long_and_short_texts_score_alike_when_scored_in_other_company():
    import pyarrow as pa

    weights = np.random.default_rng(1).normal(size=quality.BUCKETS + 1).astype(np.float32)
    texts = ["", LONG, "a b", "x!! y | z", "same same same"]
    alone = [quality.text_scores(pa.array([t]), weights)[0] for t in texts]
    assert np.allclose(quality.text_scores(pa.array(texts), weights), alone)


def test_non_negative_risk_equals_a_plain_loop():
    """One step of the optimiser against finite differences of the risk, in both branches of the bound at zero."""
    rng = np.random.default_rng(3)
    size, prior = 6, 0.3
    seen = set()
    for trial in range(6):
        rows = [[rng.choice(size, rng.integers(0, 4), replace=False) for _ in range(n)] for n in (5, 9)]
        if trial % 2:
            # Unlabelled rows look like no positive, so that the second term turns negative at these weights.
            rows[1] = [np.array([5]) for _ in range(9)]
        theta = rng.normal(size=size + 1) * 3
        if trial % 2:
            theta[:5], theta[5], theta[-1] = 4.0, -9.0, 2.0

        def margin(weights, row):
            return sum(weights[j] for j in row) + weights[-1]

        def part(weights, index, sign):
            return np.mean([np.log1p(np.exp(-sign * margin(weights, row))) for row in rows[index]])

        def rest(weights):
            return part(weights, 1, -1) - prior * part(weights, 0, -1)

        # Above zero the whole risk goes down its gradient; below, the second term goes back up.
        on = rest(theta) >= 0
        seen.add(bool(on))
        risk = (lambda w: prior * part(w, 0, 1) + rest(w)) if on else (lambda w: -rest(w))
        steps = np.eye(size + 1) * 1e-6
        numeric = np.array([(risk(theta + h) - risk(theta - h)) / 2e-6 for h in steps])
        value, gradient = toxicity.risk_gradient(Rows(rows[0]), Rows(rows[1]), theta, prior)
        assert np.allclose(gradient, numeric, atol=1e-6)
        assert np.isclose(value, prior * part(theta, 0, 1) + max(0.0, rest(theta)))
    assert seen == {True, False}


def test_leader_updates_equal_a_plain_dictionary():
    rng = np.random.default_rng(4)
    learner, z, n = quality.Ftrl(20), {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * quality.L1) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2)

    for _ in range(300):
        ids = rng.choice(21, rng.integers(1, 6), replace=False)
        values, label = rng.normal(size=len(ids)) * 3, int(rng.integers(2))
        learner.update(ids, values, label)
        weights = {i: weight(i) for i in ids}
        p = 1 / (1 + np.exp(-sum(weights[i] * v for i, v in zip(ids, values))))
        for i, v in zip(ids, values):
            g = (p - label) * v
            sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / quality.ALPHA
            z[i] = z.get(i, 0.0) + g - sigma * weights[i]
            n[i] = n.get(i, 0.0) + g * g
    assert np.allclose(learner.weights(), [weight(i) for i in range(21)]) and np.any(learner.weights() == 0)


def test_features_equal_plain_splitting():
    """Equal words and pairs share buckets, and shares are counts over all of them."""
    import pyarrow as pa

    texts = ["the cat, the cat sat", "", "sat the cat", "b b b a", "x"]
    for text, (ids, shares) in zip(texts, quality.row_features(pa.array(texts))):
        words = re.findall(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]+", text)
        words = ["<same>" if i and w == words[i - 1] else w for i, w in enumerate(words)]
        assert np.isclose(shares.sum(), quality.SCALE if words else 0.0)
        pairs = set(zip(words, words[1:]))
        assert len(ids) <= len(set(words)) + len(pairs) and (not words or len(ids) >= len(set(words)))
    plain = ["kitten kitten dog", "dog kitten", "kittens"]
    first, second, third = (set(f.tolist()) for f in toxicity.text_features(pa.array(plain)))
    # Both have the same words, whatever stands behind them; another ending shares the first letters.
    assert first == second and len(first & third) >= len(toxicity.STARTS)
    assert len(first) <= 2 * (1 + len(toxicity.STARTS))


def test_rare_kinds_of_positives_keep_their_words():
    """A kind that is 2 % of the positives, with words of its own, is found, and clean texts are left alone."""
    import pyarrow as pa

    rng = random.Random(2)
    plain = [f"word{i}" for i in range(400)]

    def text(own=()):
        return " ".join(rng.choice(plain) for _ in range(30)) + "".join(f" {rng.choice(own)}" for _ in range(3 if own else 0))

    common, rare = [f"vile{c}" for c in "abcdef"], [f"grim{c}" for c in "uvwxyz"]
    positives = [text(rare if i % 50 == 0 else common) for i in range(3000)]
    others = [text(common) if i % 20 == 0 else text(rare) if i % 1000 == 1 else text() for i in range(9000)]
    made = [toxicity.text_features(pa.array(t)) for t in (positives, others)]
    model = toxicity.fit(*made, 0.051)

    def share(texts):
        return np.mean(model.scores(pa.array(texts)) >= 0.5)

    assert share([text(common) for _ in range(300)]) >= 0.99
    assert share([text(rare) for _ in range(300)]) >= 0.9
    assert share([text() for _ in range(1000)]) <= 0.005


def test_rows_without_a_key_are_not_held_out(spark, tmp_path, docs_of):
    docs_of([(None, "some text"), (3, "other text"), (5, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(3, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = {r["doc_id"]: r["held_out"] for r in toxicity.op4_toxicity(spark, str(tmp_path)).collect()}
    assert rows == {None: False, **{k: zlib.crc32(str(k).encode()) % 5 == 0 for k in (3, 5)}}


@pytest.mark.parametrize("shard_bytes, per_pass", [(1 << 20, 4), (150, 4), (40, 1)])
def test_many_shards_find_what_one_automaton_finds(spark, docs_of, shard_bytes, per_pass):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 12, 30])))) for i in range(50)] + [(None, "w1 w2 w3 w4 w1")]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(30)]
    texts = [t + " " + items[i % 50][1] + " x " + items[i * 7 % 50][1] for i, t in enumerate(texts)] + ["w1 w2 w3 w4 w1", "", None]
    docs = docs_of([(i, t) for i, t in enumerate(texts + texts[:5])])
    bench = spark.createDataFrame(items, "item_id long, text string")
    if per_pass == 1:
        assert D.built_shards(bench, "text", "item_id", 10, shard_bytes)[1] >= 50
    whole = D.SuffixAutomaton([("" if k is None else str(k), D.split_words(t)) for k, t in items])
    got = {r["doc_id"]: (r["n_words"], [tuple(s) for s in r["spans"]], r["items"])
           for r in D.match_items(docs, bench, shard_bytes=shard_bytes, per_pass=per_pass).collect()}
    plain = {}
    for i, t in enumerate(texts + texts[:5]):
        count, spans, names = whole.match(t or "")
        plain[i] = (count, spans, sorted(names))
    assert got == plain and sum(bool(spans) for _, spans, _ in plain.values()) >= 30
    kept = {r["doc_id"]: r["text"] for r in D.decontaminate(docs, bench, shard_bytes=shard_bytes, per_pass=per_pass).collect()}
    assert kept == {i: t if not t else D.cut_spans(t, plain[i][1]) for i, t in enumerate(texts + texts[:5])
                    if sum(e - s for s, e in plain[i][1]) <= 0.5 * plain[i][0]}


def _peak(run):
    tracemalloc.start()
    try:
        made = run()
        return made, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_stages_hold_a_part_of_a_batch_and_return_only_texts_that_change():
    item = " ".join(f"item{i}" for i in range(12))
    texts = [None, "", f"before {item} " + "after " * 20] + [f"row {i} " + f"word{i % 50} " * 400 for i in range(9_000)]
    batch = pa.array(texts, pa.string())
    automata = [D.SuffixAutomaton([("a", D.split_words(item))])]
    none = pa.nulls(len(texts), pa.list_(pa.int64()))
    made, peak = _peak(lambda: D._cleaned(batch, none, automata, 0.5))
    assert peak < batch.nbytes / 3
    cuts = made.field("cut")
    assert cuts.null_count == len(texts) - 1 and cuts[2].as_py() == "before  " + "after " * 20
    assert not any(made.field("dropped").to_pylist())
    weights = np.zeros(quality.BUCKETS + 1, np.float32)
    scores, peak = _peak(lambda: quality.batch_scores(batch, weights))
    assert peak < 1.5 * batch.nbytes and scores.to_pylist() == [0.5] * len(texts)
    few = pa.array([None, "", "plain words", "password = abcdef123 here"] + ["more plain words"] * 50, pa.string())
    plain = secrets.train([])
    red = secrets._redacted(few, secrets.Emissions(plain), secrets._steps(plain), "[SECRET]").to_pylist()
    assert [i for i, value in enumerate(red) if value is not None] == [3] and red[3].endswith("[SECRET] here")
