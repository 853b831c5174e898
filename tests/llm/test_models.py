"""Chat formatting, vectors, token files, toxicity, quality: round trips, brute force, held-out rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect
from pyspark.sql import functions as F
from test_native import brute_components

from millrace.llm import quality, toxicity, vectors
from millrace.llm import token_files as tf
from millrace.llm.chat import CONTROLS, ROLES, escape, format_chat, read_chat, unescape
from millrace.llm.model_queries import HOSTILE, vocabulary, word_tokenizer
from millrace.llm.queries import ORACLES, QUERIES

LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op1_chat_format", "op2_near_vectors"])
def test_against_sql(name, spark, sf_dir):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])[0] == "ok"


# -- chat -----------------------------------------------------------------------------------------

hostile = st.lists(st.sampled_from([*CONTROLS, "\\", "<", "[", "s>", "INST]", "<SYS>>", "/", "a", "é", " "]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(hostile)
def test_escape_is_reversible_and_leaves_no_control(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


def test_conversations_read_back(spark):
    turns = [
        (1, 0, "system", "be <s> kind"), (1, 1, "user", HOSTILE), (1, 2, "assistant", HOSTILE), (1, 3, "tool</s>", "x\x00y"), (1, 4, "assistant", None),
        (1, 5, "assistant", "\U0001f600 é\n" * 200), (2, None, None, "first"), (2, 0, "assistant", ""), (None, 0, "user", "<\\s>"),
        (3, 0, "user", "b"), (3, 0, "user", "b"), (4, 0, "assistant", "x" * 300_000),
    ]
    df = spark.createDataFrame([(*t, 9) for t in turns], "conv_id long, turn long, role string, text string, ids int")
    pieces = format_chat(df.repartition(5), vocabulary(), limit=20)
    got = {r.conv: r for r in read_chat(pieces, vocabulary()).collect()}
    for conv in (1, 2, None, 3, 4):
        own = [(r or "", t or "") for c, _, r, t in turns if c == conv]
        loss = "".join(t for r, t in own if r == "assistant")
        row = got[conv]
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        marks = [sum(map(len, ROLES[r])) if r in ROLES else 23 + len(escape(r)) for r, _ in own]
        assert row.formatted_chars == sum(marks) + sum(len(escape(t)) for _, t in own)
    assert max(r.piece for r in pieces.where("conv = 1").collect()) == 2
    for r in pieces.collect():  # reserved ids are never under the mask
        assert not any(m and i >= vocabulary().reserved for i, m in zip(r.ids, r.loss))
    assert read_chat(format_chat(df.limit(0), vocabulary()), vocabulary()).collect() == []


# -- vectors --------------------------------------------------------------------------------------


def brute_vectors(rows, threshold=0.93):
    links, pairs = {i: 0 for i, _, _ in rows}, []
    good = [(i, v / np.linalg.norm(v), k) for i, v, k in ((i, np.array(v, float) if v and None not in v else np.zeros(1), k) for i, v, k in rows) if k is not None and np.isfinite(v).all() and v.any()]
    for n, (i, v, k) in enumerate(good):
        for j, w, m in good[:n]:
            if k == m and len(v) == len(w) and v @ w >= threshold:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    root = brute_components(pairs)
    return {i: (links[i], root.get(i, i)) for i in links}


def make_vectors(seed, n=600, dim=24):
    dice = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if i and dice.random() < 0.5:  # a near copy, at all distances around the threshold
            v = np.array(out[dice.integers(len(out))][1])
            v = v / np.linalg.norm(v) + dice.normal(size=dim) * dice.uniform(0.2, 0.5) / dim**0.5
        else:
            v = dice.normal(size=dim)
        out.append((i, [float(x) for x in v], int(dice.integers(3))))
    return out


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_against_brute_force(spark, block):
    rows = make_vectors(1)
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(40)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 24, 1), (2003, [float("nan")] * 24, 1), (2004, [1.0, None] * 12, 1), (2005, [float("inf")] + [0.0] * 23, 1)]
    rows += [(2006, rows[5][1], None), (2007, [1.0, 2.0], 1), (2008, [1.0, 2.1], 1), (2009, [1e-200] * 24, 1), (2010, [1e200] * 24, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    spec = vectors.Cells(per_cell=24, block=block)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df, spec=spec).collect()}
    want = brute_vectors(rows)
    want[2009], want[2010] = (1, 2009), (1, 2009)
    found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert found >= 0.97 * there and all(got[i][0] <= want[i][0] for i in want)
    exact = vectors.Cells(per_cell=24, block=block, deviations=24**0.5)
    assert {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df, spec=exact).collect()} == want


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(df).collect() == []


# -- token files ----------------------------------------------------------------------------------

TEXTS = [None, "", "  ", "Hello, wörld's 123 THE <|endoftext|> \x1c a\x0bb\x0cc d\u0085e É é H̱ ΑΣ Σ", "x" * 5000, "don't we'll\r\nI've " * 50, "日本語 テスト" * 20]


def whole(texts):
    t = tf._tokenizer(word_tokenizer())[0]
    return [np.array(e.ids + [2], "<u4").tobytes() for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_words_encode_as_whole_texts(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert list(tf.Encoder(word_tokenizer(), 2).encode(texts)) == whole(texts)


def test_words_are_forgotten_at_the_last_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    files = tf.write_token_files(df, f"file:{tmp_path}/tokens", word_tokenizer()).select("file", "base").toArrow().to_batches()
    for last in (False, True):
        words = tf._tokenizer(word_tokenizer())[1]
        assert words[b"some"] and words[b"some"] and words
        read = [r for b in tf._read(f"file:{tmp_path}/tokens", None, last)(files) for r in b.to_pylist()]
        assert (tf._tokenizer.cache_info().currsize == 0) == last
        assert [r["ids"] for r in read] == whole(["some words", ""])


def test_token_files_round_trip(spark, sf_dir, monkeypatch):
    docs = [(i, TEXTS[i % len(TEXTS)]) for i in range(300)] + [(None, "null key"), (5, "again"), (5, "again")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, start int")
    rows = sorted(tf.token_table(df.repartition(7), word_tokenizer()).collect(), key=lambda r: r.start)
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0], d[1] or ""))
    at = 0
    for row, (key, _), ids in zip(rows, order, whole([t for _, t in order])):
        assert (row.key, row.start, row.n_tokens, bytes(row.ids)) == (key, at, len(ids) // 4, ids)
        at += row.n_tokens
    assert len(rows) == len(docs)
    assert tf.token_table(df.limit(0), word_tokenizer()).collect() == []


def test_given_documents_as_whole_texts(spark, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op4_token_files"](spark, sf_dir).collect()}
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    at = 0
    for (key, _), ids in zip(docs, whole([t for _, t in docs])):
        assert tuple(rows[key]) == (key, at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    assert len(rows) == len(docs)


def test_reader_fetches_only_the_frames_it_needs(tmp_path):
    path = tmp_path / "x.zst"
    dice = np.random.default_rng(0)
    docs = [(k, dice.integers(0, 50_000, dice.integers(1, 9000)).astype("<u4").tobytes()) for k in range(60)]
    docs[30] = (30, dice.integers(0, 50_000, 3 * tf.LARGEST_FRAME // 4).astype("<u4").tobytes())
    with open(path, "wb") as out:
        writer = tf.FileWriter(out)
        for key, ids in docs:
            writer.add(key, ids)
        assert writer.finish() == sum(len(i) // 4 for _, i in docs)
    with open(path, "rb") as file:
        reader = tf.FileReader(file, path.stat().st_size)
        reads = []
        at = reader._at
        reader._at = lambda place, length: reads.append(length) or at(place, length)
        assert reader.ids(7) == docs[7][1] and sum(reads) < 0.05 * path.stat().st_size
        assert all(reader.ids(n) == ids for n, (_, ids) in enumerate(docs))
    # Any reader of zstandard sees the ids of all documents, one after the other.
    with open(path, "rb") as file, zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True) as frames:
        assert frames.read(len(docs[0][1])) == docs[0][1]
    data = bytearray(path.read_bytes())
    data[int(reader.places[3]) + 40] ^= 1
    path.write_bytes(data)
    with open(path, "rb") as file, pytest.raises((ValueError, zstandard.ZstdError)):
        tf.FileReader(file, len(data)).frame(3)


# -- toxicity -------------------------------------------------------------------------------------


def test_held_out_documents_are_told_apart(spark):
    rows = QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    # Some labels here are of texts that were overwritten afterwards and hold nothing toxic.
    assert np.mean([t >= 0.5 for t in toxic]) >= 0.85 and np.mean([c >= 0.5 for c in clean]) <= 0.01
    assert len(toxic) > 50 and len(clean) > 400


def test_label_model_finds_accuracies_and_correlations(spark):
    dice = np.random.default_rng(2)
    n, lexicon = 6000, toxicity.Lexicon([], 1)
    y = dice.random(n) < 0.2
    one = np.where(y, dice.random(n) < 0.8, dice.random(n) < 0.05)
    two = np.where(dice.random(n) < 0.9, one, dice.random(n) < 0.5)  # nearly a copy of the first
    rest = [np.where(y, dice.random(n) < 0.6, dice.random(n) < 0.1) for _ in range(3)]
    masks = sum(v.astype(np.int64) << i for i, v in enumerate([one, two, *rest]))
    rows = [(int(m), int(t) if k < 600 else None) for k, (m, t) in enumerate(zip(masks, y))]
    votes = spark.createDataFrame(rows, "mask long, gold int").groupBy("mask", "gold").agg(F.count("*").alias("n"))
    model = toxicity._estimate(votes, lexicon, toxicity.Settings())
    assert model.prior == pytest.approx(0.2, abs=0.04) and model.toxic[0] == pytest.approx(0.8, abs=0.06) and model.clean[2] == pytest.approx(0.1, abs=0.05)
    assert model.correlations[0, 1] > 0.5 > abs(model.correlations[0, 2]) + 0.3
    assert abs(model.weights[1]) < abs(model.weights[2])  # the copy adds little


def test_posteriors_choose_patterns_of_unlabelled_documents(spark):
    """A word that no labelled document has, beside words that are known, and labels that are wrong; copies
    with different labels give the same result however the rows lie."""
    dice = np.random.default_rng(3)
    toxic = ["wretch", "vermin", "cretin", "oaf"]
    plain = [f"calm{i:02d}" for i in range(60)]
    texts, truth = [], []
    for i in range(3000):
        words, bad = list(dice.choice(plain, 12)), bool(dice.random() < 0.2)
        if bad:
            words[::4] = dice.choice(toxic, 3)
            if i >= 1000:  # from here on nothing is labelled
                words[1] = "snollygoster"
        texts.append(" ".join(words)), truth.append(bad)
    gold = [(i, int(t != (i % 25 == 0))) for i, t in enumerate(truth[:1000])]  # every 25th label is wrong
    texts += ["a wretch and a cretin"] * 4
    gold += [(3000, 1), (3001, 0), (3002, 1), (3003, 0)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(gold, "doc_id long, toxic int")
    model = toxicity.train(docs.repartition(5), labels)
    assert "word:snollygoster" in model.lexicon.numbers  # chosen by posteriors, no labelled row has it
    scores = [r.s for r in docs.orderBy("doc_id").select(model.score(F.col("text")).alias("s")).collect()]
    assert np.mean([(s >= 0.5) == t for s, t in zip(scores, truth)]) >= 0.99
    assert model.label_model.label_toxic > 0.85 and model.label_model.label_clean < 0.1
    again = toxicity.train(docs.repartition(3, "text"), labels.orderBy("toxic"))
    assert np.allclose(sorted(again.weights), sorted(model.weights), atol=1e-6) and again.lexicon.patterns == model.lexicon.patterns


def test_toxicity_on_odd_input(spark):
    docs = spark.createDataFrame([(i, f"you are a wretch {i}" if i % 3 == 0 else f"fine day {i}", "x") for i in range(300)] + [(900, None, "x"), (901, "", "x"), (None, "are you a wretch", "x"), (3, "you are a wretch 3", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(None, 1), (5, None), (3, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.s for r in docs.select("doc_id", model.score(F.col("text")).alias("s")).collect()}
    assert all((got[i] >= 0.5) == (i % 3 == 0) for i in range(300)) and got[None] >= 0.5 and got[900] == got[901] < 0.5
    assert toxicity.train(docs, labels.limit(0)).weights.tolist() == []
    empty = toxicity.train(docs.limit(0), labels)
    assert docs.limit(0).select(empty.score(F.col("text"))).collect() == []


# -- quality --------------------------------------------------------------------------------------


def test_probabilities_sum_to_one_and_joins_agree(spark):
    dice = random.Random(3)
    texts = [" ".join("".join(dice.choice("abcé") for _ in range(dice.randrange(1, 6))) for _ in range(30)) for _ in range(40)]
    model = quality.train(spark.createDataFrame([(t,) for t in texts], "body string"))
    table = model.toPandas()
    scorer = quality.Scorer(table.gram.tolist(), table.p.to_numpy(), table.back.to_numpy(), 4)
    for context in ("", "a", quality.BEGIN, quality.BEGIN + "é", "bca", "zzz", quality.BEGIN + "ab"):
        seen = sum(scorer.symbol(context + s) for s in [*"abcé", quality.END])
        assert seen + scorer.symbol(context + "一") == pytest.approx(1.0)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", "zz qq一 abc abc", "a" * 3000])], "id long, body string")
    near = {r.id: (round(r.log, 6), r.symbols) for r in quality.score(rows, model).collect()}
    far = {r.id: (round(r.log, 6), r.symbols) for r in quality.score(rows, model, quality.Model(broadcast=0)).collect()}
    assert near == far and near[40] == near[41] == (0.0, 0)


def test_trusted_language_is_kept_and_junk_is_not(spark):
    got = QUERIES["op9_quality"](spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in got if r.quality == 1]
    junk = [r.kept for r in got if r.quality == 0 and r.toxic == 0]
    assert np.mean(good) >= 0.97 and np.mean(junk) <= 0.3


def test_quality_on_odd_input(spark):
    docs = spark.createDataFrame([(1, "a b", None, 0), (1, "a b", None, 0), (2, None, "x", 0), (3, " \n", "x", 0), (None, "a", "x", 0)], "doc_id long, text string, lang string, symbols int")
    trusted = spark.createDataFrame([(1,), (None,), (1,)], "doc_id long")
    rows = [(r.doc_id, r.symbols, r.perplexity is None, r.kept) for r in quality.judge_quality(docs, trusted).collect()]
    assert sorted(rows, key=str) == sorted([(1, 4, False, True)] * 2 + [(2, 0, True, False), (3, 0, True, False), (None, 2, False, True)], key=str)
    assert quality.judge_quality(docs.limit(0), trusted).collect() == []


def test_word_order_counts_and_words_sum_to_one(spark):
    dice = random.Random(7)
    subject, verb, thing = ["we", "they", "cats", "dogs"], ["see", "like", "find"], ["red boats", "old maps", "warm bread"]
    lines = [" ".join(f"{dice.choice(subject)} often {dice.choice(verb)} the {dice.choice(thing)} ." for _ in range(12)) for _ in range(80)]
    mixed = []
    for line in lines[:30]:
        words = line.split()
        dice.shuffle(words)
        mixed.append(" ".join(words))
    docs = [(i, t, "en") for i, t in enumerate([*lines, *mixed, "zzq " * 20, lines[0], None])]
    trusted = spark.createDataFrame([(i,) for i in range(80)], "doc_id long")
    got = {r.doc_id: r for r in quality.judge_quality(spark.createDataFrame(docs, "doc_id long, text string, lang string"), trusted).collect()}
    good = [got[i].perplexity for i in range(30)]
    assert all(got[80 + i].perplexity > 1.5 * p and not got[80 + i].kept for i, p in enumerate(good))
    assert not got[110].kept and got[111].perplexity == pytest.approx(got[0].perplexity) and got[111].symbols == got[0].symbols == len(lines[0]) + 1
    assert got[112].perplexity is None

    model = quality.train_words(spark.createDataFrame([(t,) for t in ["a b a c", "b a b", "c c a b"]], "body string"))
    levels = [{r.gram: r.p for r in level.collect()} for level in model.levels]
    backs = [{r.context: r.back for r in c.collect()} for c in model.contexts]
    asked = ["\x02 a b", "b a c", "c b a", "a b zz", "zz zz b", "\x02 q", "a q", "\x02 b"]
    spelled = {r.gram: r.log for r in model.spelled(spark.createDataFrame([(w,) for w in ("zz", "q", "a", "b", "c")], "gram string")).collect()}

    def log(words):
        k = len(words)
        if (p := levels[k - 1].get(" ".join(words))) is not None:
            return np.log(p)
        back = np.log(backs[k - 1].get(" ".join(words[:-1]), 1.0))
        return back + (spelled[words[0]] if k == 1 else log(words[1:]))

    answers = {r.gram: r.log for r in model.logs(spark.createDataFrame([(g,) for g in asked], "gram string"), 3).collect()}
    assert answers == pytest.approx({g: log(g.split(" ")) for g in asked})
    known = sum(np.exp(log(["a", "b", w])) for w in "abc")
    unseen = backs[2]["a b"] * backs[1]["b"] * backs[0][""] * (1 - sum(np.exp(spelled[w]) for w in "abc"))
    assert known + unseen == pytest.approx(1.0)
