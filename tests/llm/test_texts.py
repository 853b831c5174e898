"""Near copies and benchmark passages: against SQL and brute force, and on odd inputs."""

import random
from functools import reduce

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect
from test_native import brute_components

from millrace.llm import decontaminate as dc
from millrace.llm import near_copies as nc
from millrace.llm.fm_index import FMIndex, suffix_order
from millrace.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op3_decontaminate", "op6_near_copies"])
def test_against_sql(name, spark, sf_dir):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])[0] == "ok"


# -- the index ------------------------------------------------------------------------------------

runs = st.lists(st.lists(st.integers(1, 4), max_size=12), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(runs, st.lists(st.lists(st.integers(1, 6), min_size=1, max_size=5), min_size=1, max_size=10))
def test_index_finds_all_occurrences(parts, patterns):
    symbols = np.array([s for p in parts for s in [*p, 0]], np.int64)
    index = FMIndex(symbols, sample=3)
    lengths = np.array([len(p) for p in patterns])
    padded = np.array([[0] * (5 - len(p)) + p for p in patterns])
    low, high = index.search(padded, lengths)
    for pattern, a, b in zip(patterns, low, high):
        want = [i for i in range(len(symbols)) if symbols[i : i + len(pattern)].tolist() == pattern]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_suffixes_end_at_separators():
    symbols = np.array([2, 1, 0, 2, 1, 0, 1, 0])
    order = suffix_order(symbols).tolist()
    rank = {0: "", 1: "b", 2: "c"}
    gaps = [i for i, s in enumerate(symbols) if s == 0]

    def text(i):
        end = next(g for g in gaps if g >= i)
        return "".join(rank[s] for s in symbols[i:end]) + chr(gaps.index(end) + 33)

    assert order == sorted(range(8), key=text)


# -- decontamination ------------------------------------------------------------------------------


def brute_spans(words, windows):
    hit = [False] * len(words)
    for w in windows:
        for i in range(len(words) - len(w) + 1):
            if words[i : i + len(w)] == w:
                hit[i : i + len(w)] = [True] * len(w)
    edges = [i for i in range(len(words) + 1) if (i > 0 and hit[i - 1]) != (i < len(words) and hit[i])]
    return list(zip(edges[::2], edges[1::2]))


def test_spans_and_items(spark, monkeypatch):
    monkeypatch.setattr(dc, "SHARD_WORDS", 40)  # many shards
    dice = random.Random(1)
    vocabulary = ["a", "B", "é", "x9", "ſ", "ein"]

    def text(n):
        return "".join(dice.choice(vocabulary) + dice.choice([" ", "-", "\n", "...", " ", "\x7f"]) for _ in range(n))

    items = [(i, text(dice.choice([1, 2, 3, 4, 30])) if i > 3 else t) for i, t in enumerate([None, "", " -- ", "once upon a time there was one more thing to say about it"] + [0] * 16)]
    items += [(3, items[3][1]), (None, items[3][1])]
    docs = [(i, text(dice.randrange(60))) for i in range(150)] + [(150, None), (151, ""), (152, "!?"), (7, "Once upon-a TIME there was one, more thing to say about it. Yes"), (None, "ein " * 3000)]
    found = dc.find_contamination(
        spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, items string"), spark.createDataFrame(items, "item_id long, text string"), window=4
    ).collect()
    windows = {}
    for i, t in items:
        w = dc.words_of(t)
        for s in range(max(1, len(w) - 3) if w else 0):
            windows.setdefault(tuple(w[s : s + 4]), set()).add("null" if i is None else str(i))
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.n_words, [tuple(s) for s in r.spans], [tuple(s) for s in r.chars], list(r["items"])))
    for i, t in docs:
        words = dc.words_of(t)
        spans = brute_spans(words, [list(w) for w in windows])
        owners = reduce(set.union, [o for w, o in windows.items() if any(words[k : k + len(w)] == list(w) for k in range(len(words)))], set())
        chars = dc.removal_spans(t or "", spans)
        assert (len(words), spans, chars, sorted(owners)) in by_id[i]
        for a, b in chars:
            assert dc.words_of(t[a:b]) and t[a:b].strip(" -\n. \x7f") == t[a:b]
    assert dc.without_spans("abcdef", [(1, 2), (4, 6)]) == "acd"


def test_blocks_of_a_large_benchmark_agree(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = sorted(map(str, dc.find_contamination(docs, items).collect()))
    kept = sorted(r.doc_id for r in dc.drop_contaminated(docs, items).collect())
    monkeypatch.setattr(dc, "BLOCK_BYTES", 3000)
    assert sorted(map(str, dc.find_contamination(docs, items).collect())) == whole
    assert sorted(r.doc_id for r in dc.drop_contaminated(docs, items).collect()) == kept
    assert any("Row(from" in r for r in whole) and len(kept) < docs.count()


def test_nothing_to_search(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.find_contamination(docs.limit(0), items).collect() == []
    row = dc.find_contamination(docs, items.limit(0)).first()
    assert (row.n_words, row.spans, row["items"]) == (2, [], [])
    assert dc.drop_contaminated(docs, items.limit(0)).count() == 1 and dc.drop_contaminated(docs, items).count() == 0


# -- near copies ----------------------------------------------------------------------------------


def brute_near(docs):
    sets = []
    for _, t in docs:
        w = nc.words_of(t or "")
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [
        (docs[i][0], docs[j][0]) for i in range(len(docs)) for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    root = brute_components([p for p in links if p[0] != p[1]])
    return {i: (len(s), root.get(i, i)) for (i, _), s in zip(docs, sets)}


def family(dice, first, size, words, edits):
    base = [f"w{dice.randrange(9999)}" for _ in range(words)]
    out = []
    for n in range(size):
        own = list(base)
        for _ in range(dice.randrange(edits + 1)):
            own[dice.randrange(words)] = f"n{dice.randrange(9999)}"
        out.append((first + n, " ".join(own)))
    return out


def test_near_copies_against_brute_force(spark):
    dice = random.Random(2)
    docs = [(i, " ".join(f"w{dice.randrange(300)}" for _ in range(dice.randrange(1, 80)))) for i in range(150)]
    docs += family(dice, 1000, 120, 100, 6) + family(dice, 2000, 60, 30, 2) + family(dice, 3000, 10, 3000, 60) + family(dice, 4000, 40, 7, 1)
    docs += [(5000, None), (5001, ""), (5002, " \t"), (5003, "One two"), (5004, "one\ntwo"), (5005, "one two three"), (5006, "\x85"), (5007, "É"), (5008, "é")]
    docs += [(6000 + i, docs[150][1].upper()) for i in range(30)]
    dice.shuffle(docs)
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, n_shingles int")
    got = {r.doc_id: r for r in nc.near_copies(df).collect()}
    want = brute_near(docs)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_signatures_that_hardly_filter_give_the_same(spark):
    """Few bands of few rows: buckets that hold many components, so that the block comparison works."""
    dice = random.Random(4)
    docs = [(i, " ".join(f"w{dice.randrange(12)}" for _ in range(14))) for i in range(120)] + family(dice, 500, 30, 20, 2)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    spec = nc.Signature(bands=64, rows=1, bits=2, block=16)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nc.near_copies(df, spec=spec).collect()}
    assert got == brute_near(docs)


def test_repeated_rows_null_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "x"), (None, None)], "doc_id long, text string")
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nc.near_copies(df).collect()), key=str)
    assert rows == sorted([(1, 2, -(1 << 63), False)] * 2 + [(None, 2, -(1 << 63), True), (2, 1, 2, True), (None, 0, -(1 << 63), True)], key=str)
    assert nc.near_copies(df.limit(0)).collect() == []


def test_estimate_is_corrected_for_collisions():
    spec = nc.Signature()
    seeds, dice = spec.seeds(), random.Random(8)
    for same in (0.3, 0.75, 0.95):
        a, b = [], []
        for _ in range(40):
            shared = [f"s{dice.random()}" for _ in range(int(600 * same))]
            own = [[f"o{dice.random()}" for _ in range(int(300 * (1 - same)))] for _ in range(2)]
            for side, extra in zip((a, b), own):
                values = np.unique(np.array([nc._hashes[w.encode()] for w in shared + extra], np.uint64))
                minima = nc._minima(values, seeds)
                bits = minima[:, None] >> np.arange(spec.bits, dtype=np.uint32)[None, :] & np.uint32(1)
                side.append(np.packbits(bits.astype(np.uint8).ravel()))
        differ = nc.differing(np.array(a), np.array(b), spec.bits).mean() / spec.size
        estimate = (1 - differ - 0.25) / 0.75
        shared_part = int(600 * same) / (int(600 * same) + 2 * int(300 * (1 - same)))
        assert estimate == pytest.approx(shared_part, abs=0.03)
