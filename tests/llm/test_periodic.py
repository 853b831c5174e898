"""Periodic runs against SQL, against trying every period, and on odd inputs."""

import random

import numpy as np
import pytest
from oracle import compare, connect

from millrace.llm import periodic
from millrace.llm.queries import ORACLES, QUERIES


def brute(words, shortest=6, exponent=4):
    """Every maximal stretch by every period; then only those whose period is the smallest."""
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end > start and end + q - start >= max(shortest, exponent * q):
                smaller = any(words[start : end + q - d] == words[start + d : end + q] for d in range(1, q))
                if not smaller:
                    found.append((start, end + q - start, q))
            start = max(end, start) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts_of(dice):
    for _ in range(120):
        parts = []
        for _ in range(dice.randrange(1, 6)):
            unit = [f"w{dice.randrange(dice.choice([2, 4, 30]))}" for _ in range(dice.randrange(1, 9))]
            whole = unit * dice.randrange(1, 8)
            parts += whole[: len(whole) - dice.randrange(len(unit))]
        yield " ".join(parts)
    yield " ".join(["a"] * 1000)
    yield " ".join(["a"] * 5 + ["b"] + ["a"] * 6)
    yield " ".join(list("aab" * 40) + list("ab" * 30) + list("aab" * 20))


def check(rows, texts, **options):
    for row, text in zip(rows, texts, strict=True):
        words = (text or "").encode().split()
        words = [w.decode() for w in words]
        runs = brute(words, **options)
        assert (row.n_words, [tuple(r) for r in row.runs]) == (len(words), runs), text
        assert row.collapsed == collapse(words, runs)


@pytest.mark.parametrize("size", [64, 1 << 17])
def test_against_every_period(spark, size, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_WORDS", size)
    texts = [*texts_of(random.Random(5)), None, "", " \t\n", "é é é é é é", "a\x0ba\x0ca\ra a\ta", "a\xa0a a\xa0a a\xa0a a\xa0a a\xa0a a\xa0a a\x85"]
    batches = list(texts[i : i + 40] for i in range(0, len(texts), 40))
    for options in ({}, {"shortest": 12, "exponent": 3}):
        got = []
        for part in batches:
            for _, words in periodic._batches(__import__("pyarrow").array(part)):
                sizes, runs, collapsed = periodic._search(words, options.get("shortest", 6), options.get("exponent", 4))
                got += zip(sizes.to_pylist(), runs.to_pylist(), collapsed.to_pylist())
        for (n, runs, collapsed), text in zip(got, texts, strict=True):
            words = [w.decode() for w in (text or "").encode().split()]
            want = brute(words, **options)
            assert (n, [tuple(r.values()) for r in runs]) == (len(words), want), text
            assert collapsed == collapse(words, want)


def test_rows_keys_and_clashing_names(spark):
    texts = ["a b c " * 5, "a b c " * 5, None, "x", "q " * 7]
    rows = list(zip([3, 3, 1, None, None], texts, range(5), "abcde"))
    df = spark.createDataFrame(rows, "doc_id long, text string, runs long, key string")
    found = periodic.find_runs(df)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = found.collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "3", "3", "None", "None"]
    by_text = {(r.doc_id, r.n_words): [tuple(x) for x in r.runs] for r in got}
    assert by_text == {(3, 15): [(0, 15, 3)], (1, 0): [], (None, 1): [], (None, 7): [(0, 7, 1)]}
    check(spark.createDataFrame([(t,) for t in texts], "text string").transform(lambda d: periodic.find_runs(d, key="text")).collect(), texts)
    assert periodic.find_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.find_runs(df, exponent=2)


def test_very_long_texts(spark):
    dice = np.random.default_rng(2)
    noise = [f"n{i}" for i in dice.permutation(300_000)]
    unit = [f"u{i}" for i in range(25_000)]
    words = noise + unit * 4 + unit[:77] + ["end"] * 9
    row = periodic.find_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(300_000, 100_077, 25_000), (400_077, 9, 1)]
    assert row.collapsed == " ".join(noise + unit + ["end"])


def test_against_sql(spark, sf_dir):
    df = QUERIES["op11_periodic_runs"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert compare(df, connect(sf_dir), ORACLES["op11_periodic_runs"])[0] == "ok"
