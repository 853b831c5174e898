"""Hard negatives against SQL, against comparing all, and on odd inputs."""

import math
import random

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from millrace.llm import negatives as ng
from millrace.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, number long"


def brute(rows, is_anchor, spec):
    taking = [
        (i, [math.floor(spec.scale * x) for x in v], k)
        for i, v, k in rows
        if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for i, v, k in taking:
        if i is None or not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in taking if j != i and len(v) == len(w)]
        for best, j, _ in sorted((r for r in scored if r[2] == k), key=order)[: spec.positives]:
            fits = [r for r in scored if r[2] != k and spec.low * best <= 100 * r[0] <= spec.high * best]
            out += [(i, j, n + 1, r[1], best, r[0]) for n, r in enumerate(sorted(fits, key=order)[: spec.negatives])]
    return sorted(out, key=str)


def vectors(dice, n, dim, labels, spread=1.0):
    centres = [[dice.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    for i in range(n):
        k = dice.randrange(labels)
        yield i, [c + dice.gauss(0, spread) for c in centres[k if dice.random() < 0.7 else dice.randrange(labels)]], k


@pytest.mark.parametrize("wave,block", [(8 << 20, 4 << 20), (2_000, 3_000)])
def test_against_comparing_all(spark, monkeypatch, wave, block):
    monkeypatch.setattr(ng, "WAVE_BYTES", wave)
    monkeypatch.setattr(ng, "BLOCK_BYTES", block)
    dice = random.Random(9)
    rows = list(vectors(dice, 400, 24, 4))
    rows += [(i + 1000, [dice.choice([0.0, 0.5, 1.0]) for _ in range(3)], dice.randrange(2)) for i in range(60)]  # ties
    rows += [(1020, [0.0] * 3, 1), (1040, [-1.0] * 3, 0), (1040, [-1.0] * 3, 0), (None, [1.0] * 3, 1), (None, [1.0] * 3, 0)]
    rows += [(2000, None, 1), (2020, [1.0, None, 1.0], 1), (2040, [math.nan, 1.0, 1.0], 1), (2060, [math.inf, 1.0, 1.0], 0), (2080, [1.0] * 3, None)]
    rows += [(3000, [], 1), (3001, [], 1), (3002, [], 0), (4000, [1.0] * 5, 7), (1020, [1.0, 2.0, 0.5], 0)]
    dice.shuffle(rows)
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], SCHEMA).repartition(5)
    spec = ng.Mining(positives=4, negatives=6)
    found = ng.mine_negatives(df, F.col("vec_id") % 20 == 0, spec=spec)
    want = brute(rows, lambda i: i % 20 == 0, spec)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert len(want) > 400


def test_numbers_beyond_doubles(spark):
    rows = [(0, [3e6, 1e6 + 1], 0), (1, [3e6 - 1, 1e6], 0), (2, [2e6, 1.0], 1), (3, [2e6, 2.0], 1), (20, [1.0, 1.0], 1)]
    df = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    spec = ng.Mining(scale=256)
    got = sorted((tuple(r) for r in ng.mine_negatives(df, F.col("vec_id") == 0, spec=spec).collect()), key=str)
    assert got == brute(rows, lambda i: i == 0, spec) and got


def test_bounds_rule_rows_out_early():
    """Rows far from an anchor whose weight lies in few dimensions are gone before the rest is read."""
    dice = np.random.default_rng(1)
    vectors = dice.integers(-20, 20, (500, 64))
    vectors[:20, :3] = 200
    block = ng.Block(np.arange(500), np.ones(500, bool), np.zeros(500, int), vectors)
    anchor = dice.integers(-2, 3, 64)
    anchor[:3] = 250
    seen = []

    def keep(least, most):
        seen.append(len(least))
        return most >= ng._largest(least, 5)

    alive, scores = ng.narrow(block, anchor, np.arange(500), keep)
    assert seen[0] == 500 and max(seen[1:]) <= 20
    want = np.lexsort((np.arange(500), -(vectors @ anchor)))[:5]
    assert set(want) <= set(alive) and (scores == vectors[alive] @ anchor).all()


def test_no_rows_and_no_anchors(spark):
    df = spark.createDataFrame([(1, [1.0], 0, "", 0)], SCHEMA)
    for part in (df, df.limit(0)):
        found = ng.mine_negatives(part, F.col("vec_id") % 100 == 0)
        assert found.collect() == [] and found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_against_sql(spark, sf_dir):
    df = QUERIES["op12_hard_negatives"](spark, sf_dir)
    assert compare(df, connect(sf_dir), ORACLES["op12_hard_negatives"])[0] == "ok"
