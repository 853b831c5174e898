"""How often the quality operator looks up what ends with a symbol."""

import math
import random

import pytest

from millrace.llm import quality


def test_words_share_the_n_grams_of_their_symbols(spark, monkeypatch):
    dice = random.Random(5)
    words = sorted({"".join(dice.choice("abé") for _ in range(dice.randrange(1, 9))) for _ in range(300)})
    spec = quality.Model()
    model = quality.train(spark.createDataFrame([(" ".join(words[::2]),)], "body string"), spec)
    rows = {}

    def save(df, label, write=quality.save):
        rows[label] = (out := write(df, label)).count()
        return out

    monkeypatch.setattr(quality, "save", save)
    asked = [*words, "zz", "a一b"]
    got = {r.word: (r.log, r.symbols) for r in quality._word_logs(spark.createDataFrame([(w,) for w in asked], "word string"), model, spec).collect()}
    table = model.toPandas()
    scorer = quality.Scorer(table.gram.tolist(), table.p.to_numpy(), table.back.to_numpy(), spec.order)
    assert got.keys() == set(asked)
    assert all(n == len(w) + 1 and log == pytest.approx(scorer.word(w)) and math.isfinite(log) for w, (log, n) in got.items())
    marked = [quality.BEGIN + w + quality.END for w in asked]
    assert rows["spots"] == len({m[max(0, e - spec.order) : e] for m in marked for e in range(2, len(m) + 1)}) < sum(map(len, asked)) / 3
