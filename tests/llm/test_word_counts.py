"""The word model's counts against plain Python, and what the quality operator keeps on disk for them."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import quality
from millrace.llm import word_counts as wc
from millrace.llm.toxicity import held_out


def brute(texts, spelled, order=3):
    """The logarithm of an n-gram's last word by interpolated modified Kneser-Ney."""
    counts = {k: Counter() for k in range(1, order + 1)}
    for text in texts:
        words = [wc.BEGIN, *wc.words_of(text)]
        for end in range(2, len(words) + 1):
            gram = tuple(words[max(0, end - order) : end])
            counts[len(gram)][gram] += 1
    for k in range(order - 1, 0, -1):
        for gram in counts[k + 1]:
            if gram[1:] != (wc.BEGIN,) and gram[1] != wc.BEGIN:
                counts[k][gram[1:]] += 1
    discounts, after = {}, defaultdict(Counter)
    for k, grams in counts.items():
        discounts[k] = quality._discounts(Counter(n for n in grams.values() if n <= 4))
        for gram, n in grams.items():
            after[gram[:-1]][gram[-1]] = n

    def log(gram):
        if not gram:
            raise ValueError
        below = log(gram[1:]) if len(gram) > 1 else spelled[gram[0]]
        if not (follow := after.get(gram[:-1])):
            return below
        take, total = [discounts[len(gram)][min(n, 3) - 1] for n in follow.values()], sum(follow.values())
        n, back = follow.get(gram[-1], 0), sum(take) / total
        if not n:
            return math.log(back) + below
        return math.log((n - discounts[len(gram)][min(n, 3) - 1]) / total + back * math.exp(below))

    return log


def test_perplexities_against_plain_python_and_no_row_for_each_n_gram(spark, monkeypatch):
    for name, value in (("PART_BYTES", 2000), ("WORDS_BYTES", 3000), ("TURN_BYTES", 4000), ("COUNT_TURNS", 2), ("SCORE_TURNS", 3), ("SPELLED", 40)):
        monkeypatch.setattr(quality, name, value, raising=False)
    sizes = {}

    def save(df, label, write=quality.save):
        out = write(df, label)
        sizes[label] = max(sizes.get(label, 0), out.count())
        return out

    monkeypatch.setattr(quality, "save", save)
    dice = random.Random(11)
    words = ["".join(dice.choice("abcdé一") for _ in range(dice.randrange(1, 5))) for _ in range(60)] + ["long" * 80, "x" * 9]
    texts = [" \n".join(dice.choice(words[: dice.randrange(1, 62)]) for _ in range(dice.randrange(1, 60))) for _ in range(150)]
    texts += [texts[0], "ab\x02cd　ef\x85gh", "zzz zz z", "new", None, "", " ", "the same " * 40]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    chosen = docs.where("doc_id % 3 > 0")
    learnt = {r.doc_id for r in chosen.where(~held_out(chosen["doc_id"])).select("doc_id").collect()}
    got = {r.doc_id: r for r in quality.judge_quality(docs, chosen.select("doc_id")).collect()}

    own = [t for i, t in enumerate(texts) if i in learnt]
    seen = sorted({w for t in own for w in wc.words_of(t)})
    table = quality.train(spark.createDataFrame([(w,) for w in seen], "body string")).toPandas()
    scorer = quality.Scorer(table.gram.tolist(), table.p.to_numpy(), table.back.to_numpy(), 4)
    log = brute(own, {w: scorer.word(w) for t in texts for w in wc.words_of(t)})
    pairs = 0
    for i, text in enumerate(texts):
        marked = [wc.BEGIN, *wc.words_of(text)]
        total = sum(log(tuple(marked[max(0, e - 3) : e])) for e in range(2, len(marked) + 1))
        symbols = sum(map(len, marked)) + len(marked) - 2
        pairs += len({tuple(marked[max(0, e - 3) : e]) for e in range(2, len(marked) + 1)})
        assert got[i].symbols == symbols
        assert got[i].perplexity == (pytest.approx(math.exp(-total / symbols)) if symbols else None)
    # Tables with a row for each n-gram of words, or of a document, are what did not fit the disk.
    assert max(n for label, n in sizes.items() if label in ("word-ngrams", "looked", "sums")) < pairs / 4


def test_words_are_cut_as_python_does():
    dice = random.Random(1)
    pieces = [*"abé一😀", " ", "\x02", "\x03", "\n", "\x1c", "\x85", "\xa0", " ", " ", " ", " ", " ", "　", "​", "x" * 8, "y" * 15, "z" * 300]
    texts = [None, "", " "] + ["".join(dice.choice(pieces) for _ in range(dice.randrange(60))) for _ in range(500)]
    numbers = pa.array(range(len(texts)), pa.int64())
    rows = pa.RecordBatch.from_arrays([numbers, numbers, pa.array(texts)], names=["d1", "d2", "body"])
    blocks = list(wc._blocks(iter([rows.slice(0, 7), rows.slice(7)]), True))
    wanted = [[wc.BEGIN, *wc.words_of(t)] for t in texts]
    flat = [w for words in wanted for w in words]
    keys = np.concatenate([b.words for b in blocks])
    assert np.concatenate([b.lengths for b in blocks]).tolist() == [len(w) for w in wanted]
    assert np.concatenate([b.symbols for b in blocks]).tolist() == [sum(map(len, w)) + len(w) - 2 for w in wanted]
    assert (wc.digests(pa.array(flat)) == keys).all() and len(set(keys.tolist())) == len(set(flat))
    found = [w for b in wc.different_words()(iter([rows.select(["body"])])) for w in b.column(0).to_pylist()]
    assert sorted(found) == sorted(set(flat) - {wc.BEGIN})


def test_arrays_come_back_and_keys_are_found():
    dice = np.random.default_rng(3)
    keys = np.unique(dice.integers(1, 2**64, 3000, np.uint64))
    arrays = [keys, np.zeros(0, np.uint64), np.array([0, 300, 70_000]), dice.random(5)]
    assert all(a.tolist() == b.tolist() for a, b in zip(arrays, wc.unpack(wc.pack(*arrays)), strict=True))
    asked = np.concatenate([keys[::3], dice.integers(1, 2**64, 3000, np.uint64), [np.uint64(1), np.uint64(2**64 - 1)]])
    values = np.arange(1, len(keys) + 1)
    known = dict(zip(keys.tolist(), values.tolist()))
    for n in (0, 1, 2, len(keys)):
        assert wc._found(keys[:n], asked, [values[:n]])[0].tolist() == [v if (v := known.get(a, 0)) <= n else 0 for a in asked.tolist()]
