"""License scans against SQL on hand-made texts and the given ones, and on odd inputs."""

import random
import re

import duckdb
import pytest
from oracle import compare, connect

from millrace.llm import licenses as lc
from millrace.llm.queries import ORACLES, QUERIES

NAMED = {t.label: t.text for t in lc.NOTICES}


def changed(dice, text, much):
    """Words dropped, replaced and put in between."""
    out = []
    for word in text.split():
        luck = dice.random()
        if luck < much / 3:
            continue
        out.append("other" if luck < 2 * much / 3 else word)
        if luck > 1 - much / 3:
            out += ["and", "more"][: dice.randrange(3)]
    return " ".join(out)


def noise(dice, n):
    return " ".join(f"{dice.choice(['of', 'the', 'license', 'software', 'free', 'w'])}{dice.choice(['', '', dice.randrange(50)])}" for _ in range(n))


def documents(dice):
    texts = [None, "", "...", "MIT", "mit-license MIT  License, cc by cc by", "the GNU General\nPublic License", "É mit licenseé mit license", "cc by" * 3]
    for text in NAMED.values():
        texts += [text, text.upper(), "/*" + "\n * ".join(text.split()) + "*/"]
        texts += [noise(dice, dice.randrange(80)) + " " + changed(dice, text, much) + " " + noise(dice, 30) for much in (0.02, 0.05, 0.1, 0.2, 0.4)]
    texts += [" ".join(NAMED[k] for k in ("mit", "gpl", "mit")), NAMED["bsd"] * 3, " ".join(["permission is hereby granted free of"] * 300)]
    texts += [texts[12]] * 40 + [noise(dice, 20_000) + " " + NAMED["isc"] + " " + noise(dice, 5_000)]
    return texts


def test_hand_made_texts(spark, tmp_path):
    texts = documents(random.Random(6))
    rows = [(None if n % 9 == 0 else n % 50, t, n, "x") for n, t in enumerate(texts)]
    schema = "doc_id long, text string, template int, digest string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    df = QUERIES["op13_license_scan"](spark, str(tmp_path))
    verdict, count = compare(df, con, ORACLES["op13_license_scan"])
    assert verdict == "ok" and count == len(texts)
    assert df.where("size(split(labels, ',')) > 2").count() == 0


def brute_base(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, t.label) for t in lc.PHRASES for i in range(len(words)) if words[i : i + len(t.words)] == t.words]
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({k for _, k in places}))


def test_base_columns_and_labels(spark, tmp_path):
    texts = {n: t for n, t in enumerate(documents(random.Random(7)))}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op13_license_scan"](spark, str(tmp_path)).collect()}
    for n, text in texts.items():
        r = got[n]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    by_text = {texts[n]: r for n, r in got.items()}
    for label, text in NAMED.items():
        assert label in by_text[text].labels.split(",") and by_text[text].score == 1
        assert by_text["/*" + "\n * ".join(text.split()) + "*/"].labels == by_text[text].labels
    # A notice that contains most of another one's words is not taken for it.
    assert by_text[NAMED["lgpl"]].labels == "lgpl" and by_text[NAMED["cc-by-sa"]].labels == "cc-by-sa"
    assert by_text[" ".join(["permission is hereby granted free of"] * 300)].labels == ""


def test_spans(spark):
    text = "one two " + NAMED["isc"] + " three " + NAMED["isc"].replace("any purpose", "any good purpose")
    row = lc.find_licenses(spark.createDataFrame([("k", text)], "name string, body string"), key="name", text="body").first()
    size = len(lc.words_of(NAMED["isc"]))
    assert [(m["from"], m.until, m.covered) for m in row.matches] == [(2, 2 + size, size), (3 + size, 4 + 2 * size, size)]
    assert row.name == "k" and row.n_words == 4 + 2 * size


def test_hashes_alone_decide_nothing(spark, monkeypatch):
    """With a hash that knows only the lengths of words, matches are still those of the words."""
    docs = spark.createDataFrame([(1, "abc lisense mit lixense"), (2, "mit license")], "doc_id long, text string")

    def poor(codes, size):
        import numpy as np

        return np.full(max(0, len(codes) - size + 1), size, np.int64)

    monkeypatch.setattr(lc, "gram_hashes", poor)
    found = {r.doc_id: len(r.matches) for r in lc.find_licenses(docs, lc.PHRASES).collect()}
    assert found == {1: 0, 2: 1}


def test_no_rows_and_bad_templates(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lc.find_licenses(empty).collect() == []
    with pytest.raises(ValueError):
        lc.find_licenses(empty, [lc.Template("x", "...")])


def test_against_sql(spark, sf_dir):
    df = QUERIES["op13_license_scan"](spark, sf_dir)
    assert compare(df, connect(sf_dir), ORACLES["op13_license_scan"])[0] == "ok"
