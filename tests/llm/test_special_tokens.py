"""Token files against a tokenizer that is loaded for the test alone, with texts that hold special tokens."""

import numpy as np
from tokenizers import Tokenizer

from millrace.llm import token_files as tf
from millrace.llm.model_queries import word_tokenizer

TEXTS = ["a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", " <|endoftext|>\n<|endoftext|> ", "x\x1f<|endoftext|>", "<|endoftext|", None, ""]


def fresh(plain=False):
    tokenizer = Tokenizer.from_file(word_tokenizer())
    if plain:
        tokenizer.encode_special_tokens = True
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for t in TEXTS]


def test_special_tokens_are_those_of_the_tokenizer(spark):
    assert list(tf.Encoder(word_tokenizer(), 2).encode(TEXTS)) == fresh()
    assert list(tf.Encoder(word_tokenizer(), 2, plain=True).encode(TEXTS)) == fresh(plain=True)
    assert fresh() != fresh(plain=True)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for plain in (False, True):
        got = {r.key: bytes(r.ids) for r in tf.token_table(df, word_tokenizer(), plain=plain).collect()}
        assert got == dict(enumerate(fresh(plain)))


def test_words_and_pieces_are_encoded_as_whole_texts(monkeypatch):
    """Words of all kinds of characters, met again after they were forgotten."""
    import random

    dice = random.Random(3)
    kinds = ["abcXYZ", "0189", "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~\\", "äöüßéÈñÅŒſŉĸİıŠ×÷", "Σσςжλ日本語", "\x01\x7f\x85\xa0́ ", "’“…€½²ªº"]
    words = ["".join(dice.choice(dice.choice(kinds[: dice.choice([2, 3, 4, 7])])) for _ in range(dice.randrange(1, 9))) for _ in range(6000)]
    words += ["don't", "it's,", "'re", "a'll", "x|<", "<|x|>", "å", "Å.", "ﬁ", "ǅ", "K", "Å"]
    texts = [" ".join(dice.choices(words, k=40)) for _ in range(400)]
    tokenizer = Tokenizer.from_file(word_tokenizer())
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes() for t in texts]
    for memory in (500_000, 300):
        monkeypatch.setattr(tf, "MEMO_WORDS", memory)
        monkeypatch.setattr(tf, "MEMO_PIECES", memory)
        monkeypatch.setattr(tf, "MEMO_MARKS", 20 * memory)
        encoder = tf.Encoder(word_tokenizer(), 2)
        encoder.words = words = tf._Words(tokenizer)
        got = [ids for i in range(0, len(texts), 16) for ids in encoder.encode(texts[i : i + 16])]
        assert got == want
        assert 0 < len(words) <= memory and len(words.pieces) <= memory


def test_processes_keep_no_words_after_the_last_stage_or_whole_sets(monkeypatch, tmp_path):
    import types

    import pyarrow as pa

    from millrace.llm import near_copies

    monkeypatch.setattr(tf, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0, taskAttemptId=lambda: 0)))
    docs = pa.RecordBatch.from_pydict({"key": [1, 2], "body": ["some words", "and more of some words"]})
    for last, held in ((False, 1), (True, 0)):
        made = list(tf._write(f"file:{tmp_path}", word_tokenizer(), 2, False, last)(iter([docs])))
        assert made[0].column("docs").to_pylist() == [2] and tf._tokenizer.cache_info().currsize == held
    spec = near_copies.Signature()
    assert len(list(near_copies._sets(spec)(iter([docs])))) == 1 and not near_copies._hashes
    pairs = pa.RecordBatch.from_pydict({"a": [1], "b": [2], "x": ["some words"], "y": ["some words"]})
    assert list(near_copies._confirm(spec)(iter([pairs])))[0].num_rows == 1 and not near_copies._hashes


def test_workers_of_spark_keep_no_hashes_of_words(spark):
    """In a worker, where a task's function is a copy but the module is not."""
    from millrace.llm import near_copies

    df = spark.createDataFrame([(n, n, f"word{n} and others of its own") for n in range(50)], "id long, key long, body string").coalesce(1)
    signed = df.mapInArrow(near_copies._sign(near_copies.Signature()), near_copies._SIGNED)

    def held(batches):
        import pyarrow as pa

        from millrace.llm.near_copies import _hashes

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(_hashes)]})

    signed.count()
    assert {r.n for r in spark.range(64).repartition(16).mapInArrow(held, "n long").collect()} == {0}
