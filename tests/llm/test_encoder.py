"""How often the encoder calls the tokenizer, and the rows it takes at a time."""

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from millrace.llm import token_files as tf
from millrace.llm.model_queries import word_tokenizer


class Counted:
    def __init__(self, real):
        self.real, self.calls = real, 0

    def encode(self, *args, **kwargs):
        self.calls += 1
        return self.real.encode(*args, **kwargs)

    def tokenize(self, text):
        self.calls += 1
        return self.real.tokenize(text)


def test_a_word_of_many_texts_is_encoded_once(monkeypatch):
    tokenizer = Tokenizer.from_file(word_tokenizer())
    encoder = tf.Encoder(word_tokenizer(), 2)
    encoder.words = words = tf._Words(tokenizer)
    words.tokenizer = Counted(tokenizer)
    words.pieces.tokenize = (pieces := Counted(tokenizer.model)).tokenize
    texts = ["\x0bжук  it's\x0cübrig, x<|endoftext|>\r\n", None, "", " \t", "übrig7 it's жук жук"] * 3
    want = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for t in texts]
    assert list(encoder.encode(texts)) == want
    assert words.tokenizer.calls == 3 and pieces.calls == 3  # it's, жук and the special token; übrig, the comma and 7
    assert list(encoder.encode([])) == []


def test_rows_are_taken_by_the_bytes_of_their_texts(monkeypatch):
    monkeypatch.setattr(tf, "TEXT_BYTES", 10)
    texts = ["x" * 4, None, "x" * 6, "x", "x" * 30, "", "x" * 10, "x"]
    rows = pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "body": texts})
    parts = [part.column(0).to_pylist() for part in tf._slices(rows)]
    assert sum(parts, []) == list(range(len(texts)))
    assert parts == [[0, 1, 2], [3], [4], [5, 6], [7]]
    assert not list(tf._slices(rows.slice(0, 0)))
