"""What the last stage's processes remember of words, beside what other stages have left in memory."""

import numpy as np
from tokenizers import Tokenizer

from millrace.llm import token_files as tf
from millrace.llm.model_queries import word_tokenizer


def test_the_last_stage_remembers_and_encodes_less_at_a_time(spark, tmp_path, monkeypatch):
    made, most = [], []

    class Watched(tf.Encoder):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self)

        def encode(self, texts):
            most.append(sum(len((t or "").encode()) for t in texts))
            yield from super().encode(texts)
            most.append(0)
            assert len(self.words) <= 4 and len(self.words.pieces) <= 8

    for name, value in {"Encoder": Watched, "MEMO_WORDS": 16, "MEMO_PIECES": 32, "TEXT_BYTES": 800}.items():
        monkeypatch.setattr(tf, name, value)
    monkeypatch.setattr(tf.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda s: 0, "taskAttemptId": lambda s: 0})())
    tf._forget_words()
    texts = [" ".join(f"wörd{n}x{i} слово{i}" for i in range(6)) for n in range(40)] + [None, ""]
    batch = tf.pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "body": texts})
    (row,) = [r for out in tf._write(f"file:{tmp_path}", word_tokenizer(), 2, False, last=True)([batch]) for r in out.to_pylist()]
    assert len(made) == 1 and max(most) <= 200

    with open(f"{tmp_path}/{row['file']}", "rb") as file:
        reader = tf.FileReader(file, (tmp_path / row["file"]).stat().st_size)
        got = [np.frombuffer(reader.ids(i), "<u4").tolist() for i in range(len(texts))]
    tokenizer = Tokenizer.from_file(word_tokenizer())
    assert got == [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
