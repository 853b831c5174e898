"""What the quality operator leaves on disk."""

from millrace import files
from millrace.llm import quality


def test_tables_are_deleted_once_they_are_read(spark, monkeypatch):
    saved = []

    def save(df, label, write=quality.save):
        out = write(df, label)
        saved.append((label, {f.rsplit("/", 1)[0] for f in out.inputFiles()}))
        return out

    monkeypatch.setattr(quality, "save", save)
    texts = ["the cat sat on the mat", "a cat and a dog", "the dog sat", None, "", "qqq zzz the cat"] * 5
    docs = spark.createDataFrame([(n, "en", t) for n, t in enumerate(texts)], "doc_id long, lang string, text string")
    rows = quality.judge_quality(docs, docs.select("doc_id").where("doc_id % 2 = 0"))
    left = {label for label, folders in saved for f in folders if files.exists(spark, f)}
    assert not left & {"word-ngrams", "ngrams", "counts", "contexts", "model"}
    assert "scores" in left and rows.count() == len(texts)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
