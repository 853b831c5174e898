"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns what goes on.

All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import mixing, toxicity
from millrace.llm.common import ID_ROWS, save, small, table
from millrace.llm.decontaminate import drop_contaminated
from millrace.llm.model_queries import word_tokenizer
from millrace.llm.native_queries import mix_rows
from millrace.llm.near_copies import near_copies
from millrace.llm.token_files import token_table


#: Documents that go to a Python worker at a time; the default of 10,000 long texts is tens of MB, on both sides.
ROWS_A_BATCH = "1000"


def _batches_of_texts(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_A_BATCH)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more."""
    _batches_of_texts(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Only the ids that go
    meet the documents; those without an id stay."""
    _batches_of_texts(spark)
    gone = save(near_copies(docs).where("not kept and doc_id is not null").select("doc_id"), "copies")
    return docs.join(small(gone, ID_ROWS), "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    _batches_of_texts(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by source weight, some twice, some not at all; shards are output partitions."""
    made = mixing.mix_sources(save(mix_rows(docs), "mix-rows"))
    return made.rows(docs, mixing.source_key(F.col("source")), mixing.place(F.col("doc_id"), made.seed))


def to_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mix in the token files, read back: where its ids start, how many they are, and their digest."""
    _batches_of_texts(spark)
    read = token_table(docs, word_tokenizer(), last=True)
    return read.select(F.col("key").alias("doc_id"), "file", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
