"""The corpus pipeline: its stages in order, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import save, table
from millrace.llm.stages import decontaminate, drop_near_copies, drop_toxic, mix, to_token_files

#: (name, function of session, documents and the folder of the given tables), in the order they run.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("mix_sources", mix),
    ("token_output", to_token_files),
]

#: SQL cannot express the trained classifier of the first stage; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
