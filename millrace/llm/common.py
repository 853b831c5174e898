"""What the operators of this package share: written tables, checked broadcasts, ASCII lower case."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import files
from millrace.session import work_dir

#: Rows up to which a table of a few narrow columns is broadcast; beyond it Spark joins by shuffle.
BROADCAST_ROWS = 200_000
#: The same for a plain list of ids, 16 bytes each.
ID_ROWS = 2_000_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage is cut, and a lost executor
    costs the tasks that follow only."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`save` wrote, once nothing reads them any more."""
    for df in tables:
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            files.delete(df.sparkSession, folder)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes the shuffle files of every write and count as it ends; else they stay until the
    driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a written table for broadcast if it has at most so many rows; else leave the join to Spark."""
    return F.broadcast(df) if df.count() <= rows else df


def release_memory() -> None:
    """Give back what a worker process has freed: Spark keeps the process for later stages, and what its
    allocators hold counts against the executor until then."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # another C library gives memory back by itself or not at all
        pass


def ascii_lower(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)
