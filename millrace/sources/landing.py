"""The landing zone: append-only Parquet under ``year=/month=/day=`` folders."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import files
from millrace.functions.paths import DATED_FOLDER, natural_key
from millrace.operators.dedupe import SOURCE_FILE, SOURCE_ROW
from millrace.operators.increment import high_water_mark

PARTITION_COLUMNS = ["year", "month", "day"]

#: Fixed value: files are meant to be 128 MB.
FILE_BYTES = 134_217_728


def with_partition_columns(df: DataFrame, timestamp: str | Column) -> DataFrame:
    """Adds ``year``, ``month`` and ``day``."""
    value = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return df.withColumns({"year": F.year(value), "month": F.month(value), "day": F.dayofmonth(value)})


def append_landing(
    df: DataFrame,
    root: str,
    load_id: str,
    timestamp: str | None = None,
    max_records_per_file: int = 0,
) -> None:
    """Append rows to zero-padded dated folders, in files named after the load.

    Rows are rebalanced by day, so that a small day gives one file and a day that holds
    much of the data is split over many tasks. File names start with the load id, so
    files of a later load sort behind those of an earlier one.
    """
    if timestamp is not None:
        df = with_partition_columns(df, timestamp)
    padded = df.withColumns(
        {
            "year": F.format_string("%04d", F.col("year").cast("int")),
            "month": F.format_string("%02d", F.col("month").cast("int")),
            "day": F.format_string("%02d", F.col("day").cast("int")),
        }
    )
    writer = (
        padded.hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])
        .write.mode("append")
        .partitionBy(*PARTITION_COLUMNS)
        .option("mapreduce.output.basename", load_id)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.parquet(root)


def with_source(df: DataFrame) -> DataFrame:
    """Adds each row's file and its position in there, from a scan's metadata."""
    return df.withColumns({SOURCE_FILE: F.col("_metadata.file_path"), SOURCE_ROW: F.col("_metadata.row_index")})


def _scan(spark: SparkSession, root: str, paths: Sequence[str], schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", root)
    # without a contract the files' own schemas are merged, at the cost of reading every footer
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    df = reader.parquet(*paths)
    return with_source(df)


def scan_files(
    spark: SparkSession, root: str, paths: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """The named files, with their partition columns and the path each row came from."""
    return _scan(spark, root, paths, schema)


def scan_landing(
    spark: SparkSession,
    root: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A whole stream, or the days from ``start`` to ``end`` (both included; missing days skipped)."""
    if start is None and end is None:
        return _scan(spark, root, [root], schema)
    days = day_folders(spark, root, start, end)
    if not days:
        return _scan(spark, root, [root], schema).limit(0)
    return _scan(spark, root, days, schema)


def day_folders(
    spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None
) -> list[str]:
    """Day folders in a range, oldest first.

    Walks only years and months that overlap the range, so history before ``start`` is
    never listed. A missing folder is skipped; any other listing error raises.
    """
    low = (start.year, start.month, start.day) if start else (0, 0, 0)
    high = (end.year, end.month, end.day) if end else (9999, 12, 31)

    def numbered(path: str, label: str) -> list[tuple[int, str]]:
        pairs = []
        for name in files.child_names(spark, path):
            found = re.fullmatch(rf"{label}=(\d+)", name)
            if found:
                pairs.append((int(found.group(1)), f"{path}/{name}"))
        return sorted(pairs)

    days = []
    for year, year_path in numbered(root.rstrip("/"), "year"):
        if not low[0] <= year <= high[0]:
            continue
        for month, month_path in numbered(year_path, "month"):
            if not low[:2] <= (year, month) <= high[:2]:
                continue
            days += [p for day, p in numbered(month_path, "day") if low <= (year, month, day) <= high]
    return days


FILE_SCHEMA = "path string, length long, modificationTime timestamp"


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet files below the given folders: path, length, modification time. No file is opened."""
    if not paths:
        return spark.createDataFrame([], FILE_SCHEMA)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listing.load(list(paths)).select("path", "length", "modificationTime")


def files_after_cursor(
    spark: SparkSession, root: str, cursor: str | None, until: dt.date | None = None
) -> DataFrame:
    """Files behind the cursor in natural order; all files without a (readable) cursor.

    Only days from the cursor's own up to ``until``, if given, are listed.
    """
    found = re.search(DATED_FOLDER, cursor) if cursor else None
    if not files.exists(spark, root):
        return list_files(spark, [])
    if not found:
        folders = [root] if until is None else day_folders(spark, root, None, until)
        return list_files(spark, folders).orderBy(natural_key(F.col("path")), "path")
    start = dt.date(*(int(g) for g in found.groups()))
    listing = list_files(spark, day_folders(spark, root, start, until))
    # compared from the dated folders on, so that it does not matter how the root is spelled
    inside = F.regexp_extract("path", r"year=\d+/.*", 0)
    key, cursor_key = natural_key(inside), natural_key(F.lit(cursor[found.start() :]))
    behind = (key > cursor_key) | ((key == cursor_key) & (inside > F.lit(cursor[found.start() :])))
    return listing.filter(behind).orderBy(natural_key(F.col("path")), "path")


def extract_increment(df: DataFrame, cursor_field: str, state: str | None) -> tuple[DataFrame, str | None]:
    """(records at or after the stored cursor, cursor to store next), cursors as text.

    The boundary is included, so a record that shares the last seen value is not missed;
    the keyed upsert downstream makes reading it twice harmless. The new cursor is taken
    before the records are used, so that it does not move during a run.
    """
    fresh = df
    if state is not None:
        fresh = df.filter(F.col(cursor_field) >= F.lit(state).cast(df.schema[cursor_field].dataType))
    newest = high_water_mark(fresh, cursor_field)
    return fresh, state if newest is None else newest
