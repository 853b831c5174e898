"""Expiry, cleanup, orphans, compaction and statistics of versioned tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import files
from millrace.operators.dedupe import row_hash
from millrace.sources.landing import FILE_BYTES, list_files
from millrace.tables.table import TableStore, VersionedTable


#: Age from which an unknown file cannot belong to a running write.
ORPHAN_AGE = dt.timedelta(days=3)


def expire_snapshots(table: VersionedTable, older_than: dt.datetime) -> int:
    """Expire the snapshots committed before a time, never the current one.

    Expiry stops at the first snapshot that is new enough, so the kept versions are always
    one unbroken run. Returns the new version, or the current one if nothing expired.
    """
    current = table.current_version()
    keep = table.snapshots().filter((F.col("committed_at") >= F.lit(older_than)) | (F.col("version") == current))
    first_kept = keep.agg(F.min("version").alias("v")).first()["v"]
    if first_kept is None or first_kept <= table.first_kept():
        return current
    snapshot = {
        "kind": "snapshot",
        "version": current + 1,
        "committed_at": table.clock().astimezone(dt.timezone.utc).isoformat(),
        "operation": "expire",
        "schema": table.schema().json(),
        "first_kept": first_kept,
        "ranges": table.head()["ranges"],
    }
    table._write_log(current + 1, [snapshot])
    return current + 1


def unseen_files(table: VersionedTable) -> DataFrame:
    """Files that no kept snapshot can see: ``path, record_count, begin_snapshot, end_snapshot``."""
    return table.data_files().filter(F.col("end_snapshot") <= table.first_kept()).drop("file_size", "low", "high")


def files_to_clean(table: VersionedTable) -> DataFrame:
    """Those of the unseen files that are still there."""
    return unseen_files(table).join(_stored_files(table).select("path"), "path", "left_semi")


def cleanup_old_files(table: VersionedTable, dry_run: bool = True) -> list[str]:
    """Paths of files that only expired snapshots used; deletes them unless ``dry_run``."""
    return _report(table, files_to_clean(table).select("path"), dry_run)


def _stored_files(table: VersionedTable) -> DataFrame:
    """Parquet files below the table, named as in its log."""
    name = F.concat_ws("/", F.slice(F.split("path", "/"), -2, 2)).alias("path")
    return list_files(table.spark, [table.data_path]).select(name, "length", "modificationTime")


def orphan_files(table: VersionedTable, min_age: dt.timedelta = ORPHAN_AGE) -> DataFrame:
    """Parquet files below the table that its log does not know: ``path, length``. Files younger
    than ``min_age`` may belong to a write that is still running and are left out."""
    old = F.col("modificationTime") <= F.lit(dt.datetime.now(dt.timezone.utc) - min_age)
    found = _stored_files(table).filter(old)
    return found.select("path", "length").join(table.data_files().select("path"), "path", "left_anti")


def delete_orphans(table: VersionedTable, dry_run: bool = True, min_age: dt.timedelta = ORPHAN_AGE) -> list[str]:
    return _report(table, orphan_files(table, min_age).select("path"), dry_run)


def _report(table: VersionedTable, paths: DataFrame, dry_run: bool) -> list[str]:
    names = []
    for row in paths.toLocalIterator():
        names.append(row["path"])
        target = f"{table.data_path}/{row['path']}"
        if not dry_run and files.exists(table.spark, target):
            files.delete(table.spark, target)
    return sorted(names)


def compact(
    table: VersionedTable, keys: Sequence[str] = (), target_bytes: int = FILE_BYTES, everything: bool = False
) -> int:
    """Rewrite the current files that are below half the target size (or ``everything``)
    into full ones.

    With ``keys`` the new files cover separate key ranges, so that later upserts meet few
    of them; a hash of the row as last part of the range lets a key that holds many rows
    spread over several files.
    """
    current = table.current_version()
    chosen = table.files_at()
    if not everything:
        chosen = chosen.filter(F.col("file_size") < target_bytes // 2)
    found = [(r["path"], r["file_size"]) for r in chosen.select("path", "file_size").toLocalIterator()]
    if len(found) < 2:
        return current
    paths = [path for path, _ in found]
    schema = table.schema()
    rows = table._read_paths(paths, schema)
    if keys:
        parts = -(-sum(size for _, size in found) // target_bytes)
        rows = rows.repartitionByRange(parts, *keys, row_hash(rows))
    else:
        # adaptive execution cuts the rows by size
        rows = rows.hint("rebalance")
    folder = table._stage(rows, "compact", keys)
    return table._commit("compact", schema, [folder], paths, None, current)


def maintain(table: VersionedTable, older_than: dt.datetime, keys: Sequence[str] = ()) -> dict[str, int]:
    """Expire, clean up and compact, in this order."""
    before = table.current_version()
    expire_snapshots(table, older_than)
    cleaned = cleanup_old_files(table, dry_run=False)
    compact(table, keys)
    return {"files_removed": len(cleaned), "versions_added": table.current_version() - before}


STATISTIC_TYPES = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def file_column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per file and column: row count, nulls, least and greatest value as text."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, STATISTIC_TYPES)]
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    for name in names:
        aggregates += [
            F.count_if(F.col(name).isNull()).alias(f"nulls_{name}"),
            F.min(name).alias(f"min_{name}"),
            F.max(name).alias(f"max_{name}"),
        ]
    per_file = df.withColumn("file_path", F.col("_metadata.file_path")).groupBy("file_path").agg(*aggregates)
    stats = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"nulls_{name}").alias("null_count"),
            F.col(f"min_{name}").cast("string").alias("min_value"),
            F.col(f"max_{name}").cast("string").alias("max_value"),
        )
        for name in names
    ]
    return per_file.select("file_path", "row_count", F.explode(F.array(*stats)).alias("s")).select(
        "file_path", "row_count", "s.*"
    )


def current_tables(store: TableStore) -> DataFrame:
    """``table_name, version, file_count, record_count, file_size`` of every table."""
    found = None
    for name in store.names():
        table = store.table(name)
        one = table.files_at().agg(
            F.lit(name).alias("table_name"),
            F.lit(table.current_version()).cast("long").alias("version"),
            F.count(F.lit(1)).alias("file_count"),
            F.coalesce(F.sum("record_count"), F.lit(0)).alias("record_count"),
            F.coalesce(F.sum("file_size"), F.lit(0)).alias("file_size"),
        )
        found = one if found is None else found.unionByName(one)
    if found is None:
        schema = "table_name string, version long, file_count long, record_count long, file_size long"
        return store.spark.createDataFrame([], schema)
    return found
