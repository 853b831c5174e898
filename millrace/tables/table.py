"""Keyed Parquet tables with snapshots.

A table is a folder of immutable Parquet files (``data/``) and a log (``_log/``) with one
small JSON file per version: the snapshot, the files it added and the files it removed.
Every question about files and versions is a DataFrame over that log; rows are only ever
read and written by Spark. The next log file, once it is there, is the commit.

The log holds the range of the key and version columns of each file. An upsert rewrites
only the files that hold a key of the batch: they are found by a semi-join over the key
columns of those files whose range meets that of the batch. A high-water mark comes from
the log alone.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import files
from millrace.operators.dedupe import latest_per_key
from millrace.operators.increment import as_text, high_water_mark, key_range, value_range, within
from millrace.operators.merge import key_set
from millrace.tables.bucketed import BucketedTable

LOG_SCHEMA = """
    kind string, version long, committed_at timestamp, operation string, batch_id string,
    schema string, first_kept long, path string, record_count long, file_size long,
    low map<string,string>, high map<string,string>
"""


Bounds = dict[str, tuple[str, str]]

#: Helper columns of guarded upserts.
NEWEST = "_newest_version"
IN_BATCH = "_in_batch"


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, name: str, clock=_utc_now):
        self.spark = spark
        self.name = name
        self.root = f"{root.rstrip('/')}/{name}"
        self.clock = clock

    # -- log ---------------------------------------------------------------------------

    @property
    def log_path(self) -> str:
        return f"{self.root}/_log"

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    @property
    def scratch(self) -> str:
        """Folder for what only the running write needs (one writer per table)."""
        return f"{self.root}/_scratch"

    def current_version(self) -> int:
        """Newest committed version, 0 before the first."""
        names = files.child_names(self.spark, self.log_path)
        versions = [int(n.split(".")[0]) for n in names if n.endswith(".json")]
        return max(versions, default=0)

    def exists(self) -> bool:
        return self.current_version() > 0

    def log(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).json(self.log_path)

    def head(self, version: int | None = None) -> dict[str, Any]:
        """The snapshot entry of a version (the current one by default), first in its log file."""
        version = self.current_version() if version is None else version
        path = f"{self.log_path}/{version:012d}.json"
        if not version or not files.exists(self.spark, path):
            raise ValueError(f"table {self.name} has no version {version}")
        return json.loads(files.first_line(self.spark, path))

    def first_kept(self) -> int:
        """Oldest version that is not expired."""
        return self.head()["first_kept"] if self.exists() else 1

    def snapshots(self) -> DataFrame:
        """``version, committed_at, operation, batch_id, expired``, one row per snapshot."""
        expired = (F.col("version") < self.first_kept()).alias("expired")
        snapshots = self.log().filter("kind = 'snapshot'")
        return snapshots.select("version", "committed_at", "operation", "batch_id", expired)

    def data_files(self) -> DataFrame:
        """``path, record_count, file_size, low, high, begin_snapshot, end_snapshot``, where a
        NULL end is current and ``low`` and ``high`` map column names to values as text."""
        return (
            self.log()
            .filter("kind IN ('add', 'remove')")
            .groupBy("path")
            .agg(
                F.max("record_count").alias("record_count"),
                F.max("file_size").alias("file_size"),
                F.first("low", ignorenulls=True).alias("low"),
                F.first("high", ignorenulls=True).alias("high"),
                F.min(F.when(F.col("kind") == "add", F.col("version"))).alias("begin_snapshot"),
                F.max(F.when(F.col("kind") == "remove", F.col("version"))).alias("end_snapshot"),
            )
        )

    def files_at(self, version: int | None = None) -> DataFrame:
        """Data files valid at a version (the current one by default)."""
        return self.data_files().filter(self._valid_at(version))

    @staticmethod
    def _valid_at(version: int | None) -> Column:
        if version is None:
            return F.col("end_snapshot").isNull()
        ended = F.coalesce(F.col("end_snapshot") <= version, F.lit(False))
        return (F.col("begin_snapshot") <= version) & ~ended

    def has_batch(self, batch_id: str) -> bool:
        return bool(self.log().filter((F.col("kind") == "snapshot") & (F.col("batch_id") == batch_id)).take(1))

    # -- reading -----------------------------------------------------------------------

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.head(version)["schema"]))

    def _read_paths(self, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.data_path}/{p}" for p in paths])

    def read(self, version: int | None = None) -> DataFrame:
        """Rows as of a version. Only file names pass through the driver."""
        schema = self.schema(version)
        if version is not None and version < self.first_kept():
            raise ValueError(f"version {version} of {self.name} is expired")
        return self._read_paths(self._paths(version), schema)

    def _paths(self, version: int | None = None, bounds: Bounds | None = None) -> list[str]:
        """What to read for a version: folders of loads that are wanted as a whole, else files.

        With ``bounds`` only files that may hold values within them are wanted.
        """
        wanted = self._valid_at(version)
        for column, (low, high) in (bounds or {}).items():
            kind = self.schema(version)[column].dataType
            above = F.col("low")[column].cast(kind) > F.lit(high).cast(kind)
            below = F.col("high")[column].cast(kind) < F.lit(low).cast(kind)
            wanted = wanted & ~F.coalesce(above | below, F.lit(False))  # an unknown range is read
        loads: dict[str, list[str]] = {}
        partly: set[str] = set()
        for row in self.data_files().select("path", wanted.alias("wanted")).toLocalIterator():
            load = row["path"].split("/")[0]
            if row["wanted"]:
                loads.setdefault(load, []).append(row["path"])
            else:
                partly.add(load)
        return [p for load, names in loads.items() for p in (names if load in partly else [load])]

    def high_water_mark(self, column: str) -> str | None:
        """Largest value of a column as text, from the log where it knows the files' ranges."""
        if column not in self.head()["ranges"]:
            return high_water_mark(self.read(), column)
        known = F.col("high")[column]
        largest = as_text(F.max(known.cast(self.schema()[column].dataType)), self.schema()[column].dataType)
        filled = self.files_at().filter("record_count > 0")
        row = filled.agg(largest.alias("mark"), F.count_if(known.isNull()).alias("unknown")).first()
        return high_water_mark(self.read(), column) if row["unknown"] else row["mark"]

    # -- writing -----------------------------------------------------------------------

    def _stage(self, df: DataFrame, label: str, sort: Sequence[str] = ()) -> str:
        """Write rows to a new folder below ``data/`` and return its name."""
        folder = f"{label}-{uuid.uuid4().hex}"
        rows = df.sortWithinPartitions(*sort) if sort else df
        rows.write.mode("errorifexists").parquet(f"{self.data_path}/{folder}")
        return folder

    def _written(self, folders: Sequence[str], schema: T.StructType, ranges: Sequence[str]) -> list[dict[str, Any]]:
        """The files of staged folders with row counts, sizes and the ranges of some columns."""
        staged = self._read_paths(folders, schema)
        by_file = staged.groupBy(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
        counted = by_file.agg(F.count(F.lit(1)).alias("record_count"), *value_range(staged, ranges))
        found = {r["_file"]: r for r in counted.withColumn("_file", self._inner_path("file_path")).toLocalIterator()}
        # a task without rows may leave a file that holds the schema only
        names = [f"{f}/{n}" for f in folders for n in files.child_names(self.spark, f"{self.data_path}/{f}")]
        entries = []
        for name in names:
            if not name.endswith(".parquet"):
                continue
            entry: dict[str, Any] = {"path": name, "record_count": 0, "file_size": 0}
            if name in found:
                row = found[name]
                entry.update(record_count=row["record_count"], file_size=row["file_size"])
                for side in ("low", "high"):
                    values = {c: row[f"{side}_{c}"] for c in ranges}
                    entry[side] = {c: v for c, v in values.items() if v is not None}
            entries.append(entry)
        return entries

    @staticmethod
    def _inner_path(path: str) -> Column:
        """Path of a file below ``data/``, from its whole path; made once a file, since it costs more than reading a row's key."""
        return F.concat_ws("/", F.slice(F.split(F.col(path), "/"), -2, 2)).alias("_file")

    def _commit(
        self,
        operation: str,
        schema: T.StructType,
        added: Sequence[str],
        removed: Sequence[str] = (),
        batch_id: str | None = None,
        expected: int | None = None,
        ranges: Sequence[str] = (),
    ) -> int:
        """Log the next version; ``ranges`` are kept for the columns named now or before."""
        before = self.head() if self.exists() else {"first_kept": 1, "ranges": []}
        version = (self.current_version() if expected is None else expected) + 1
        ranges = [c for c in dict.fromkeys([*before["ranges"], *ranges]) if c in schema.names]
        entries: list[dict[str, Any]] = [
            {
                "kind": "snapshot",
                "version": version,
                "committed_at": self.clock().astimezone(dt.timezone.utc).isoformat(),
                "operation": operation,
                "batch_id": batch_id,
                "schema": schema.json(),
                "first_kept": before["first_kept"],
                "ranges": ranges,
            }
        ]
        entries += [{"kind": "add", "version": version, **f} for f in self._written(added, schema, ranges)]
        entries += [{"kind": "remove", "version": version, "path": p} for p in removed]
        self._write_log(version, entries)
        return version

    def _write_log(self, version: int, entries: Sequence[dict[str, Any]]) -> None:
        files.create_text(self.spark, f"{self.log_path}/{version:012d}.json", [json.dumps(e) for e in entries])

    def _nullable(self, schema: T.StructType) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])

    def _merged_schema(self, batch: T.StructType) -> T.StructType:
        """The table's columns, then those that are new in the batch."""
        if not self.exists():
            return self._nullable(batch)
        current = self.schema()
        known = {f.name: f.dataType for f in current.fields}
        for field in self._nullable(batch).fields:
            if field.name in known and known[field.name] != field.dataType:
                raise TypeError(
                    f"column {field.name} of {self.name} is {known[field.name].simpleString()}, "
                    f"the batch has {field.dataType.simpleString()}"
                )
        return T.StructType([*current.fields, *[f for f in self._nullable(batch).fields if f.name not in known]])

    def overwrite(
        self,
        df: DataFrame,
        keys: Sequence[str] = (),
        batch_id: str | None = None,
        operation: str = "overwrite",
        ranges: Sequence[str] = (),
        grouped: bool = False,
    ) -> int:
        """Replace all rows; earlier versions stay readable. ``grouped`` is not needed here."""
        expected = self.current_version()
        folder = self._stage(df, "full", keys)
        removed = [r["path"] for r in self.files_at().select("path").toLocalIterator()] if expected else []
        schema = self._nullable(df.schema)
        return self._commit(operation, schema, [folder], removed, batch_id, expected, [*keys, *ranges])

    def append(self, df: DataFrame, batch_id: str | None = None) -> int:
        expected = self.current_version()
        schema = self._merged_schema(df.schema)
        folder = self._stage(df, "append")
        return self._commit("append", schema, [folder], (), batch_id, expected)

    def upsert(
        self,
        batch: DataFrame,
        keys: Sequence[str],
        batch_id: str | None = None,
        guard_version: str | None = None,
        also_delete: DataFrame | None = None,
        ranges: Sequence[str] = (),
        grouped: bool = False,
    ) -> int:
        """Delete+insert: rows whose key is in the batch go, all rows of the batch come in.

        ``guard_version`` names a column by which an older row may not replace a newer one: of a
        key in the batch only table rows that are not newer than the batch's newest go, and only
        batch rows come in that the table has nothing newer than. Rows of other keys, duplicates
        in the batch and NULL keys, which match nothing, are not touched by that. ``also_delete``
        holds further keys (any subset of columns) whose rows go. A batch id that was committed
        before is skipped. ``ranges`` names columns, beside the keys, whose range per file the
        log should hold; ``grouped`` is not needed here.
        """
        expected = self.current_version()
        if batch_id is not None and self.has_batch(batch_id):
            return expected
        if not expected:
            return self.overwrite(batch, keys, batch_id, "create", ranges)
        schema = self._merged_schema(batch.schema)
        # the batch is computed once; everything after reads the written files
        staged = self._stage(batch, "batch", keys)
        rows = self._read_paths([staged], self._nullable(batch.schema))
        batch_keys = self._key_file(rows, keys, guard_version)
        touched = set(self._files_with(batch_keys.select(*keys)))
        if also_delete is not None:
            further = self._key_file(also_delete, also_delete.columns)
            touched |= set(self._files_with(further))
        kept = self._read_paths(sorted(touched), schema)
        if also_delete is not None:
            kept = kept.join(further, further.columns, "left_anti")
        if not touched:
            added = [staged]
        elif guard_version:
            newer = kept.join(batch_keys, list(keys), "left_semi").groupBy(*keys).agg(F.max(guard_version).alias(NEWEST))
            newer = self._scratch_file(newer, "newest")
            fresh = rows.join(newer, list(keys), "left")
            fresh = fresh.filter(F.col(NEWEST).isNull() | F.coalesce(F.col(guard_version) >= F.col(NEWEST), F.lit(False)))
            # a NULL version is older than any
            newer_there = F.coalesce(F.col(guard_version) > F.col(NEWEST), F.col(NEWEST).isNull() & F.col(guard_version).isNotNull())
            stays = F.col(IN_BATCH).isNull() | newer_there
            kept = kept.join(batch_keys.withColumn(IN_BATCH, F.lit(True)), list(keys), "left").filter(stays)
            added = [self._stage(kept.select(*schema.names).unionByName(fresh.drop(NEWEST), allowMissingColumns=True), "merged", keys)]
        else:
            kept = kept.join(batch_keys, list(keys), "left_anti")
            added = [staged, self._stage(kept.select(*schema.names), "kept", keys)]
        return self._finish("upsert", schema, staged, added, sorted(touched), batch_id, expected, [*keys, *ranges])

    def append_dedup(
        self, batch: DataFrame, keys: Sequence[str], version: str, batch_id: str | None = None, ranges: Sequence[str] = ()
    ) -> int:
        """Append a batch and keep the latest version of every key in it.

        Table rows of other keys stay as they are, wherever they lie. Rows without a complete key
        are appended and never replaced.
        """
        expected = self.current_version()
        if batch_id is not None and self.has_batch(batch_id):
            return expected
        keyed = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

        def latest(rows: DataFrame) -> DataFrame:
            return latest_per_key(rows.filter(keyed), keys, version).unionByName(rows.filter(~keyed))

        if not expected:
            return self.overwrite(latest(batch), keys, batch_id, "create", [version, *ranges])
        schema = self._merged_schema(batch.schema)
        staged = self._stage(latest(batch), "batch", keys)
        rows = self._read_paths([staged], self._nullable(batch.schema))
        batch_keys = self._key_file(rows, keys)
        touched = self._files_with(batch_keys)
        if not touched:
            return self._finish("append dedup", schema, staged, [staged], [], batch_id, expected, [*keys, version, *ranges])
        old = self._read_paths(sorted(touched), schema)
        of_batch = old.join(batch_keys, list(keys), "left_semi")
        others = old.join(batch_keys, list(keys), "left_anti")
        merged = latest(of_batch.unionByName(rows, allowMissingColumns=True)).unionByName(others)
        added = [self._stage(merged.select(*schema.names), "merged", keys)]
        return self._finish("append dedup", schema, staged, added, sorted(touched), batch_id, expected, [*keys, version, *ranges])

    def _finish(
        self, operation: str, schema: T.StructType, staged: str, added: Sequence[str], touched: Sequence[str],
        batch_id: str | None, expected: int, ranges: Sequence[str],
    ) -> int:
        """Commit, then drop what only the running write needed."""
        version = self._commit(operation, schema, added, touched, batch_id, expected, ranges)
        for path in [self.scratch] + [f"{self.data_path}/{staged}"] * (staged not in added):
            files.delete(self.spark, path)
        return version

    def _key_file(self, rows: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
        """Distinct keys, with the newest of a version, written out: joins read them as a plain
        scan, under which adaptive execution can split a table key that holds many rows."""
        found = rows.groupBy(*keys).agg(F.max(version).alias(NEWEST)) if version else key_set(rows, keys)
        return self._scratch_file(found, "keys")

    def _scratch_file(self, rows: DataFrame, label: str) -> DataFrame:
        path = f"{self.scratch}/{label}-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _files_with(self, key_rows: DataFrame) -> list[str]:
        """Current files that hold one of the keys."""
        keys = key_rows.columns
        bounds = key_range(key_rows, keys)
        paths = self._paths(bounds=bounds) if bounds else []  # NULL keys match nothing
        if not paths:
            return []
        target = within(self._read_paths(paths, self.schema()), bounds)
        hit = target.select(*keys, F.col("_metadata.file_path").alias("_path")).join(key_rows, keys, "left_semi")
        return [r["_file"] for r in hit.select("_path").distinct().select(self._inner_path("_path")).toLocalIterator()]

    def write(self, df: DataFrame, mode: str, keys: Sequence[str] = (), version: str | None = None) -> int:
        """Write by destination sync mode: append, overwrite, append_dedup or merge."""
        if mode == "append":
            return self.append(df)
        if mode == "overwrite":
            return self.overwrite(df, keys)
        if mode == "append_dedup":
            if version is None:
                raise ValueError("append_dedup needs a version column")
            return self.append_dedup(df, keys, version)
        if mode == "merge":
            return self.upsert(df, keys)
        raise ValueError(f"unknown sync mode {mode!r}")


class TableStore:
    """All tables below one folder: in so many hash buckets of their keys, or in files by write."""

    def __init__(self, spark: SparkSession, root: str, clock=_utc_now, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.clock = clock
        self.buckets = buckets

    def table(self, name: str, by: Sequence[str] = ()) -> VersionedTable | BucketedTable:
        """A table; ``by`` are the columns that a new bucketed one is laid out by, its keys by default."""
        if self.buckets:
            return BucketedTable(self.spark, self.root, name, self.buckets, by, self.clock)
        return VersionedTable(self.spark, self.root, name, self.clock)

    def create(self, name: str, schema: T.StructType | str) -> None:
        """An empty table, if there is none of that name."""
        if not self.exists(name):
            self.table(name).overwrite(self.spark.createDataFrame([], schema), operation="create")

    def names(self) -> list[str]:
        return [n for n in files.child_names(self.spark, self.root) if self.table(n).exists()]

    def exists(self, name: str) -> bool:
        return self.table(name).exists()

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.table(name).read(version)

    def drop(self, name: str) -> None:
        """Remove a table with all its versions; a missing one is no error."""
        table = self.table(name)
        if files.exists(self.spark, table.root):
            files.delete(self.spark, table.root)
