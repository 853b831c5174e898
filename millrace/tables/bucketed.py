"""Keyed tables in hash buckets: an upsert names the buckets of its keys and rewrites those only.

Rows lie in folders ``_load=.../_bucket=.../``, written by Spark's own partitioned writer; the bucket
of a row is ``pmod(xxhash64(keys), n)``. A version is one small file with, for every bucket, the
loads that hold its rows: it grows with the number of buckets, never with that of files or rows, and
no list of files passes through the driver. Creating the next version's file is the commit.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import files
from millrace.operators.dedupe import latest_per_key, row_hash
from millrace.operators.increment import high_water_mark

#: Buckets of a new table; about one for 256 MB that it will hold keeps files large and rewrites small.
BUCKETS = 64
BUCKET, LOAD = "_bucket", "_load"
NEWEST = "_newest_version"
IN_BATCH = "_in_batch"
#: Batches left beside a table are merged once they have this many times the bytes of the rest.
BESIDE = 4
#: Buckets up to which tasks that hold rows by key write into all of them, without another shuffle.
FEW_BUCKETS = 16
PLACE, UNKEYED = "_place", "_unkeyed"


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass(frozen=True)
class Version:
    """What a version's file says. ``holders`` has for each bucket the loads with its rows, ``folders``
    for each load in how many buckets it wrote, ``batches`` the last batch of each source of batches.
    ``pending`` are batches, oldest first, that lie beside the rows they replace: load, keys and guard."""

    version: int
    operation: str
    committed_at: str
    schema: str
    bucket_by: list[str]
    holders: list[list[str]]
    folders: dict[str, int] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    pending: list[list] = field(default_factory=list)

    def unmerged(self) -> set[int]:
        """Buckets that hold a pending batch."""
        waiting = {load for load, _, _ in self.pending}
        return {n for n, held in enumerate(self.holders) if waiting & set(held)}

    def paths(self, wanted: set[int] | None = None) -> list[str]:
        """Folders of the wanted buckets (all by default): whole loads where every bucket of a load counts."""
        buckets: dict[str, list[int]] = {}
        for bucket, loads in enumerate(self.holders):
            if wanted is None or bucket in wanted:
                for load in loads:
                    buckets.setdefault(load, []).append(bucket)
        out = []
        for load, numbers in buckets.items():
            whole = len(numbers) == self.folders[load]
            out += [f"{LOAD}={load}"] if whole else [f"{LOAD}={load}/{BUCKET}={n}" for n in numbers]
        return out


def merged_rows(rows: DataFrame, pending: Sequence[Sequence]) -> DataFrame:
    """What upserts of pending batches, one after the other, leave of the rows of a table and of the batches.
    A row goes if a later batch has its key; guarded, if a later batch has a version of its key that is not
    older, or an earlier row of the table or of a batch is newer. NULL keys match nothing."""
    _, keys, guard = pending[0]
    unkeyed = functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    placed = rows.withColumn(PLACE, functools.reduce(
        lambda found, p: F.when(F.col(LOAD) == p[1][0], p[0]).otherwise(found), enumerate(pending, start=1), F.lit(0)
    ))
    # rows without a key are spread by their hash: nothing is compared among them
    placed = placed.withColumn(UNKEYED, F.when(unkeyed, row_hash(rows)))
    same = Window.partitionBy(*keys, UNKEYED)
    if guard is None:
        kept = placed.withColumn(NEWEST, F.max(PLACE).over(same)).filter(unkeyed | (F.col(PLACE) == F.col(NEWEST)))
        return kept.drop(PLACE, UNKEYED, NEWEST)
    version, before = F.col(guard), (Window.unboundedPreceding, -1)
    earlier, later = same.orderBy(PLACE).rangeBetween(*before), same.orderBy(F.desc(PLACE)).rangeBetween(*before)
    # a NULL version is older than any
    judged = placed.withColumns({
        NEWEST: F.max(guard).over(earlier),
        "_later": F.max(guard).over(later),
        "_followed": F.count(F.lit(1)).over(later) > 0,
    })
    comes = (F.col(PLACE) == 0) | F.col(NEWEST).isNull() | F.coalesce(version >= F.col(NEWEST), F.lit(False))
    stays = ~F.col("_followed") | F.coalesce(version > F.col("_later"), F.col("_later").isNull() & version.isNotNull())
    return judged.filter(unkeyed | comes & stays).drop(PLACE, UNKEYED, NEWEST, "_later", "_followed")


def _batch_place(batch_id: str) -> tuple[str, int]:
    """Source and number of a batch called ``source#number``; any other name is a source of one batch."""
    source, _, number = batch_id.rpartition("#")
    return (source, int(number)) if source and number.isdigit() else (batch_id, 0)


class BucketedTable:
    """A keyed table. ``by`` are the columns whose hash is the bucket, the keys of the first write by
    default; writes by keys that do not contain them reach into all buckets."""

    def __init__(self, spark: SparkSession, root: str, name: str, buckets: int = BUCKETS, by: Sequence[str] = (), clock=_utc_now):
        self.spark, self.name, self.buckets, self.by, self.clock = spark, name, buckets, list(by), clock
        self.root = f"{root.rstrip('/')}/{name}"

    # -- versions ----------------------------------------------------------------------

    @property
    def data_path(self) -> str:
        return f"{self.root}/rows"

    def _version_path(self, version: int) -> str:
        return f"{self.root}/_versions/{version:012d}.json"

    def current_version(self) -> int:
        """Newest committed version, 0 before the first."""
        names = files.child_names(self.spark, f"{self.root}/_versions")
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)

    def exists(self) -> bool:
        return self.current_version() > 0

    def head(self, version: int | None = None) -> Version:
        version = self.current_version() if version is None else version
        if not version or not files.exists(self.spark, self._version_path(version)):
            raise ValueError(f"table {self.name} has no version {version}")
        return Version(**json.loads(files.first_line(self.spark, self._version_path(version))))

    def has_batch(self, batch_id: str) -> bool:
        """Whether a batch, or a later one of its source, is in the table."""
        source, number = _batch_place(batch_id)
        return self.exists() and self.head().batches.get(source, -1) >= number

    def _commit(self, before: Version | None, operation: str, schema: T.StructType, changes: dict[int, list[str]], batch_id: str | None, pending: Sequence[Sequence] | None = None) -> int:
        """The next version: buckets in ``changes`` are held by new loads, the others as before."""
        holders = [changes.get(n, loads) for n, loads in enumerate(before.holders if before else [[]] * self.buckets)]
        loads = sorted({load for held in holders for load in held})
        folders = {load: before.folders[load] for load in loads if before and load in before.folders}
        for load in set(loads) - set(folders):
            folders[load] = len(self._buckets_of(load))
        waiting = pending if pending is not None else before.pending if before else []
        batches = dict(before.batches) if before else {}
        if batch_id is not None:
            source, number = _batch_place(batch_id)
            batches[source] = number
        row = Version(
            (before.version if before else 0) + 1, operation, self.clock().astimezone(dt.timezone.utc).isoformat(), schema.json(),
            before.bucket_by if before else self.by, holders, folders, batches, [list(p) for p in waiting if p[0] in folders],
        )
        files.create_text(self.spark, self._version_path(row.version), [json.dumps(asdict(row))])
        return row.version

    def forget(self, before: int) -> None:
        """Drop versions older than ``before`` (never the current one) and the loads only they use."""
        current = self.current_version()
        kept = range(min(before, current), current + 1)
        used = {load for v in kept if files.exists(self.spark, self._version_path(v)) for load in self.head(v).folders}
        for version in range(1, kept.start):
            files.delete(self.spark, self._version_path(version))
        for name in files.child_names(self.spark, self.data_path):
            if name.partition("=")[2] not in used:
                files.delete(self.spark, f"{self.data_path}/{name}")

    # -- reading -----------------------------------------------------------------------

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.head(version).schema))

    def _rows(self, paths: Sequence[str], schema: T.StructType, pending: Sequence[Sequence] = ()) -> DataFrame:
        """Rows below some folders, with their bucket; those that pending batches replace are left out."""
        whole = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], whole).drop(LOAD)
        found = self.spark.read.schema(whole).option("basePath", self.data_path).parquet(*[f"{self.data_path}/{p}" for p in paths])
        read = {p.split("/")[0].partition("=")[2] for p in paths}
        if any(load in read for load, _, _ in pending):
            found = merged_rows(found, pending)
        return found.select(*[f"`{n}`" for n in schema.names], BUCKET)

    def read(self, version: int | None = None) -> DataFrame:
        """Rows as of a version."""
        head = self.head(version)
        return self._rows(head.paths(), T.StructType.fromJson(json.loads(head.schema)), head.pending).drop(BUCKET)

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The rows with some keys, NULL being one like others; only their buckets are read if ``keys``
        holds the columns that the table is laid out by."""
        head = self.head()
        schema, wanted = T.StructType.fromJson(json.loads(head.schema)), self._named(keys, head)
        rows = self._rows(head.paths(wanted), schema, head.pending).drop(BUCKET)
        same = [rows[c].eqNullSafe(keys[c]) for c in keys.columns]
        return rows.join(keys, functools.reduce(lambda a, b: a & b, same), "left_semi")

    def changed_rows(self, since: int, until: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Rows of the buckets that changed between two versions: as they were, and as they are. Rows
        in loads that both versions hold are in neither, unless a pending batch may replace them."""
        old, new = self.head(since), self.head(until)
        schema = T.StructType.fromJson(json.loads(new.schema))
        sides, whole = [], old.unmerged() | new.unmerged()
        for one, other in ((old, new), (new, old)):
            holders = [
                [] if held == kept else held if n in whole else [load for load in held if load not in kept]
                for n, (held, kept) in enumerate(zip(one.holders, other.holders))
            ]
            sides.append(self._rows(replace(one, holders=holders).paths(), schema, one.pending).drop(BUCKET))
        return sides[0], sides[1]

    def high_water_mark(self, column: str) -> str | None:
        """Largest value of a column as text; reads that column only."""
        return high_water_mark(self.read(), column)

    # -- writing -----------------------------------------------------------------------

    def bucket(self, by: Sequence[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")

    def _named(self, keys: DataFrame, head: Version) -> set[int]:
        """Buckets of some keys; at most as many numbers as there are buckets reach the driver."""
        if not set(head.bucket_by) <= set(keys.columns):
            return set(range(len(head.holders)))
        number = self.bucket(head.bucket_by, len(head.holders))
        return {r[0] for r in keys.select(number.alias(BUCKET)).distinct().collect()}

    def _stage(self, df: DataFrame, by: Sequence[str], buckets: int, label: str, grouped: bool = False) -> str:
        """Write rows into their buckets below a new load; a large bucket is split, small ones share tasks.
        Rows ``grouped`` by a shuffle by key are not shuffled again for a few buckets."""
        load = f"{label}-{uuid.uuid4().hex}"
        rows = df.drop(BUCKET).withColumn(BUCKET, self.bucket(by, buckets))
        rows = rows if grouped and buckets <= FEW_BUCKETS else rows.hint("rebalance", BUCKET)
        rows.write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{self.data_path}/{LOAD}={load}")
        return load

    def _buckets_of(self, load: str) -> set[int]:
        names = files.child_names(self.spark, f"{self.data_path}/{LOAD}={load}")
        return {int(n.partition("=")[2]) for n in names if n.startswith(f"{BUCKET}=")}

    def _nullable(self, schema: T.StructType) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])

    def _merged_schema(self, head: Version, batch: T.StructType) -> T.StructType:
        """The table's columns, then those that are new in the batch."""
        current = T.StructType.fromJson(json.loads(head.schema))
        known = {f.name: f.dataType for f in current.fields}
        for f in batch.fields:
            if known.get(f.name, f.dataType) != f.dataType:
                raise TypeError(
                    f"column {f.name} of {self.name} is {known[f.name].simpleString()}, the batch has {f.dataType.simpleString()}"
                )
        return T.StructType([*current.fields, *[f for f in self._nullable(batch).fields if f.name not in known]])

    def overwrite(
        self, df: DataFrame, keys: Sequence[str] = (), batch_id: str | None = None, operation: str = "overwrite", ranges: Sequence[str] = (),
        grouped: bool = False,
    ) -> int:
        """Replace all rows; earlier versions stay readable. ``ranges`` is not needed here; ``grouped``
        tells that the rows come out of a shuffle by key."""
        before = self.head() if self.exists() else None
        if before is None:
            self.by = self.by or list(keys)
            if not self.by:
                raise ValueError(f"the first write of {self.name} has to name keys")
        by, buckets = (before.bucket_by, len(before.holders)) if before else (self.by, self.buckets)
        load = self._stage(df, by, buckets, "full", grouped)
        held = self._buckets_of(load)
        changes = {n: [load] if n in held else [] for n in range(buckets)}
        return self._commit(before, operation, self._nullable(df.schema), changes, batch_id)

    def append(self, df: DataFrame, batch_id: str | None = None) -> int:
        head = self.head()
        load = self._stage(df, head.bucket_by, len(head.holders), "append")
        into = self._buckets_of(load)
        if mixed := into & head.unmerged():  # what is appended now is not replaced by batches from before
            rows = self._rows(head.paths(mixed), self.schema(), head.pending)
            merged = self._stage(rows, head.bucket_by, len(head.holders), "merged")
            held = self._held(mixed, (self._buckets_of(merged), merged))
        changes = {n: [*(held[n] if n in mixed else head.holders[n]), load] for n in into}
        return self._commit(head, "append", self._merged_schema(head, df.schema), changes, batch_id)

    def upsert(
        self, batch: DataFrame, keys: Sequence[str], batch_id: str | None = None, guard_version: str | None = None,
        also_delete: DataFrame | None = None, ranges: Sequence[str] = (), grouped: bool = False,
    ) -> int:
        """Delete+insert: rows whose key is in the batch go, all rows of the batch come in.

        ``guard_version`` names a column by which an older row may not replace a newer one: of a
        key in the batch only table rows that are not newer than the batch's newest go, and only
        batch rows come in that the table has nothing newer than. Rows of other keys, duplicates
        in the batch and NULL keys, which match nothing, are not touched by that. ``also_delete``
        holds further keys (any columns) whose rows go. A batch that was committed before, or
        precedes one of the same source, is skipped.

        A batch that holds the columns of the layout in its keys is written into its buckets beside the
        rows it replaces, which every read leaves out. Once such batches have ``BESIDE`` times the bytes
        of the rest, they and the rest are rewritten as one, so all rewriting of many batches is in
        proportion to what they bring. Other batches, and those with
        ``also_delete``, rewrite their buckets at once. Both sides of their join are plain scans of
        files, so adaptive execution may split a hot key.
        """
        if not self.exists():
            return self.overwrite(batch, keys, batch_id, "create", grouped=grouped)
        if batch_id is not None and self.has_batch(batch_id):
            return self.current_version()
        head, keys = self.head(), list(keys)
        schema = self._merged_schema(head, batch.schema)
        staged = self._stage(batch, head.bucket_by, len(head.holders), "batch", grouped)
        touched = new = self._buckets_of(staged)
        like = all([k, g] == [keys, guard_version] for _, k, g in head.pending)
        if also_delete is None and like and set(head.bucket_by) <= set(keys) and head.paths(touched):
            return self._upsert_beside(head, schema, staged, keys, guard_version, batch_id)
        rows = self._rows([f"{LOAD}={staged}"], self._nullable(batch.schema)).drop(BUCKET)
        if not set(head.bucket_by) <= set(keys):
            touched = set(range(len(head.holders)))
        if also_delete is not None:
            further = self._scratch(also_delete.distinct())
            touched = touched | self._named(further, head)
        target = self._rows(head.paths(touched), schema, head.pending).drop(BUCKET)
        if also_delete is not None:
            target = target.join(further, further.columns, "left_anti")
        if not head.paths(touched):
            changes = {n: [staged] for n in new}
        elif guard_version is None:
            kept = self._stage(target.join(rows.select(*keys), keys, "left_anti"), head.bucket_by, len(head.holders), "kept")
            changes = self._held(touched, (new, staged), (self._buckets_of(kept), kept))
        else:
            merged = self._stage(self._guarded(target, rows, keys, guard_version), head.bucket_by, len(head.holders), "merged")
            changes = self._held(touched, (self._buckets_of(merged), merged))
        return self._finish(head, "upsert", schema, changes, batch_id, staged)

    def _upsert_beside(self, head: Version, schema: T.StructType, staged: str, keys: list[str], guard: str | None, batch_id: str | None) -> int:
        """Leave a written batch beside the rows of its buckets, or merge all batches so left with the rest."""
        pending = [*head.pending, [staged, keys, guard]]
        changes = {n: [*head.holders[n], staged] for n in self._buckets_of(staged)}
        beside = {load for load, _, _ in pending}
        if self._bytes(beside) > BESIDE * self._bytes({load for held in head.holders for load in held} - beside):
            both = replace(
                head, holders=[changes.get(n, held) for n, held in enumerate(head.holders)],
                folders={**head.folders, staged: len(changes)}, pending=pending,
            )
            touched = both.unmerged()
            rows = self._rows(both.paths(touched), schema, pending)
            merged = self._stage(rows, head.bucket_by, len(head.holders), "merged", grouped=True)
            changes = self._held(touched, (self._buckets_of(merged), merged))
        return self._finish(head, "upsert", schema, changes, batch_id, staged, pending)

    def _bytes(self, loads: set[str]) -> int:
        return sum(files.size(self.spark, f"{self.data_path}/{LOAD}={load}") for load in loads)

    def _guarded(self, target: DataFrame, rows: DataFrame, keys: list[str], version: str) -> DataFrame:
        in_batch = self._scratch(rows.groupBy(*keys).agg(F.max(version).alias(NEWEST))).withColumn(IN_BATCH, F.lit(True))
        in_table = self._scratch(target.join(rows.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.max(version).alias(NEWEST)))
        newest = F.col(NEWEST)
        fresh = rows.join(in_table, keys, "left").filter(newest.isNull() | F.coalesce(F.col(version) >= newest, F.lit(False)))
        # a NULL version is older than any
        newer_there = F.coalesce(F.col(version) > newest, newest.isNull() & F.col(version).isNotNull())
        kept = target.join(in_batch, keys, "left").filter(F.col(IN_BATCH).isNull() | newer_there)
        return kept.select(*target.columns).unionByName(fresh.drop(NEWEST), allowMissingColumns=True)

    def append_dedup(
        self, batch: DataFrame, keys: Sequence[str], version: str, batch_id: str | None = None, ranges: Sequence[str] = ()
    ) -> int:
        """Append a batch and keep the latest version of every key in it.

        Table rows of other keys stay as they are. Rows without a complete key are appended and
        never replaced.
        """
        keyed = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

        def latest(rows: DataFrame) -> DataFrame:
            return latest_per_key(rows.filter(keyed), keys, version).unionByName(rows.filter(~keyed))

        if not self.exists():
            return self.overwrite(latest(batch), keys, batch_id, "create")
        if batch_id is not None and self.has_batch(batch_id):
            return self.current_version()
        head, keys = self.head(), list(keys)
        schema = self._merged_schema(head, batch.schema)
        staged = self._stage(latest(batch), head.bucket_by, len(head.holders), "batch")
        touched = self._buckets_of(staged) if set(head.bucket_by) <= set(keys) else set(range(len(head.holders)))
        rows = self._rows([f"{LOAD}={staged}"], self._nullable(batch.schema)).drop(BUCKET)
        old = self._rows(head.paths(touched), schema, head.pending).drop(BUCKET)
        of_batch = old.join(rows.select(*keys), keys, "left_semi")
        merged = latest(of_batch.unionByName(rows, allowMissingColumns=True)).unionByName(old.join(rows.select(*keys), keys, "left_anti"))
        load = self._stage(merged.select(*schema.names), head.bucket_by, len(head.holders), "merged")
        changes = self._held(touched, (self._buckets_of(load), load))
        return self._finish(head, "append dedup", schema, changes, batch_id, staged)

    def write(self, df: DataFrame, mode: str, keys: Sequence[str] = (), version: str | None = None) -> int:
        """Write by destination sync mode: append, overwrite, append_dedup or merge."""
        if mode == "append":
            return self.append(df) if self.exists() else self.overwrite(df, keys, operation="create")
        if mode == "overwrite":
            return self.overwrite(df, keys)
        if mode == "append_dedup":
            if version is None:
                raise ValueError("append_dedup needs a version column")
            return self.append_dedup(df, keys, version)
        if mode == "merge":
            return self.upsert(df, keys)
        raise ValueError(f"unknown sync mode {mode!r}")

    @staticmethod
    def _held(touched: set[int], *loads: tuple[set[int], str]) -> dict[int, list[str]]:
        return {n: [load for held, load in loads if n in held] for n in touched}

    def _finish(self, head: Version, operation: str, schema: T.StructType, changes: dict[int, list[str]], batch_id: str | None, staged: str, pending: Sequence[Sequence] | None = None) -> int:
        """Commit, then drop what only the running write needed."""
        version = self._commit(head, operation, schema, changes, batch_id, pending)
        files.delete(self.spark, f"{self.root}/_scratch")
        if not any(staged in held for held in changes.values()):
            files.delete(self.spark, f"{self.data_path}/{LOAD}={staged}")
        return version

    def _scratch(self, rows: DataFrame) -> DataFrame:
        path = f"{self.root}/_scratch/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)
