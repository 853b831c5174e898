"""From source records to the landing zone, by increment."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace import files
from millrace.operators.dedupe import row_hash
from millrace.operators.increment import newer_than
from millrace.sources.contracts import StreamContract
from millrace.sources.landing import append_landing, extract_increment
from millrace.streaming.cursors import EXTRACTS, CursorTable
from millrace.tables.table import TableStore


#: Helper column: what tells a record apart at the cursor's value.
SEEN = "_seen"


@dataclass
class LandResult:
    status: str
    load_id: str | None = None
    records: int = 0
    cursor: str | None = None
    fields: tuple[str, ...] = ()


def land_records(
    store: TableStore, records: DataFrame, contract: StreamContract, root: str, dry_run: bool = False
) -> LandResult:
    """Append the records since the last run to the landing zone, in the contract's fields.

    The first run starts at the contract's initial value. Later ones start at the last value seen,
    which may have got further records since; those that were landed with that value, told apart by
    primary key, or by all fields if the key is not there, are kept beside the cursor and left out. Records get the load's id and an
    id of their own that is the same if a task is repeated; the cursor is stored after the
    files are there, so a failed run is simply run again.
    """
    if not contract.selected:
        return LandResult("skipped")
    if contract.initial_value is None:
        raise ValueError(f"{contract.source}/{contract.stream} has no initial_value")
    cursors = CursorTable(store, EXTRACTS)
    stored = cursors.get(contract.source, contract.stream)
    state = contract.initial_value if stored is None else stored
    fields = tuple(f for f in contract.fields if f in records.columns)
    if dry_run:
        return LandResult("dry_run", cursor=state, fields=fields)
    since = F.col(contract.cursor_field) >= F.lit(state).cast(records.schema[contract.cursor_field].dataType)
    fresh = records.filter(since).persist(StorageLevel.DISK_ONLY)  # the source is read once for all that follows
    try:
        return _land(store, fresh, contract, root, cursors, state, fields)
    finally:
        fresh.unpersist()


def _land(
    store: TableStore, records: DataFrame, contract: StreamContract, root: str, cursors: CursorTable, state: str, fields: tuple[str, ...]
) -> LandResult:
    names = contract.primary_key if contract.primary_key and set(contract.primary_key) <= set(records.columns) else records.columns
    identity = F.sha2(F.to_json(F.struct(*names)), 256)
    fresh, cursor = extract_increment(records, contract.cursor_field, state)
    position, kind = F.col(contract.cursor_field), fresh.schema[contract.cursor_field].dataType
    seen_at = cursors.boundary(contract.source, contract.stream)
    at_cursor = fresh.filter(position == F.lit(cursor).cast(kind)).select(identity.alias(SEEN))
    if seen_at is not None:  # only records at the last value may have been there before
        seen = store.spark.read.schema(f"{SEEN} string").parquet(seen_at)
        last = fresh.filter(position == F.lit(state).cast(kind)).withColumn(SEEN, identity)
        newer = fresh.filter(newer_than(fresh, contract.cursor_field, state))
        fresh = newer.unionByName(last.join(seen, SEEN, "left_anti").drop(SEEN))
        if cursor == state:
            at_cursor = at_cursor.unionByName(seen)
    if cursor == state and fresh.isEmpty():  # nothing newer, and nothing else at the cursor
        return LandResult("success", cursor=cursor, fields=fields)
    now = store.clock().astimezone(dt.timezone.utc)
    load_id = f"{now.timestamp():.6f}"
    observed = Observation()
    kept = fresh.transform(contract.project)
    loaded = kept.withColumns(
        {
            contract.metadata[0]: F.lit(load_id),
            contract.metadata[1]: F.lower(F.hex(row_hash(kept))),
            "year": F.lit(now.year),
            "month": F.lit(now.month),
            "day": F.lit(now.day),
        }
    ).observe(observed, F.count(F.lit(1)).alias("records"))
    append_landing(loaded, root, load_id)
    boundary = f"{store.root}/{EXTRACTS}_seen/{contract.source}/{contract.stream}/{uuid.uuid4().hex}"
    at_cursor.distinct().write.parquet(boundary)
    cursors.set(contract.source, contract.stream, cursor, boundary)
    if seen_at is not None:
        files.delete(store.spark, seen_at)
    return LandResult("success", load_id, observed.get["records"], cursor, fields)
