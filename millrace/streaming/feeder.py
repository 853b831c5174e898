"""From landing files to processed tables: by stored cursor, or by a streaming query."""

from __future__ import annotations

import datetime as dt
import itertools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.payload import any_malformed, split_malformed
from millrace.operators.dedupe import SOURCE_FILE
from millrace.plans.model import ProcessedModel
from millrace.plans.processed import PROCESSED
from millrace.plans.refresh import processed_models, refresh_dependents, run_processed
from millrace.sources.landing import files_after_cursor, scan_files, with_source
from millrace.streaming.cursors import CursorTable
from millrace.tables.table import TableStore

#: Fixed value: files per micro-batch.
FILES_PER_BATCH = 10
BROKEN = "_broken"


@dataclass
class FeedResult:
    """What a run did, per batch: files read, landing rows seen."""

    source: str
    stream: str
    files: list[int] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    cursor: str | None = None
    refreshed: list[str] = field(default_factory=list)

    @property
    def status(self) -> str:
        return "complete" if self.files else "no_files"

    @property
    def processed(self) -> int:
        return sum(self.files)


@dataclass(frozen=True)
class Unique:
    """Rows by ``keys``, once each: repeated ones are dropped as long as the watermark is less than
    ``delay`` past the first one's event time, and rows older than the watermark are late and dropped.
    The state holds the keys of about twice the delay; it is in the checkpoint, so a restart goes on with it."""

    keys: Sequence[str]
    event_time: str
    delay: str

    def rows(self, arrived: DataFrame) -> DataFrame:
        return arrived.withWatermark(self.event_time, self.delay).dropDuplicatesWithinWatermark(list(self.keys))


def append_unique(
    spark: SparkSession, root: str, schema: T.StructType | str, unique: Unique, out: str, checkpoint: str,
    files_per_batch: int | None = FILES_PER_BATCH,
) -> StreamingQuery:
    """Start a query that appends arrived rows, once each, to Parquet files, then stops. Without a number
    of files all that have arrived are one batch."""
    arrived = read_landing_stream(spark, root, schema, files_per_batch)
    sink = unique.rows(arrived).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return sink.trigger(availableNow=True).start()


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    while chunk := list(itertools.islice(rows, size)):
        yield chunk


def feed_files(
    store: TableStore,
    landing_root: str,
    source: str,
    stream: str,
    schema: T.StructType | None = None,
    models: Sequence[ProcessedModel] = tuple(PROCESSED),
    files_per_batch: int = FILES_PER_BATCH,
    guard_version: bool = False,
    until: dt.date | None = None,
    refresh: bool = False,
    on_batch: Callable[[int], None] | None = None,
    quarantine: Callable[[DataFrame], None] | None = None,
) -> FeedResult:
    """Upsert all files behind the cursor, in natural order and in batches.

    The cursor moves after a batch has been committed to every model of the stream, so a
    failed run starts again with the batch it failed in. File names come to the driver one
    listing partition at a time. ``refresh`` updates dependent facts at the end. Malformed
    JSON fails the run, unless ``quarantine`` is there to take each batch's broken rows.
    """
    spark = store.spark
    fed = processed_models(source, stream, models)
    cursors = CursorTable(store)
    cursor = cursors.get(source, stream)
    result = FeedResult(source, stream, cursor=cursor)
    listing = files_after_cursor(spark, landing_root, cursor, until).select("path")
    paths = (row["path"] for row in listing.toLocalIterator())
    for number, batch in enumerate(_chunks(paths, files_per_batch), start=1):
        observed = Observation()
        landing = scan_files(spark, landing_root, batch, schema)
        if quarantine is not None:
            landing, broken = split_malformed(landing, sorted({p for m in fed for p in m.payloads}))
            quarantine(broken)
        for position, model in enumerate(fed):
            seen = landing.observe(observed, F.count(F.lit(1)).alias("rows")) if position == 0 else landing
            run_processed(store, model, seen, guard_version=guard_version)
        if on_batch is not None:
            on_batch(number)
        cursors.set(source, stream, batch[-1])
        result.files.append(len(batch))
        result.rows.append(observed.get["rows"])
        result.cursor = batch[-1]
    if refresh and result.files:
        result.refreshed = refresh_dependents(store, [m.name for m in fed])
    return result


def read_landing_stream(
    spark: SparkSession, landing_root: str, schema: T.StructType | str, files_per_batch: int | None = FILES_PER_BATCH
) -> DataFrame:
    """Files as they arrive, with partition columns and source path."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_source(reader.parquet(landing_root))


METRICS = "files long, rows long, broken long, status string, failed_model string"


def _note_batch(rows: DataFrame, path: str, done: bool, failed_model: str | None) -> None:
    """Write what a batch brought and how it ended."""
    broken = F.count_if(F.col(BROKEN)) if BROKEN in rows.columns else F.lit(0).cast("long")
    counted = rows.agg(F.count_distinct(SOURCE_FILE).alias("files"), F.count(F.lit(1)).alias("rows"), broken.alias("broken"))
    status = F.when(F.col("rows") == 0, "no_rows").otherwise("complete") if done else F.lit("failed")
    noted = counted.withColumns({"status": status, "failed_model": F.lit(failed_model).cast("string")})
    noted.write.mode("overwrite").parquet(path)


def read_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    """``batch, files, rows, broken, status, failed_model``, a row for each batch of a stream."""
    return spark.read.schema(f"{METRICS}, batch long").parquet(metrics)


def stream_files(
    store: TableStore,
    landing_root: str,
    source: str,
    stream: str,
    schema: T.StructType,
    checkpoint: str,
    models: Sequence[ProcessedModel] = tuple(PROCESSED),
    files_per_batch: int = FILES_PER_BATCH,
    guard_version: bool = True,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    replace_parent: bool = False,
    quarantine: str | None = None,
    unique: Unique | None = None,
    metrics: str | None = None,
) -> StreamingQuery:
    """Start a query that upserts arrived files into every model of a stream, then stops.

    Files come by arrival time, not by name, so the newest version is kept by default. Each
    commit carries the batch id: after a failure Spark repeats the batch, and tables that
    already have it skip it. A stream that feeds several models reads its files once a batch.
    With ``replace_parent`` a model of parts (order tags) holds the parts of each parent's newest
    version that has any, whatever batch it came in.

    Malformed JSON fails the query, unless ``quarantine`` names a folder: a batch's broken rows then
    lie in its part ``batch=<id>``, written before the tables are and, if the batch is repeated,
    written over. ``unique`` drops repeated and late rows by key and event time before anything else.

    ``metrics`` names a folder for one row a batch (``read_metrics``): files and rows it brought, rows set
    aside, and ``complete``, ``no_rows`` or ``failed`` with the model it failed in. It is written after the
    tables are; a batch that is run again writes its row over.
    """
    fed = processed_models(source, stream, models)
    payloads = sorted({p for m in fed for p in m.payloads})

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        if quarantine is not None:  # payloads are checked once, for both sides
            batch = batch.withColumn(BROKEN, any_malformed(payloads))
        shared = quarantine is not None or metrics is not None or len(fed) > 1
        kept = batch.persist(StorageLevel.DISK_ONLY) if shared else batch
        at, done = None, False
        try:
            rows = kept
            if quarantine is not None:
                broken = kept.filter(BROKEN).drop(BROKEN)
                broken.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
                rows = kept.filter(~F.col(BROKEN)).drop(BROKEN)
            for model in fed:
                at = model.name
                run_processed(store, model, rows, f"{checkpoint}#{batch_id}", guard_version, replace_parent and bool(model.parent))
            at = None
            if on_batch is not None:
                on_batch(rows, batch_id)
            done = True
        finally:
            if metrics is not None:
                _note_batch(kept, f"{metrics}/batch={batch_id}", done, at)
            if shared:
                kept.unpersist()

    arrived = read_landing_stream(store.spark, landing_root, schema, files_per_batch)
    return (
        (unique.rows(arrived) if unique else arrived)
        .writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
