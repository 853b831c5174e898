"""Feeders and streams: micro-batches, resumption, propagation to facts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from millrace.catalogue import inputs as i
from millrace.catalogue.registry import query, with_
from millrace.catalogue.scans import events_landing
from millrace.functions import partition_date
from millrace.operators import flatten_order_items, high_water_mark, newer_than
from millrace.operators.dedupe import SOURCE_FILE
from millrace.plans import enriched, processed
from millrace.plans.model import EnrichedModel
from millrace.plans.processed import EXTRACTED, LOAD
from millrace.plans.refresh import refresh_dependents, refresh_fact, run_processed
from millrace.session import work_dir
from millrace.sources.known import CONTRACTS
from millrace.sources.landing import append_landing, scan_landing
from millrace.streaming import CursorTable, Unique, append_unique, feed_files, land_records, stream_files
from millrace.streaming.feeder import FILES_PER_BATCH, read_landing_stream, read_metrics
from millrace.tables import TableStore

EVENTS = ("klaviyo", "events")
EVENT_COLUMNS = f"event_id, profile_id, metric_id, event_uuid, {EXTRACTED}"
LATEST_EVENTS = f"{with_(i.EVENTS_SQL)}\nSELECT {EVENT_COLUMNS} FROM events_latest"


def new_store(spark, label):
    return TableStore(spark, work_dir(spark, label), buckets=i.BUCKETS)


def feed_events(spark, sf_dir, store, **options):
    schema = CONTRACTS[EVENTS].landing_schema()
    return feed_files(store, events_landing(spark, sf_dir), *EVENTS, schema=schema, **options)


def stream_events(spark, sf_dir, store, checkpoint, **options):
    schema = CONTRACTS[EVENTS].landing_schema()
    return stream_files(store, events_landing(spark, sf_dir), *EVENTS, schema, checkpoint, **options)


def event_rows(store):
    return store.read(processed.EVENTS.name).select(*EVENT_COLUMNS.split(", "))


# -- cursor feeder ------------------------------------------------------------------------------


@query(
    "cursor_state",
    f"""{with_(i.EVENTS_SQL)}
SELECT 'klaviyo' AS source, 'events' AS stream, max(CAST({EXTRACTED} AS DATE)) AS cursor_date FROM events_raw""",
)
def cursor_state(spark, sf_dir):
    """The stored cursor after all files were fed."""
    store = new_store(spark, "cursor")
    feed_events(spark, sf_dir, store)
    cursors = CursorTable(store).read()
    return cursors.select("source", "stream", partition_date(F.col("cursor_path")).alias("cursor_date"))


@query("backfill_replay", LATEST_EVENTS)
def backfill_replay(spark, sf_dir):
    """Table and cursor dropped after a run, then everything fed again."""
    store = new_store(spark, "backfill")
    feed_events(spark, sf_dir, store)
    store.drop(processed.EVENTS.name)
    CursorTable(store).clear(*EVENTS)
    feed_events(spark, sf_dir, store)
    return event_rows(store)


@query(
    "batch_metrics",
    f"""{with_(i.EVENTS_SQL)}
SELECT 'complete' AS status, count(*) AS rows_read, count(DISTINCT event_id) AS rows_written FROM events_raw""",
)
def batch_metrics(spark, sf_dir):
    """Counters of one run, observed while the batches were written."""
    store = new_store(spark, "metrics")
    result = feed_events(spark, sf_dir, store)
    written = store.read(processed.EVENTS.name).agg(F.count(F.lit(1)).alias("rows_written"))
    return written.select(
        F.lit(result.status).alias("status"), F.lit(sum(result.rows)).cast("long").alias("rows_read"), "rows_written"
    )


@query(
    "meta_cursor_freshness",
    f"""{with_(i.EVENTS_SQL, i.CAMPAIGNS_SQL)}
SELECT 'events' AS stream, max(CAST({EXTRACTED} AS DATE)) AS cursor_date FROM events_raw
UNION ALL SELECT 'campaigns', max(CAST({EXTRACTED} AS DATE)) FROM campaigns_raw""",
)
def meta_cursor_freshness(spark, sf_dir):
    """Cursors of two streams, the one that moved last first."""
    store = new_store(spark, "freshness")
    root = i.landing(spark, sf_dir, "campaigns", i.campaigns)
    schema = CONTRACTS["klaviyo", "campaigns"].landing_schema()
    feed_events(spark, sf_dir, store)
    feed_files(store, root, "klaviyo", "campaigns", schema)
    cursors = CursorTable(store).freshness()
    return cursors.select("stream", partition_date(F.col("cursor_path")).alias("cursor_date"))


@query("sync_full_refresh", f"{with_(i.METRICS_SQL)}\nSELECT metric_id, metric_name, {EXTRACTED} FROM metrics_latest")
def sync_full_refresh(spark, sf_dir):
    """A full-refresh stream: the whole folder is read and overwrites the table."""
    contract = CONTRACTS["klaviyo", "metrics"]
    root = i.landing(spark, sf_dir, "metrics", i.metrics)
    rows = scan_landing(spark, root, schema=contract.landing_schema())
    table = new_store(spark, "full").table(processed.METRICS.name)
    table.write(processed.METRICS(rows), contract.destination_sync_mode, processed.METRICS.keys)
    return table.read().select("metric_id", "metric_name", EXTRACTED)


_LANDED = "id, created_at, quantity, sku, price_amount_minor, order_id, order_updated_at, retailer_name"


@query("land_stream", f"{with_(i.PAGES_SQL)}\nSELECT {_LANDED} FROM page_items WHERE order_updated_at >= 'v2'")
def land_stream(spark, sf_dir):
    """Order pages flattened, cut to the contract's fields and landed from an initial value on."""
    base = work_dir(spark, "extract")
    contract = replace(CONTRACTS["faire", "order_lines"], initial_value="v2")
    items = flatten_order_items(i.order_pages(spark, sf_dir))
    land_records(TableStore(spark, f"{base}/tables"), items, contract, f"{base}/raw")
    return scan_landing(spark, f"{base}/raw").select(*_LANDED.split(", "))


# -- streaming ----------------------------------------------------------------------------------


@query(
    "stream_file_source",
    f"{with_(i.EVENTS_SQL)}\nSELECT CAST({EXTRACTED} AS DATE) AS file_date, count(*) AS events FROM events_raw GROUP BY 1",
)
def stream_file_source(spark, sf_dir):
    """Arrived files as a stream, appended to a table."""
    base = work_dir(spark, "file-source")
    schema = CONTRACTS[EVENTS].landing_schema()
    arrived = read_landing_stream(spark, events_landing(spark, sf_dir), schema, 1000)
    rows = arrived.select("id", partition_date(F.col(SOURCE_FILE)).alias("file_date"))
    sink = rows.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("file_date").agg(F.count(F.lit(1)).alias("events"))


@query(
    "stream_micro_batch",
    f"{with_(i.EVENTS_SQL)}\nSELECT true AS within_limit, count(*) AS events FROM events_raw",
)
def stream_micro_batch(spark, sf_dir):
    """Micro-batches of at most ten files: what each held, as it was written beside the table."""
    store, counts = new_store(spark, "micro"), work_dir(spark, "batches")

    def count_files(batch, batch_id):
        by_file = batch.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows"))
        by_file.write.mode("overwrite").parquet(f"{counts}/batch={batch_id}")

    stream_events(spark, sf_dir, store, work_dir(spark, "checkpoint"), on_batch=count_files).awaitTermination()
    batches = spark.read.parquet(counts).groupBy("batch").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
    within = F.bool_and(F.col("files") <= FILES_PER_BATCH).alias("within_limit")
    return batches.agg(within, F.sum("rows").alias("events"))


@query("stream_upsert", LATEST_EVENTS)
def stream_upsert(spark, sf_dir):
    store = new_store(spark, "stream")
    stream_events(spark, sf_dir, store, work_dir(spark, "checkpoint")).awaitTermination()
    return event_rows(store)


@query(
    "stream_multi_model",
    f"""{with_(i.ERP_ORDERS_SQL)}
SELECT t.order_id, t.tag, t.{LOAD}, o.amount_total FROM order_tags t JOIN erp_latest o ON t.order_id = o.order_id""",
)
def stream_multi_model(spark, sf_dir):
    """One stream that fills two tables, orders and their tags, however files fall into batches: an
    order's newest tags replace its older ones."""
    contract = CONTRACTS["odoo", "orders"]
    root = i.landing(spark, sf_dir, "erp_orders", lambda s, d: i.erp_orders(s, d).drop("v"))
    store = new_store(spark, "multi")
    checkpoint = work_dir(spark, "checkpoint")
    schema = contract.landing_schema()
    stream_files(store, root, "odoo", "orders", schema, checkpoint, replace_parent=True).awaitTermination()
    orders = store.read(processed.ERP_ORDERS.name).select("order_id", "amount_total")
    return store.read(processed.ORDER_TAGS.name).join(orders, "order_id")


class Interrupted(RuntimeError):
    pass


@query("stream_resume", LATEST_EVENTS)
def stream_resume(spark, sf_dir):
    """A run that fails in its second batch, a second one that goes on from there, and a
    third that finds nothing to do."""
    store, checkpoint = new_store(spark, "resume"), work_dir(spark, "checkpoint")

    def fail_second(batch, batch_id):
        if batch_id == 1:
            raise Interrupted("stopped on purpose")

    try:
        stream_events(spark, sf_dir, store, checkpoint, on_batch=fail_second).awaitTermination()
    except Exception as error:  # the streaming query wraps the reason
        if "stopped on purpose" not in str(error):
            raise
    stream_events(spark, sf_dir, store, checkpoint).awaitTermination()
    before = store.table(processed.EVENTS.name).current_version()
    stream_events(spark, sf_dir, store, checkpoint).awaitTermination()
    if store.table(processed.EVENTS.name).current_version() != before:
        raise RuntimeError("a run without new files wrote a version")
    return event_rows(store)


DELIVERIES = 6


@query(
    "stream_dedupe",
    """WITH weeks AS (SELECT event_id, ts, date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) // 7 AS week FROM events)
SELECT event_id, ts FROM weeks WHERE week < 5 AND NOT (event_id % 10 = 1 AND week = 0)""",
)
def stream_dedupe(spark, sf_dir):
    """Weekly deliveries, each repeating a third of the one before, and some rows of the first week
    that only come in the fifth: repeated and late rows are dropped, although the query is started
    anew for each delivery, which is one batch however many files its tasks have written."""
    base = work_dir(spark, "unique")
    rows = i.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    first = F.lit(rows.agg(F.min(F.to_date("ts"))).first()[0])
    rows = rows.withColumn("week", F.floor(F.datediff(F.to_date("ts"), first) / 7)).filter("week < 5")
    late, again = (F.col("event_id") % 10 == 1) & (F.col("week") == 0), F.col("event_id") % 3 == 0
    unique = Unique(["event_id"], "ts", "14 days")

    def deliver(n):
        now = F.when(late, F.lit(n == 4)).otherwise((F.col("week") == n) | again & (F.col("week") == n - 1))
        rows.filter(now).drop("week").write.mode("append").parquet(f"{base}/raw")
        query = append_unique(spark, f"{base}/raw", "event_id long, ts timestamp", unique, f"{base}/out", f"{base}/checkpoint", None)
        query.awaitTermination()

    for n in range(DELIVERIES):
        deliver(n)
    return spark.read.parquet(f"{base}/out").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


def _cut_events(spark, sf_dir):
    """Events, every tenth with a payload that is cut off."""
    broken = F.when(F.col("id").cast("long") % 10 == 0, F.lit('{"uuid": ')).otherwise(F.col("attributes"))
    return i.events(spark, sf_dir).withColumn("attributes", broken)


@query(
    "stream_quarantine",
    f"""{with_(i.EVENTS_SQL)}
SELECT event_id, 'good' AS status, {EXTRACTED} FROM events_latest WHERE CAST(event_id AS BIGINT) % 10 <> 0
UNION ALL SELECT event_id, 'quarantined', {EXTRACTED} FROM events_raw WHERE CAST(event_id AS BIGINT) % 10 = 0""",
)
def stream_quarantine(spark, sf_dir):
    """Every tenth event's payload is cut off: those rows are set aside batch by batch, once each,
    although the second batch is run twice."""

    store, aside, checkpoint = new_store(spark, "quarantine"), work_dir(spark, "aside"), work_dir(spark, "checkpoint")
    root, schema = i.landing(spark, sf_dir, "events_cut", _cut_events), CONTRACTS[EVENTS].landing_schema()

    def fail_second(batch, batch_id):
        if batch_id == 1:
            raise Interrupted("stopped on purpose")

    for on_batch in (fail_second, None):
        try:
            stream_files(store, root, *EVENTS, schema, checkpoint, on_batch=on_batch, quarantine=aside).awaitTermination()
        except Exception as error:  # the streaming query wraps the reason
            if "stopped on purpose" not in str(error):
                raise
    good = event_rows(store).select("event_id", F.lit("good").alias("status"), EXTRACTED)
    broken = spark.read.schema(schema).parquet(aside)
    return good.unionByName(broken.select(F.col("id").alias("event_id"), F.lit("quarantined").alias("status"), EXTRACTED))


@query(
    "stream_metrics",
    f"""{with_(i.EVENTS_SQL)},
weeks AS (
    SELECT date_diff('day', (SELECT min(CAST({EXTRACTED} AS DATE)) FROM events_raw), CAST({EXTRACTED} AS DATE)) // 7 AS week,
        CAST({EXTRACTED} AS DATE) AS day, CAST(event_id AS BIGINT) % 10 = 0 AS cut FROM events_raw)
SELECT CAST(dense_rank() OVER (ORDER BY week) - 1 AS BIGINT) AS batch, count(DISTINCT day) AS files, count(*) AS rows,
    count_if(cut) AS broken, 'complete' AS status FROM weeks GROUP BY week""",
)
def stream_metrics(spark, sf_dir):
    """Weekly deliveries of events, some with broken payloads, each a batch of files by day; the second
    one fails at first and is run again."""
    base, store = work_dir(spark, "noted"), new_store(spark, "noted")
    rows, schema = _cut_events(spark, sf_dir), CONTRACTS[EVENTS].landing_schema()
    week = F.floor(F.datediff(F.to_date(EXTRACTED), F.lit(rows.agg(F.min(F.to_date(EXTRACTED))).first()[0])) / 7)

    def fail_second(batch, batch_id):
        if batch_id == 1:
            raise Interrupted("stopped on purpose")

    def run(on_batch):
        noted = {"quarantine": f"{base}/aside", "metrics": f"{base}/metrics", "on_batch": on_batch}
        stream_files(store, f"{base}/raw", *EVENTS, schema, f"{base}/checkpoint", **noted).awaitTermination()

    for (number,) in rows.select(week).distinct().sort(week).collect():
        append_landing(rows.filter(week == number), f"{base}/raw", f"{1704067200 + number}.1")
        try:
            run(fail_second if number == 1 else None)
        except Exception as error:  # the streaming query wraps the reason
            if "stopped on purpose" not in str(error):
                raise
            run(None)
    return read_metrics(spark, f"{base}/metrics").select("batch", "files", "rows", "broken", "status")


@query("incremental_boundary", f"{with_(i.PAGES_SQL)}\nSELECT {_LANDED} FROM page_items")
def incremental_boundary(spark, sf_dir):
    """Two extractions: the second starts at the last value of the first, for which the source has got
    further records meanwhile; those land, and none lands twice."""
    base = work_dir(spark, "boundary")
    store = TableStore(spark, f"{base}/tables")
    contract = replace(CONTRACTS["faire", "order_lines"], initial_value="v1")
    flatten_order_items(i.order_pages(spark, sf_dir)).write.parquet(f"{base}/source")  # what both extractions find
    items = spark.read.parquet(f"{base}/source")
    early = (F.col("order_updated_at") < "v2") | (F.col("order_updated_at") == "v2") & F.col("includes_tester")
    for records in (items.filter(early), items):
        land_records(store, records, contract, f"{base}/raw")
    return scan_landing(spark, f"{base}/raw").select(*_LANDED.split(", "))


# -- facts ----------------------------------------------------------------------------------------


@query(
    "late_data_dropped",
    f"""{with_(i.EVENTS_SQL)}
SELECT event_id, v, {EXTRACTED} > (SELECT max({EXTRACTED}) FROM events_raw WHERE v = 1) AS admitted
FROM events_raw WHERE v > 1""",
)
def late_data_dropped(spark, sf_dir):
    """Second and later versions against the high-water mark of the first ones: rows at or
    below the mark are late."""
    rows = i.events(spark, sf_dir)
    version = F.element_at(F.split(F.get_json_object("attributes", "$.uuid"), "-"), 3).cast("int")
    rows = rows.select(F.col("id").alias("event_id"), version.alias("v"), EXTRACTED)
    mark = high_water_mark(rows.filter("v = 1"), EXTRACTED)
    arrived = rows.filter("v > 1")
    return arrived.select("event_id", "v", newer_than(arrived, EXTRACTED, mark).alias("admitted"))


@query("fct_sales_recompute", f"{with_(i.SALES_SQL)}\nSELECT * FROM sales")
def fct_sales_recompute(spark, sf_dir):
    """Refunds streamed one by one, in whatever batches they arrive; the fact adds them all up."""
    store = new_store(spark, "recompute")
    root = i.landing(spark, sf_dir, "refunds", i.refunds)
    schema = CONTRACTS["shopify", "order_refunds"].landing_schema()
    models = [processed.REFUND_LINES]
    stream_files(store, root, "shopify", "order_refunds", schema, work_dir(spark, "checkpoint"), models).awaitTermination()
    run_processed(store, processed.ORDERS, i.orders(spark, sf_dir))
    refresh_fact(store, enriched.FCT_SALES_RECOMPUTE, full=True)
    return store.read(enriched.FCT_SALES_RECOMPUTE.name)


@query(
    "recent_events",
    """SELECT event_id, ts FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
)
def recent_events(spark, sf_dir):
    """Rows younger than an interval before the newest one."""
    rows = i.table(spark, sf_dir, "events").select("event_id", "ts")
    kind = rows.schema["ts"].dataType
    start = F.lit(high_water_mark(rows, "ts")).cast(kind) - F.expr("INTERVAL 7 DAY")
    return rows.filter(F.col("ts") >= start)


PROPAGATION_SQL = f"""{with_(i.ORDERS_SQL, i.REFUNDS_SQL)},
first_fact AS ({i.sales_sql("(SELECT * FROM orders_raw WHERE v = 1)")}),
mark AS (SELECT max({EXTRACTED}) AS value FROM first_fact),
increment AS ({i.sales_sql("orders_latest", "greatest(sold_at, refunded_at) > (SELECT value FROM mark)")})
SELECT * FROM first_fact WHERE order_id NOT IN (SELECT order_id FROM increment)
UNION ALL SELECT * FROM increment"""


@query("run_pipeline", PROPAGATION_SQL)
@query("downstream_propagation", PROPAGATION_SQL)
def downstream_propagation(spark, sf_dir):
    """Two loads of orders through landing, feeder and processed table; the sales fact
    follows each, the second time by increment."""
    base = work_dir(spark, "propagation")
    store = TableStore(spark, f"{base}/tables", buckets=i.BUCKETS)
    rows = i.orders(spark, sf_dir)
    schema = CONTRACTS["shopify", "orders"].landing_schema()
    refunds = i.landing(spark, sf_dir, "refunds", i.refunds)
    refund_schema = CONTRACTS["shopify", "order_refunds"].landing_schema()
    facts = [enriched.FCT_SALES_RECOMPUTE]

    refund_lines = [processed.REFUND_LINES]  # one by one: refunds of an order come in several batches
    feed_files(store, refunds, "shopify", "order_refunds", refund_schema, refund_lines)
    for load, batch in (("1704067200.1", rows.filter("v = 1")), ("1706745600.1", rows.filter("v > 1"))):
        append_landing(batch.drop("v"), f"{base}/orders", load)
        fed = feed_files(store, f"{base}/orders", "shopify", "orders", schema)
        if fed.files:
            refresh_dependents(store, [processed.ORDERS.name], facts)
    return store.read(enriched.FCT_SALES_RECOMPUTE.name)




@query(
    "dependency_order",
    f"""{with_(i.SALES_SQL)}
SELECT CAST(date_trunc('day', order_date) AS TIMESTAMP) AS day, CAST(sum(total_sales) AS DECIMAL(18,2)) AS total_sales
FROM sales WHERE is_test_order = false GROUP BY 1""",
)
def dependency_order(spark, sf_dir):
    """Two facts, the second over the first, named in the wrong order: both follow a change of orders."""
    store = new_store(spark, "order")
    run_processed(store, processed.ORDERS, i.orders(spark, sf_dir))
    run_processed(store, processed.ORDER_REFUNDS, i.refunds(spark, sf_dir))
    daily = EnrichedModel("fct_daily", ("fct_sales",), ("day",), "day", lambda ctx: enriched.daily_totals(ctx.ref("fct_sales")))
    refresh_dependents(store, [processed.ORDERS.name], [daily, enriched.FCT_SALES])
    return store.read("fct_daily")
