"""Versioned tables: upserts, sync modes, time travel, maintenance and metadata."""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.sql import functions as F

from millrace.catalogue import inputs as i
from millrace.catalogue.registry import query, with_
from millrace.plans import processed
from millrace.plans.processed import EXTRACTED, LOAD
from millrace.plans.refresh import run_processed
from millrace.session import work_dir
from millrace.tables import TableStore, maintenance

ORDERS = processed.ORDERS.name
FEW = ["order_id", "financial_status", "discounts", EXTRACTED]


def new_store(spark, label, buckets=None):
    return TableStore(spark, work_dir(spark, label), clock=daily_clock(), buckets=buckets)


def daily_clock():
    """A clock that moves one day with every reading, so that ages can be told apart."""
    days = itertools.count()
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return lambda: start + dt.timedelta(days=next(days))


def version_batch(spark, sf_dir, version):
    """Landing rows of orders at one version."""
    return i.orders(spark, sf_dir).filter(F.col("v") == version)


def order_table(spark, sf_dir, label, buckets=None):
    """The orders table after three upserts: all orders, then their second and third versions."""
    store = new_store(spark, label, buckets)
    for version in (1, 2, 3):
        run_processed(store, processed.ORDERS, version_batch(spark, sf_dir, version))
    return store


_shared: dict[tuple[str, str], TableStore] = {}


def shared_order_table(spark, sf_dir):
    """The same table for queries that only read it, built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _shared:
        _shared[key] = order_table(spark, sf_dir, "orders")
    return _shared[key]


# -- reading ----------------------------------------------------------------------------------


@query("scan_ref", f"{with_(i.ORDERS_SQL)}\nSELECT {', '.join(FEW)} FROM orders_latest")
def scan_ref(spark, sf_dir):
    return shared_order_table(spark, sf_dir).read(ORDERS).select(*FEW)


@query(
    "time_travel_read",
    f"""{with_(i.ORDERS_SQL)}
SELECT {', '.join(FEW)} FROM orders_raw WHERE v <= 2
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {EXTRACTED} DESC) = 1""",
)
def time_travel_read(spark, sf_dir):
    return shared_order_table(spark, sf_dir).read(ORDERS, version=2).select(*FEW)


@query(
    "snapshot_validity",
    f"""{with_(i.ORDERS_SQL)}
SELECT CAST(n AS BIGINT) AS version, count(*) AS record_count
FROM orders_latest, (VALUES (1), (2), (3)) AS versions(n) GROUP BY ALL""",
)
def snapshot_validity(spark, sf_dir):
    """Rows in the data files valid at each version."""
    table = shared_order_table(spark, sf_dir).table(ORDERS)
    counts = [
        table.files_at(v).agg(F.lit(v).cast("long").alias("version"), F.sum("record_count").alias("record_count"))
        for v in (1, 2, 3)
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# -- upserts and sync modes -------------------------------------------------------------------


@query(
    "upsert_single_key",
    f"""{with_(i.ORDERS_SQL)}
SELECT order_id, customer_id, gross_sales, discounts, shipping, taxes, {EXTRACTED} FROM orders_latest""",
)
def upsert_single_key(spark, sf_dir):
    store = order_table(spark, sf_dir, "upsert", i.BUCKETS)
    return store.read(ORDERS).select(
        "order_id", "customer_id", "gross_sales", "discounts", "shipping", "taxes", EXTRACTED
    )


@query(
    "upsert_composite_key",
    f"""{with_(i.ERP_ORDERS_SQL)},
every_tag AS ({i.tags_sql("erp_raw", "order_id, v")})
SELECT order_id, tag, {LOAD} FROM every_tag
QUALIFY rank() OVER (PARTITION BY order_id, tag ORDER BY {LOAD} DESC) = 1""",
)
def upsert_composite_key(spark, sf_dir):
    """Tags by order and tag in three batches: a tag that is gone from an order stays."""
    store = new_store(spark, "tags", i.BUCKETS)
    for version in (1, 2, 3):
        batch = i.erp_orders(spark, sf_dir).filter(F.col("v") == version)
        run_processed(store, processed.ORDER_TAGS, batch)
    return store.read(processed.ORDER_TAGS.name)


@query("full_refresh", f"{with_(i.ORDERS_SQL)}\nSELECT {', '.join(FEW)} FROM orders_latest")
def full_refresh(spark, sf_dir):
    """A table with an old version, rebuilt from all landing rows."""
    table = new_store(spark, "refresh", i.BUCKETS).table(ORDERS)
    table.overwrite(processed.ORDERS(version_batch(spark, sf_dir, 1)), ["order_id"])
    table.overwrite(processed.ORDERS(i.orders(spark, sf_dir)), ["order_id"], operation="full refresh")
    return table.read().select(*FEW)


_HALF = "TIMESTAMP '2024-01-24 00:00:00'"


@query(
    "incremental_first_run",
    f"""{with_(i.REFUNDS_SQL)},
batch_sums AS (
    SELECT order_id, late, CAST(sum(amount + 1.00) AS DECIMAL(18,2)) AS returns, max({EXTRACTED}) AS {EXTRACTED}
    FROM (SELECT *, {EXTRACTED} >= {_HALF} AS late FROM refunds_raw
          QUALIFY row_number() OVER (PARTITION BY id, {EXTRACTED} >= {_HALF} ORDER BY {EXTRACTED} DESC) = 1)
    WHERE slot NOT IN (0, 6) GROUP BY order_id, late)
SELECT order_id, returns, {EXTRACTED} FROM batch_sums
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY late DESC) = 1""",
)
def incremental_first_run(spark, sf_dir):
    """Refund sums in two batches: the first creates the table, the second replaces the sums
    of the orders it holds."""
    store = new_store(spark, "first-run", i.BUCKETS)
    rows = i.refunds(spark, sf_dir)
    late = F.col(EXTRACTED) >= F.expr(_HALF.replace("TIMESTAMP", "timestamp_ntz"))
    for batch in (rows.filter(~late), rows.filter(late)):
        run_processed(store, processed.ORDER_REFUNDS, batch)
    sums = store.read(processed.ORDER_REFUNDS.name)
    return sums.select("order_id", F.col("returns").cast("decimal(18,2)").alias("returns"), EXTRACTED)


@query(
    "sync_overwrite",
    f"""{with_(i.ORDERS_SQL)}
SELECT {', '.join(FEW)} FROM orders_raw WHERE v > 1
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {EXTRACTED} DESC) = 1""",
)
def sync_overwrite(spark, sf_dir):
    """Overwrite mode: only the last write is left."""
    table = new_store(spark, "overwrite", i.BUCKETS).table(ORDERS)
    rows = i.orders(spark, sf_dir)
    for batch in (rows.filter("v = 1"), rows.filter("v > 1")):
        table.write(processed.ORDERS(batch), "overwrite", ["order_id"])
    return table.read().select(*FEW)


@query("sync_append_dedup", f"{with_(i.ORDERS_SQL)}\nSELECT {', '.join(FEW)} FROM orders_latest")
def sync_append_dedup(spark, sf_dir):
    """Append-dedup mode: the newest version stays, in whatever order versions come."""
    table = new_store(spark, "dedup", i.BUCKETS).table(ORDERS)
    for version in (2, 3, 1):
        batch = processed.ORDERS(version_batch(spark, sf_dir, version))
        table.write(batch, "append_dedup", ["order_id"], EXTRACTED)
    return table.read().select(*FEW)


GUARDED = f"""
    SELECT order_id, financial_status, discounts, {EXTRACTED} FROM orders_raw
    QUALIFY rank() OVER (PARTITION BY order_id ORDER BY {EXTRACTED} DESC) = 1"""
#: Orders without a key: every 50th is seen once so in the first and once in the last batch.
NO_KEY = f"SELECT CAST(NULL AS BIGINT), financial_status, discounts, {EXTRACTED} FROM orders_raw WHERE order_id % 50 = 0"


def keyless(rows):
    return rows.filter("order_id % 50 = 0").withColumn("order_id", F.lit(None).cast("long"))


@query(
    "upsert_guarded",
    f"""{with_(i.ORDERS_SQL)}
SELECT * FROM ({GUARDED}) UNION ALL
SELECT * FROM ({GUARDED}) WHERE order_id % 40 = 0 UNION ALL {NO_KEY}""",
)
def upsert_guarded(spark, sf_dir):
    """Versions in the wrong order, some rows twice in a batch, some without a key: newer rows
    stay, twins stay twins, and rows of other keys or none stay whatever file they lie in."""
    table = new_store(spark, "guarded", i.BUCKETS).table(ORDERS)
    for version in (2, 3, 1):
        batch = i.orders(spark, sf_dir).filter(F.col("v") == version)
        rows = processed.ORDERS(batch).select(*FEW)
        table.upsert(rows.union(rows.filter("order_id % 40 = 0")).union(keyless(rows)), ["order_id"], guard_version=EXTRACTED)
    return table.read()


@query("append_dedup", f"{with_(i.ORDERS_SQL)}\nSELECT * FROM ({GUARDED}) UNION ALL {NO_KEY}")
def append_dedup(spark, sf_dir):
    """The same batches, deduplicated: one row a key, and all rows without one."""
    table = new_store(spark, "append-dedup", i.BUCKETS).table(ORDERS)
    for version in (2, 3, 1):
        batch = i.orders(spark, sf_dir).filter(F.col("v") == version)
        rows = processed.ORDERS(batch).select(*FEW)
        table.append_dedup(rows.union(rows.filter("order_id % 40 = 0")).union(keyless(rows)), ["order_id"], EXTRACTED)
    return table.read()


# -- maintenance ------------------------------------------------------------------------------

SECOND_DAY = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)


@query(
    "expire_snapshots",
    f"""{with_(i.ORDERS_SQL)}
SELECT CAST(n AS BIGINT) AS version, n < 2 AS expired, count(CASE WHEN n >= 2 THEN 1 END) AS record_count
FROM orders_latest, (VALUES (1), (2), (3), (4)) AS versions(n) GROUP BY n""",
)
def expire_snapshots(spark, sf_dir):
    """Three daily versions, those older than the second day expired; rows per kept version."""
    table = order_table(spark, sf_dir, "expire").table(ORDERS)
    last = maintenance.expire_snapshots(table, SECOND_DAY)
    counts = None
    for version in range(table.first_kept(), last + 1):
        one = table.files_at(version).agg(
            F.lit(version).cast("long").alias("version"), F.sum("record_count").alias("record_count")
        )
        counts = one if counts is None else counts.unionByName(one)
    found = F.coalesce("record_count", F.lit(0)).alias("record_count")
    return table.snapshots().join(counts, "version", "left").select("version", "expired", found)


@query(
    "cleanup_old_files",
    f"""{with_(i.ORDERS_SQL)}
SELECT CAST(v AS BIGINT) AS begin_snapshot, count(*) AS record_count FROM orders_raw WHERE v = 1 GROUP BY v""",
)
def cleanup_old_files(spark, sf_dir):
    """Rows in the files that only expired versions could see, then the files are deleted."""
    table = order_table(spark, sf_dir, "cleanup").table(ORDERS)
    maintenance.expire_snapshots(table, SECOND_DAY)
    report = maintenance.unseen_files(table).groupBy("begin_snapshot").agg(F.sum("record_count").alias("record_count"))
    maintenance.cleanup_old_files(table, dry_run=False)
    return report


@query(
    "orphan_files",
    f"{with_(i.ORDERS_SQL)}\nSELECT order_id, v FROM orders_raw WHERE v = 2",
)
def orphan_files(spark, sf_dir):
    """Rows of files that were written but never committed, as a failed job leaves them."""
    table = new_store(spark, "orphans").table(ORDERS)
    table.overwrite(processed.ORDERS(version_batch(spark, sf_dir, 1)), ["order_id"])
    lost = version_batch(spark, sf_dir, 2).select(F.col("id").alias("order_id"), "v")
    lost.write.parquet(f"{table.data_path}/lost")
    found = [r["path"] for r in maintenance.orphan_files(table, dt.timedelta(0)).select("path").toLocalIterator()]
    return spark.read.schema("order_id long, v int").parquet(*[f"{table.data_path}/{p}" for p in found])


@query("compact_table", f"{with_(i.ORDERS_SQL)}\nSELECT order_id, discounts, {EXTRACTED} FROM orders_raw")
def compact_table(spark, sf_dir):
    """Appended loads rewritten as fewer files, same rows."""
    table = new_store(spark, "compact").table(ORDERS)
    for version in (1, 2, 3):
        table.append(processed.ORDERS(version_batch(spark, sf_dir, version)))
    maintenance.compact(table, ["order_id"])
    return table.read().select("order_id", "discounts", EXTRACTED)


@query(
    "file_column_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
    CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM lineitem"""
        for c in ("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    ),
)
def file_column_stats(spark, sf_dir):
    """Statistics of each file of a table (the given table is one file)."""
    rows = i.table(spark, sf_dir, "lineitem")
    stats = maintenance.file_column_stats(rows, ["l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"])
    return stats.drop("file_path")


# -- metadata ---------------------------------------------------------------------------------


@query(
    "meta_current_tables",
    f"""{with_(i.ORDERS_SQL)}
SELECT '{ORDERS}' AS table_name, CAST(3 AS BIGINT) AS version, count(*) AS record_count FROM orders_latest""",
)
def meta_current_tables(spark, sf_dir):
    tables = maintenance.current_tables(shared_order_table(spark, sf_dir))
    return tables.select("table_name", "version", "record_count")


@query(
    "meta_data_files",
    f"{with_(i.ORDERS_SQL)}\nSELECT CAST(sum(1) AS BIGINT) AS record_count FROM orders_latest",
)
def meta_data_files(spark, sf_dir):
    """Current data files of a table, their record counts added up."""
    files = shared_order_table(spark, sf_dir).table(ORDERS).files_at()
    return files.agg(F.sum("record_count").alias("record_count"))


@query(
    "meta_snapshot_history",
    f"""{with_(i.ORDERS_SQL)}
SELECT CAST(v AS BIGINT) AS version, CASE WHEN v = 1 THEN 'create' ELSE 'upsert' END AS operation,
    count(*) AS batch_rows FROM orders_raw GROUP BY v""",
)
def meta_snapshot_history(spark, sf_dir):
    """Snapshots with the rows each one's batch brought in."""
    table = shared_order_table(spark, sf_dir).table(ORDERS)
    batch = table.data_files().filter(F.col("path").rlike("^(full|batch)-"))
    rows = batch.groupBy(F.col("begin_snapshot").alias("version")).agg(F.sum("record_count").alias("batch_rows"))
    return table.snapshots().select("version", "operation").join(rows, "version")
