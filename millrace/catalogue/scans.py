"""Landing scans, file discovery, contracts and schema inference."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.catalogue import inputs as i
from millrace.catalogue.registry import query, with_
from millrace.functions import date_label, partition_date
from millrace.operators import flatten_order_items
from millrace.operators.dedupe import SOURCE_FILE
from millrace.plans.processed import EXTRACTED
from millrace.session import work_dir
from millrace.sources import (
    append_landing,
    extract_increment,
    files_after_cursor,
    infer_fields,
    infer_nested,
    list_files,
    scan_files,
    scan_landing,
)
from millrace.sources.contracts import StreamContract
from millrace.sources.known import CONTRACTS

EVENTS_CONTRACT = CONTRACTS["klaviyo", "events"]


def events_landing(spark, sf_dir):
    return i.landing(spark, sf_dir, "events", i.events)


@query("scan_file_list", f"{with_(i.EVENTS_SQL)}\nSELECT event_id, event_datetime, {EXTRACTED} FROM events_raw")
def scan_file_list(spark, sf_dir):
    root = events_landing(spark, sf_dir)
    paths = [r["path"] for r in list_files(spark, [root]).select("path").toLocalIterator()]
    rows = scan_files(spark, root, paths, EVENTS_CONTRACT.landing_schema())
    return rows.select(F.col("id").alias("event_id"), F.col("datetime").alias("event_datetime"), EXTRACTED)


@query(
    "scan_source_file",
    f"{with_(i.EVENTS_SQL)}\nSELECT event_id, CAST({EXTRACTED} AS DATE) AS file_date FROM events_raw",
)
def scan_source_file(spark, sf_dir):
    """The file each row came from, reduced to the date in its path."""
    rows = scan_landing(spark, events_landing(spark, sf_dir), schema=EVENTS_CONTRACT.landing_schema())
    return rows.select(F.col("id").alias("event_id"), partition_date(F.col(SOURCE_FILE)).alias("file_date"))


@query(
    "scan_hive_partitions",
    f"{with_(i.EVENTS_SQL)}\nSELECT year, month, day, count(*) AS events FROM events_raw GROUP BY ALL",
)
def scan_hive_partitions(spark, sf_dir):
    rows = scan_landing(spark, events_landing(spark, sf_dir), schema=EVENTS_CONTRACT.landing_schema())
    return rows.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("events"))


FIRST_DAY, LAST_DAY = dt.date(2024, 1, 5), dt.date(2024, 1, 20)


@query(
    "scan_partition_range",
    f"""{with_(i.EVENTS_SQL)}
SELECT event_id, {EXTRACTED} FROM events_raw
WHERE CAST({EXTRACTED} AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'""",
)
def scan_partition_range(spark, sf_dir):
    root = events_landing(spark, sf_dir)
    rows = scan_landing(spark, root, FIRST_DAY, LAST_DAY, EVENTS_CONTRACT.landing_schema())
    return rows.select(F.col("id").alias("event_id"), EXTRACTED)


@query(
    "scan_recursive_glob",
    f"{with_(i.EVENTS_SQL)}\nSELECT DISTINCT strftime({EXTRACTED}, '%Y-%m-%d') AS label FROM events_raw",
)
def scan_recursive_glob(spark, sf_dir):
    listing = files_after_cursor(spark, events_landing(spark, sf_dir), None)
    return listing.select(date_label(F.col("path")).alias("label")).distinct()


CURSOR_DAY = dt.date(2024, 1, 10)


@query(
    "files_after_cursor",
    f"""{with_(i.EVENTS_SQL)}
SELECT DISTINCT CAST({EXTRACTED} AS DATE) AS partition_date FROM events_raw
WHERE CAST({EXTRACTED} AS DATE) > DATE '{CURSOR_DAY}'""",
)
def after_cursor(spark, sf_dir):
    """Days with files behind the last file of a day."""
    root = events_landing(spark, sf_dir)
    cursor = f"{root}/year=2024/month=01/day=10/~"
    listing = files_after_cursor(spark, root, cursor)
    return listing.select(partition_date(F.col("path")).alias("partition_date")).distinct()


@query(
    "union_schema_evolution",
    f"""{with_(i.CAMPAIGNS_SQL)}
SELECT campaign_id, v, campaign_name, CASE WHEN v > 1 THEN channel END AS channel FROM campaigns_raw""",
)
def union_schema_evolution(spark, sf_dir):
    """Two loads in one landing zone; the later one has a column more."""
    root = work_dir(spark, "evolution")
    rows = i.campaigns(spark, sf_dir)
    attribute = lambda name: F.get_json_object("attributes", f"$.{name}")
    rows = rows.select(
        F.col("id").alias("campaign_id"),
        F.substring(attribute("updated_at"), 2, 9).cast("int").alias("v"),
        attribute("name").alias("campaign_name"),
        attribute("channel").alias("channel"),
        "year", "month", "day",
    )
    append_landing(rows.filter("v = 1").drop("channel"), root, "1704067200.1")
    append_landing(rows.filter("v > 1"), root, "1704153600.1")
    return scan_landing(spark, root).select("campaign_id", "v", "campaign_name", "channel")


@query(
    "landing_append",
    f"""{with_(i.ORDERS_SQL)}
SELECT year, month, day, v, count(*) AS orders FROM orders_raw GROUP BY ALL""",
)
def landing_append(spark, sf_dir):
    """Two loads appended to dated folders and read back by folder."""
    root = work_dir(spark, "append")
    rows = i.orders(spark, sf_dir)
    append_landing(rows.filter("v = 1"), root, "1704067200.1")
    append_landing(rows.filter("v > 1"), root, "1704153600.1")
    return scan_landing(spark, root).groupBy("year", "month", "day", "v").agg(F.count(F.lit(1)).alias("orders"))


STATE = "1998-01-01 00:00:00"


@query(
    "incremental_extract",
    f"""SELECT o_orderkey, o_orderdate, (SELECT max(o_orderdate) FROM orders) AS new_cursor FROM orders
WHERE o_orderdate >= TIMESTAMP '{STATE}'""",
)
def incremental_extract(spark, sf_dir):
    """Records at or after the stored cursor, beside the cursor to store next."""
    rows = i.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    fresh, state = extract_increment(rows, "o_orderdate", STATE)
    return fresh.withColumn("new_cursor", F.lit(state).cast("timestamp_ntz"))


@query(
    "contract_projection",
    f"{with_(i.PAGES_SQL)}\nSELECT id, quantity, sku, price_amount_minor, price_currency, order_id FROM page_items",
)
def contract_projection(spark, sf_dir):
    """Items cut down to the fields a contract selects; the unknown field is left out."""
    selected = ["id", "quantity", "sku", "price_amount_minor", "price_currency", "order_id", "gift_note"]
    known = CONTRACTS["faire", "order_lines"].fields
    contract = StreamContract("faire", "order_lines", {f: known.get(f, {"type": "string"}) for f in selected})
    return flatten_order_items(i.order_pages(spark, sf_dir)).transform(contract.project)


@query(
    "apply_contract_schema",
    f"""{with_(i.EVENTS_SQL)}
SELECT event_id, event_uuid AS uuid, CAST(event_timestamp AS BIGINT) AS "timestamp", properties AS event_properties
FROM events_raw""",
)
def apply_contract_schema(spark, sf_dir):
    """JSON attributes to typed columns by the contract's field definitions."""
    schema = EVENTS_CONTRACT.nested_schema()["attributes"].dataType
    rows = i.events(spark, sf_dir).select(F.col("id").alias("event_id"), F.from_json("attributes", schema).alias("a"))
    return rows.select("event_id", "a.uuid", "a.timestamp", "a.event_properties")


@query(
    "infer_schema",
    f"""{with_(i.EVENTS_SQL)}
SELECT field, type, CAST(NULL AS VARCHAR) AS format, n AS present
FROM (VALUES ('uuid', 'string'), ('timestamp', 'integer'), ('event_properties', 'object')) AS fields(field, type),
     (SELECT count(*) AS n FROM events_raw) AS counted""",
)
def infer_schema(spark, sf_dir):
    return infer_fields(i.events(spark, sf_dir), "attributes")


_NESTED = """json_object('id', c_custkey, 'name', c_name, 'mixed', CASE WHEN c_custkey % 2 = 0 THEN json(c_custkey) ELSE json('1.5') END,
    'odd', CASE WHEN c_custkey % 3 = 0 THEN json('true') ELSE to_json(c_name) END,
    'place', json_object('nation', c_nationkey, 'since', '2024-01-02T03:04:05Z', 'tags', json_array(c_mktsegment, json_object('n', c_acctbal))))"""


@query(
    "infer_nested",
    f"""
WITH nodes AS (
    SELECT regexp_replace(regexp_replace(replace(fullkey, '$.', ''), '"', '', 'g'), '\\[[0-9]+\\]', '[]', 'g') AS field, type, atom
    FROM (SELECT {_NESTED} AS record FROM customer) AS r, json_tree(r.record) WHERE fullkey <> '$'),
kinds AS (
    SELECT field, count(*) AS present, list_sort(list(DISTINCT CASE
        WHEN type IN ('BIGINT', 'UBIGINT') THEN 'integer' WHEN type = 'DOUBLE' THEN 'number' WHEN type = 'VARCHAR' THEN 'string'
        ELSE lower(type) END)) AS types,
        bool_and(type = 'VARCHAR' AND regexp_matches(CAST(atom AS VARCHAR), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T')) AS time
    FROM nodes GROUP BY field)
SELECT field, CASE WHEN len(types) = 1 THEN types[1] WHEN types = ['integer', 'number'] THEN 'number' ELSE 'string' END AS type,
    CASE WHEN time THEN 'date-time' END AS format, present FROM kinds""",
)
def infer_nested_fields(spark, sf_dir):
    """Properties of objects and items of arrays, mixed types and date-times among them."""
    key = F.col("c_custkey")
    record = F.concat(
        F.lit('{"id":'), key, F.lit(',"name":"'), F.col("c_name"), F.lit('","mixed":'), F.when(key % 2 == 0, key.cast("string")).otherwise("1.5"),
        F.lit(',"odd":'), F.when(key % 3 == 0, "true").otherwise(F.concat(F.lit('"'), F.col("c_name"), F.lit('"'))),
        F.lit(',"place":{"nation":'), F.col("c_nationkey"), F.lit(',"since":"2024-01-02T03:04:05Z","tags":['),
        F.expr("substring(%s, 2, length(%s) - 2)" % (("to_json(array(c_mktsegment))",) * 2)), F.lit(","),
        F.expr("substring(%s, 2, length(%s) - 2)" % (("to_json(array(named_struct('n', c_acctbal)))",) * 2)), F.lit("]}}"),
    )
    return infer_nested(i.spread(i.table(spark, sf_dir, "customer"), "c_custkey").select(record.alias("record")), "record")
