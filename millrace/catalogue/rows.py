"""Projections, filters, joins, aggregations, deduplication, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalogue import inputs as i
from millrace.catalogue.models import sales_facts
from millrace.catalogue.registry import query, with_
from millrace.functions import (
    date_label,
    json_text,
    json_texts,
    natural_key,
    partition_date,
    to_bigint,
    to_boolean,
    to_double,
    to_money,
)
from millrace.functions.payload import split_malformed
from millrace.operators import (
    explode_text_array,
    flatten_order_items,
    high_water_mark,
    latest_per_key,
    newer_than_target,
    replaced_rows,
)
from millrace.operators.flatten import filled_array_text
from millrace.plans import enriched, processed
from millrace.plans.processed import EXTRACTED, LOAD

# -- projections and filters ------------------------------------------------------------------


@query(
    "project_rename",
    f"""{with_(i.ORDERS_SQL)}
SELECT order_id, order_date, order_updated_at, is_test_order, {EXTRACTED} FROM orders_raw""",
)
def project_rename(spark, sf_dir):
    return i.orders(spark, sf_dir).select(
        F.col("id").alias("order_id"),
        F.col("created_at").alias("order_date"),
        F.col("updated_at").alias("order_updated_at"),
        F.col("test").alias("is_test_order"),
        EXTRACTED,
    )


@query(
    "sales_metrics",
    f"{with_(i.SALES_SQL)}\nSELECT order_id, gross_sales, discounts, returns, net_sales, total_sales FROM sales",
)
def sales_metrics(spark, sf_dir):
    return sales_facts(spark, sf_dir).select(
        "order_id", "gross_sales", "discounts", "returns", "net_sales", "total_sales"
    )


@query(
    "filter_empty_tags",
    f"{with_(i.ERP_ORDERS_SQL)}\nSELECT order_id, tags, v FROM erp_raw "
    f"WHERE {i.HAS_TAGS}",
)
def filter_empty_tags(spark, sf_dir):
    rows = i.erp_orders(spark, sf_dir).filter(filled_array_text(F.col("tags")))
    return rows.select(F.col("id").alias("order_id"), "tags", "v")


@query(
    "filter_valid_sales",
    f"{with_(i.SALES_SQL)}\nSELECT * FROM sales WHERE is_test_order = false AND cancelled_at IS NULL",
)
def filter_valid_sales(spark, sf_dir):
    return enriched.valid_sales(sales_facts(spark, sf_dir))


@query("filter_paid", f"{with_(i.SALES_SQL)}\nSELECT * FROM sales WHERE financial_status = 'paid'")
def filter_paid(spark, sf_dir):
    return enriched.paid_sales(sales_facts(spark, sf_dir))


@query(
    "filter_in_list",
    f"{with_(i.EVENTS_SQL)}\nSELECT event_id, metric_id FROM events_raw WHERE metric_id IN ('click', 'view')",
)
def filter_in_list(spark, sf_dir):
    rows = i.events(spark, sf_dir)
    metric = json_text(F.col("relationships"), "metric.data.id")
    return rows.select(F.col("id").alias("event_id"), metric.alias("metric_id")).filter(
        F.col("metric_id").isin("click", "view")
    )


@query(
    "watermark_filter",
    f"""{with_(i.ORDERS_SQL)}
SELECT order_id, v, {EXTRACTED} FROM orders_raw
WHERE {EXTRACTED} > (SELECT max({EXTRACTED}) FROM orders_raw WHERE v = 1)""",
)
def watermark_filter(spark, sf_dir):
    rows = i.orders(spark, sf_dir).select(F.col("id").alias("order_id"), "v", EXTRACTED)
    return newer_than_target(rows, rows.filter("v = 1"), EXTRACTED)


@query(
    "incremental_or_filter",
    f"""{with_(i.ORDERS_SQL, i.REFUNDS_SQL)}
{i.sales_sql("orders_latest", "greatest(sold_at, refunded_at) > (SELECT max(" + EXTRACTED + ") FROM orders_raw WHERE v = 1)")}""",
)
def incremental_or_filter(spark, sf_dir):
    landing = i.orders(spark, sf_dir)
    mark = high_water_mark(landing.filter("v = 1"), EXTRACTED)
    return enriched.sales_since_landing(landing, i.refunds(spark, sf_dir), mark)


# -- joins ------------------------------------------------------------------------------------


@query(
    "left_join_refunds",
    f"""{with_(i.ORDERS_SQL, i.REFUNDS_SQL)}
SELECT o.order_id, o.gross_sales, r.returns
FROM orders_latest o LEFT JOIN refund_sums r ON o.order_id = r.order_id""",
)
def left_join_refunds(spark, sf_dir):
    orders = processed.ORDERS(i.orders(spark, sf_dir)).select("order_id", "gross_sales")
    refunds = processed.ORDER_REFUNDS(i.refunds(spark, sf_dir))
    returns = refunds.select("order_id", F.col("returns").cast("decimal(18,2)").alias("returns"))
    return orders.join(returns, "order_id", "left")


@query(
    "lateral_unnest",
    f"""{with_(i.REFUNDS_SQL)}
SELECT id, CASE part WHEN 1 THEN amount WHEN 2 THEN CAST(1.00 AS DECIMAL(10,2)) END AS amount
FROM refunds_raw, generate_series(1, 3) AS parts(part) WHERE slot NOT IN (0, 6)""",
)
def lateral_unnest(spark, sf_dir):
    rows = i.refunds(spark, sf_dir).select("id", F.explode("transactions").alias("t"))
    return rows.select("id", to_money(json_text(F.col("t"), "amount")).alias("amount"))


_VALID_ORDERS = "v = 1 + CAST({0} % 3 = 0 AS INT) + CAST({0} % 9 = 0 AS INT)"


@query(
    "inner_join_validity",
    f"""{with_(i.ORDERS_SQL, i.CUSTOMERS_SQL)}
SELECT o.order_id, o.customer_id, c.email, o.v AS begin_snapshot
FROM orders_raw o JOIN customers_latest c ON o.customer_id = c.customer_id
WHERE {_VALID_ORDERS.format("o.order_id")}""",
)
def inner_join_validity(spark, sf_dir):
    """Order versions and customers, both only as far as they are valid now. One customer may
    hold much of the orders."""
    last = F.lit(1) + (F.col("id") % 3 == 0).cast("int") + (F.col("id") % 9 == 0).cast("int")
    orders = i.orders(spark, sf_dir).select(
        F.col("id").alias("order_id"),
        to_bigint(json_text(F.col("customer"), "id")).alias("customer_id"),
        F.col("v").alias("begin_snapshot"),
        F.when(F.col("v") < last, F.col("v") + 1).alias("end_snapshot"),
    )
    customers = processed.CUSTOMERS(i.customers(spark, sf_dir)).select("customer_id", "email")
    current = orders.filter("end_snapshot IS NULL").drop("end_snapshot")
    return current.join(customers, "customer_id")


@query(
    "anti_join_orphans",
    f"""{with_(i.ORDERS_SQL, i.REFUNDS_SQL)}
SELECT o.order_id, o.customer_id FROM orders_latest o LEFT JOIN refund_sums r ON o.order_id = r.order_id
WHERE r.order_id IS NULL""",
)
def anti_join_orphans(spark, sf_dir):
    orders = processed.ORDERS(i.orders(spark, sf_dir)).select("order_id", "customer_id")
    return orders.join(processed.ORDER_REFUNDS(i.refunds(spark, sf_dir)), "order_id", "left_anti")


@query(
    "semi_join_replaced",
    f"""{with_(i.ORDERS_SQL)}
SELECT order_id, gross_sales, discounts FROM orders_raw
WHERE v = 1 AND order_id IN (SELECT order_id FROM orders_raw WHERE v = 2)""",
)
def semi_join_replaced(spark, sf_dir):
    landing = i.orders(spark, sf_dir)
    target, batch = (processed.ORDERS(landing.filter(F.col("v") == v)) for v in (1, 2))
    return replaced_rows(target, batch, ["order_id"]).select("order_id", "gross_sales", "discounts")


# -- aggregations -------------------------------------------------------------------------------


@query(
    "agg_refunds",
    f"""{with_(i.REFUNDS_SQL)}
SELECT order_id, CAST(sum(amount + 1.00) AS DECIMAL(18,2)) AS returns, max({EXTRACTED}) AS last_refund
FROM refunds_raw WHERE slot NOT IN (0, 6) GROUP BY order_id""",
)
def agg_refunds(spark, sf_dir):
    sums = processed.sum_refunds(i.refunds(spark, sf_dir))
    return sums.select(
        "order_id", F.col("returns").cast("decimal(18,2)").alias("returns"), F.col(EXTRACTED).alias("last_refund")
    )


@query("agg_max_watermark", f"{with_(i.SALES_SQL)}\nSELECT max({EXTRACTED}) AS watermark FROM sales")
def agg_max_watermark(spark, sf_dir):
    return sales_facts(spark, sf_dir).agg(F.max(EXTRACTED).alias("watermark"))


@query(
    "daily_totals",
    f"""{with_(i.SALES_SQL)}
SELECT CAST(date_trunc('day', order_date) AS TIMESTAMP) AS day, CAST(sum(total_sales) AS DECIMAL(18,2)) AS total_sales
FROM sales WHERE is_test_order = false GROUP BY 1""",
)
def daily_totals(spark, sf_dir):
    return enriched.daily_totals(sales_facts(spark, sf_dir))


# -- latest per key -----------------------------------------------------------------------------


@query(
    "dedupe_latest",
    """SELECT user_id, event_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def dedupe_latest(spark, sf_dir):
    rows = i.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return latest_per_key(rows, ["user_id"], "ts", tiebreak=[F.col("event_id").desc()])


@query("dedupe_by_load_id", f"{with_(i.LINES_SQL)}\nSELECT line_id, sku, subtotal, {LOAD} FROM lines_latest")
def dedupe_by_load_id(spark, sf_dir):
    rows = latest_per_key(i.erp_order_lines(spark, sf_dir), ["id"], LOAD)
    return rows.select(F.col("id").alias("line_id"), "sku", to_money(F.col("subtotal")).alias("subtotal"), LOAD)


@query(
    "dedupe_after_filter",
    f"{with_(i.ERP_ORDERS_SQL)}\nSELECT order_id, tags, {LOAD} FROM erp_raw WHERE {i.HAS_TAGS} "
    f"QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {LOAD} DESC) = 1",
)
def dedupe_after_filter(spark, sf_dir):
    tagged = i.erp_orders(spark, sf_dir).filter(filled_array_text(F.col("tags")))
    return latest_per_key(tagged.select(F.col("id").alias("order_id"), "tags", LOAD), ["order_id"], LOAD)


@query("dedupe_then_agg", f"{with_(i.REFUNDS_SQL)}\nSELECT order_id, returns, {EXTRACTED} FROM refund_sums")
def dedupe_then_agg(spark, sf_dir):
    sums = processed.sum_refunds(latest_per_key(i.refunds(spark, sf_dir), ["id"], EXTRACTED))
    return sums.select("order_id", F.col("returns").cast("decimal(18,2)").alias("returns"), EXTRACTED)


# -- sorts and limits ---------------------------------------------------------------------------


@query("sort_fact", f"{with_(i.SALES_SQL)}\nSELECT order_id, order_date, net_sales FROM sales ORDER BY order_date, order_id")
def sort_fact(spark, sf_dir):
    facts = sales_facts(spark, sf_dir).select("order_id", "order_date", "net_sales")
    return facts.orderBy("order_date", "order_id")


@query(
    "sort_desc",
    f"{with_(i.ORDERS_SQL)}\nSELECT order_id, order_updated_at FROM orders_raw ORDER BY order_updated_at DESC",
)
def sort_desc(spark, sf_dir):
    rows = i.orders(spark, sf_dir).select(F.col("id").alias("order_id"), F.col("updated_at").alias("order_updated_at"))
    return rows.orderBy(F.col("order_updated_at").desc())


@query(
    "sort_multi",
    "SELECT s_nationkey, s_name, s_suppkey FROM supplier ORDER BY s_nationkey, s_name, s_suppkey",
)
def sort_multi(spark, sf_dir):
    return i.table(spark, sf_dir, "supplier").select("s_nationkey", "s_name", "s_suppkey").orderBy(
        "s_nationkey", "s_name", "s_suppkey"
    )


@query(
    "limit_n",
    f"{with_(i.ORDERS_SQL)}\nSELECT order_id, v, {EXTRACTED} FROM orders_raw ORDER BY {EXTRACTED} DESC, order_id, v LIMIT 100",
)
def limit_n(spark, sf_dir):
    rows = i.orders(spark, sf_dir).select(F.col("id").alias("order_id"), "v", EXTRACTED)
    return rows.orderBy(F.col(EXTRACTED).desc(), "order_id", "v").limit(100)


@query(
    "natural_sort",
    """SELECT p_brand || '/part_' || p_partkey AS path,
    'Brand#' || lpad(CAST(length(substr(p_brand, 7)) AS VARCHAR), 6, '0') || ':' || substr(p_brand, 7)
    || '/part_' || lpad(CAST(length(CAST(p_partkey AS VARCHAR)) AS VARCHAR), 6, '0') || ':' || p_partkey AS sort_key
FROM part ORDER BY CAST(substr(p_brand, 7) AS INT), p_partkey""",
)
def natural_sort(spark, sf_dir):
    path = F.concat(F.col("p_brand"), F.lit("/part_"), F.col("p_partkey").cast("string"))
    rows = i.table(spark, sf_dir, "part").select(path.alias("path"))
    key = natural_key(F.col("path"))
    return rows.select("path", F.concat_ws("", key).alias("sort_key")).orderBy(key)


# -- scalar functions ---------------------------------------------------------------------------


@query(
    "json_extract",
    f"{with_(i.CAMPAIGNS_SQL)}\nSELECT campaign_id, v, campaign_name, status, channel, scheduled_at FROM campaigns_raw",
)
def json_extract(spark, sf_dir):
    """Text of top-level fields, one parse for all."""
    rows = i.campaigns(spark, sf_dir)
    names = {"name": "campaign_name", "status": "status", "channel": "channel", "scheduled_at": "scheduled_at"}
    texts = json_texts(F.col("attributes"), [*names, "updated_at"])
    version = F.substring(texts["updated_at"], 2, 9).cast("int").alias("v")
    return rows.select(F.col("id").alias("campaign_id"), version, *[texts[path].alias(alias) for path, alias in names.items()])


def _versioned(df, alias):
    """Campaign rows with the version number their payload carries."""
    version = F.substring(json_text(F.col("attributes"), "updated_at"), 2, 9).cast("int")
    return df.select(F.col("id").alias(alias), version.alias("v"), "attributes")


@query(
    "json_nested_path",
    f"{with_(i.EVENTS_SQL)}\nSELECT event_id, v, profile_id, metric_id FROM events_raw",
)
def json_nested_path(spark, sf_dir):
    rows = i.events(spark, sf_dir)
    texts = json_texts(F.col("relationships"), ["profile.data.id", "metric.data.id"])
    version = F.element_at(F.split(json_text(F.col("attributes"), "uuid"), "-"), 3).cast("int")
    return rows.select(
        F.col("id").alias("event_id"),
        version.alias("v"),
        texts["profile.data.id"].alias("profile_id"),
        texts["metric.data.id"].alias("metric_id"),
    )


@query("json_subobject", f"{with_(i.EVENTS_SQL)}\nSELECT event_id, event_uuid, properties FROM events_raw")
def json_subobject(spark, sf_dir):
    """A field and a whole object as text, from one parse."""
    texts = json_texts(F.col("attributes"), ["uuid", "event_properties"])
    return i.events(spark, sf_dir).select(
        F.col("id").alias("event_id"),
        texts["uuid"].alias("event_uuid"),
        texts["event_properties"].alias("properties"),
    )


@query("json_cast_boolean", f"{with_(i.CAMPAIGNS_SQL)}\nSELECT campaign_id, v, is_archived FROM campaigns_raw")
def json_cast_boolean(spark, sf_dir):
    rows = _versioned(i.campaigns(spark, sf_dir), "campaign_id")
    return rows.select("campaign_id", "v", to_boolean(json_text(F.col("attributes"), "archived")).alias("is_archived"))


_ANALYTICS = "predictive_analytics."


@query(
    "json_cast_double",
    f"{with_(i.PROFILES_SQL)}\nSELECT profile_id, total_clv, churn_probability, average_order_value FROM profiles_latest",
)
def json_cast_double(spark, sf_dir):
    names = ["total_clv", "churn_probability", "average_order_value"]
    texts = json_texts(F.col("attributes"), [_ANALYTICS + n for n in names])
    rows = latest_per_key(i.profiles(spark, sf_dir), ["id"], EXTRACTED)
    return rows.select(
        F.col("id").alias("profile_id"), *[to_double(texts[_ANALYTICS + n]).alias(n) for n in names]
    )


@query("json_cast_bigint", f"{with_(i.PROFILES_SQL)}\nSELECT profile_id, historic_orders FROM profiles_latest")
def json_cast_bigint(spark, sf_dir):
    """Integers from text with a fraction, rounded."""
    rows = latest_per_key(i.profiles(spark, sf_dir), ["id"], EXTRACTED)
    text = json_text(F.col("attributes"), _ANALYTICS + "historic_number_of_orders")
    return rows.select(F.col("id").alias("profile_id"), to_bigint(text).alias("historic_orders"))


@query(
    "cast_decimal",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(10,2)) AS quantity,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_discount AS DECIMAL(10,2)) AS discount FROM lineitem""",
)
def cast_decimal(spark, sf_dir):
    return i.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        to_money(F.col("l_quantity")).alias("quantity"),
        to_money(F.col("l_extendedprice")).alias("price"),
        to_money(F.col("l_discount")).alias("discount"),
    )


@query(
    "coalesce_zero",
    f"{with_(i.ORDERS_SQL)}\nSELECT order_id, v, coalesce(discounts, 0) AS discounts FROM orders_raw",
)
def coalesce_zero(spark, sf_dir):
    discounts = F.coalesce(to_money(F.col("total_discounts")), F.lit(0).cast("decimal(10,2)"))
    return i.orders(spark, sf_dir).select(F.col("id").alias("order_id"), "v", discounts.alias("discounts"))


@query(
    "greatest_version",
    f"""{with_(i.ORDERS_SQL)}
SELECT order_id, v, greatest(order_updated_at, cancelled_at, {EXTRACTED}) AS newest FROM orders_raw""",
)
def greatest_version(spark, sf_dir):
    newest = F.greatest("updated_at", "cancelled_at", EXTRACTED)
    return i.orders(spark, sf_dir).select(F.col("id").alias("order_id"), "v", newest.alias("newest"))


@query(
    "explode_tags",
    f"""{with_(i.ERP_ORDERS_SQL)}
SELECT order_id, v, tag FROM (
    SELECT order_id, v, unnest(from_json(tags, '["VARCHAR"]')) AS tag FROM erp_raw
    WHERE {i.HAS_TAGS})
WHERE tag IS NOT NULL AND tag <> ''""",
)
def explode_tags(spark, sf_dir):
    rows = i.erp_orders(spark, sf_dir).filter(filled_array_text(F.col("tags")))
    return explode_text_array(rows.select(F.col("id").alias("order_id"), "v", "tags"), "tags", "tag")


def _order_paths(spark, sf_dir):
    """A landing path per order version, month and day not padded; every seventh has no date."""
    parts = [
        F.lit("raw/orders/year="), F.col("year").cast("string"), F.lit("/month="), F.col("month").cast("string"),
        F.lit("/day="), F.col("day").cast("string"), F.lit("/part_"), F.col("id").cast("string"), F.lit(".parquet"),
    ]
    bare = F.concat(F.lit("raw/orders/part_"), F.col("id").cast("string"), F.lit(".parquet"))
    path = F.when(F.col("id") % 7 == 0, bare).otherwise(F.concat(*parts))
    return i.orders(spark, sf_dir).select(F.col("id").alias("order_id"), "v", path.alias("path"))


@query(
    "parse_partition_date",
    f"""{with_(i.ORDERS_SQL)}
SELECT order_id, v, CASE WHEN order_id % 7 <> 0 THEN CAST({EXTRACTED} AS DATE) END AS partition_date FROM orders_raw""",
)
def parse_partition_date(spark, sf_dir):
    return _order_paths(spark, sf_dir).select("order_id", "v", partition_date(F.col("path")).alias("partition_date"))


@query(
    "path_date_label",
    f"""{with_(i.ORDERS_SQL)}
SELECT order_id, v, CASE WHEN order_id % 7 <> 0 THEN strftime({EXTRACTED}, '%Y-%m-%d')
    ELSE 'part_' || order_id || '.parquet' END AS label FROM orders_raw""",
)
def path_date_label(spark, sf_dir):
    return _order_paths(spark, sf_dir).select("order_id", "v", date_label(F.col("path")).alias("label"))


@query(
    "json_quarantine",
    """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'quarantined' ELSE 'good' END AS status,
    CASE WHEN event_id % 10 = 0 THEN '{"k": ' ELSE props END AS payload FROM events""",
)
def json_quarantine(spark, sf_dir):
    """Good rows and set-aside rows together; every tenth payload is cut off."""
    broken = F.when(F.col("event_id") % 10 == 0, F.lit('{"k": ')).otherwise(F.col("props"))
    rows = i.table(spark, sf_dir, "events").select("event_id", broken.alias("payload"))
    good, bad = split_malformed(rows, ["payload"])
    return good.withColumn("status", F.lit("good")).unionByName(bad.withColumn("status", F.lit("quarantined")))


@query("flatten_order_items", f"{with_(i.PAGES_SQL)}\nSELECT * FROM page_items")
def flatten_items(spark, sf_dir):
    pages = i.order_pages(spark, sf_dir)
    return flatten_order_items(pages, carry=[LOAD, "_dlt_id", "year", "month", "day"])
