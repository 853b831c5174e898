"""Landing rows for every stream, derived from the given tables.

Each function returns a stream's landing rows: nested objects as JSON text, the loader's
version column, and year, month, day. Records come in up to three versions. Beside each
stands the same data as flat SQL, for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedupe import SOURCE_ROW
from millrace.plans.processed import EXTRACTED, LOAD
from millrace.session import work_dir
from millrace.sources.landing import append_landing, with_partition_columns


#: Bytes of files that a task reads: rows of the given tables take up few of them, landing rows are
#: some ten times as wide and are sorted by key in the task that makes them.
READ_BYTES = "16m"


def table(spark: SparkSession, sf_dir: str, name: str, positions: bool = False) -> DataFrame:
    """A given table, with the position of each row if wanted, as landing rows have it."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", READ_BYTES)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumn(SOURCE_ROW, F.col("_metadata.row_index")) if positions else df


def _versions(df: DataFrame, key: str) -> DataFrame:
    """Every third record has a second version, every ninth a third one."""
    last = F.lit(1) + (F.col(key) % 3 == 0).cast("int") + (F.col(key) % 9 == 0).cast("int")
    return df.withColumn("v", F.explode(F.sequence(F.lit(1), last)))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a small file, which one task may read whole, over many tasks before they get their payloads."""
    return df.repartition(key)


#: Hash buckets of the keyed tables of queries: the given tables are small.
BUCKETS = 8
VERSIONS = "(VALUES (1), (2), (3)) AS versions(v)"


def _has_version(key: str) -> str:
    return f"v <= 1 + CAST({key} % 3 = 0 AS INT) + CAST({key} % 9 = 0 AS INT)"


def _after(start: str, days: str, seconds: str = "0", micros: str = "0") -> Column:
    """A zone-less timestamp some days, seconds and microseconds after a start."""
    total = f"(cast({days} as bigint) * 86400 + {seconds}) * 1000000 + {micros}"
    return F.expr(f"timestampadd(MICROSECOND, cast({total} as bigint), timestamp_ntz'{start}')")


def _after_sql(start: str, days: str, seconds: str = "0", micros: str = "0") -> str:
    return (
        f"TIMESTAMP '{start}' + to_days(CAST({days} AS INT)) + to_seconds(CAST({seconds} AS BIGINT))"
        f" + to_microseconds(CAST({micros} AS BIGINT))"
    )


def _dated_sql(column: str = EXTRACTED) -> str:
    return (
        f"CAST(year({column}) AS INT) AS year, CAST(month({column}) AS INT) AS month, "
        f"CAST(day({column}) AS INT) AS day"
    )


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _day_text(key: str) -> Column:
    return F.concat(F.lit("2024-01-"), F.lpad((F.col(key) % 28 + 1).cast("string"), 2, "0"), F.lit("T08:00:00Z"))


def _day_text_sql(key: str) -> str:
    return f"'2024-01-' || lpad(CAST({key} % 28 + 1 AS VARCHAR), 2, '0') || 'T08:00:00Z'"


# -- store: orders, refunds, customers ---------------------------------------------------


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _versions(table(spark, sf_dir, "orders", positions=True), "o_orderkey")
    status = F.when(F.col("v") > 1, "refunded").otherwise(
        F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "pending").otherwise("authorized")
    )
    shipping = F.concat(
        F.lit('{"shop_money":{"amount":"'),
        (F.col("o_orderkey") % 23).cast("string"),
        F.lit('.50","currency_code":"EUR"},"presentment_money":{"amount":"0.00"}}'),
    )
    cancelled = F.col("o_orderkey") % 20 == 0
    df = rows.select(
        F.col("o_orderkey").alias("id"),
        "v",
        SOURCE_ROW,
        _json(id=F.col("o_custkey"), note=F.col("o_orderpriority")).alias("customer"),
        F.col("o_orderdate").alias("created_at"),
        F.expr("o_orderdate + make_dt_interval(v)").alias("updated_at"),
        F.when(cancelled, F.expr("o_orderdate + make_dt_interval(1)")).alias("cancelled_at"),
        (F.col("o_orderkey") % 50 == 0).alias("test"),
        status.alias("financial_status"),
        F.when(F.col("o_orderstatus") == "F", "fulfilled").alias("fulfillment_status"),
        F.when(cancelled, "customer").alias("cancel_reason"),
        F.col("o_totalprice").alias("total_line_items_price"),
        F.when(F.col("o_orderkey") % 41 != 0, F.col("o_orderkey") % 97 + F.col("v") - 0.75).cast("double").alias("total_discounts"),
        F.when(F.col("o_orderkey") % 31 != 0, shipping).alias("total_shipping_price_set"),
        (F.col("o_orderkey") % 13).cast("double").alias("total_tax"),
        _after("2024-01-01 00:00:00", "o_orderkey % 28 + 28 * (v - 1)", "(o_orderkey % 1440) * 60").alias(EXTRACTED),
    )
    return with_partition_columns(df, EXTRACTED)


ORDERS_SQL = (
    f"""orders_raw AS (
    SELECT *, {_dated_sql()} FROM (
        SELECT o_orderkey AS order_id, v, o_custkey AS customer_id,
            o_orderdate AS order_date, o_orderdate + to_days(v) AS order_updated_at,
            CASE WHEN o_orderkey % 20 = 0 THEN o_orderdate + to_days(1) END AS cancelled_at,
            o_orderkey % 50 = 0 AS is_test_order,
            CASE WHEN v > 1 THEN 'refunded' WHEN o_orderstatus = 'F' THEN 'paid'
                 WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'authorized' END AS financial_status,
            CASE WHEN o_orderstatus = 'F' THEN 'fulfilled' END AS fulfillment_status,
            CASE WHEN o_orderkey % 20 = 0 THEN 'customer' END AS cancel_reason,
            CAST(o_totalprice AS DECIMAL(10,2)) AS gross_sales,
            CASE WHEN o_orderkey % 41 <> 0
                 THEN CAST(o_orderkey % 97 + v - 1 AS DECIMAL(10,2)) + CAST(0.25 AS DECIMAL(10,2)) END AS discounts,
            CASE WHEN o_orderkey % 31 <> 0
                 THEN CAST(o_orderkey % 23 AS DECIMAL(10,2)) + CAST(0.50 AS DECIMAL(10,2)) END AS shipping,
            CAST(o_orderkey % 13 AS DECIMAL(10,2)) AS taxes,
            {_after_sql("2024-01-01", "o_orderkey % 28 + 28 * (v - 1)", "(o_orderkey % 1440) * 60")} AS {EXTRACTED}
        FROM orders, {VERSIONS} WHERE {_has_version("o_orderkey")}
    ))""",
    f"""orders_latest AS (
    SELECT * FROM orders_raw
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {EXTRACTED} DESC) = 1)""",
)


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refunds of returned order lines; refund ids repeat, some have no transactions."""
    rows = table(spark, sf_dir, "lineitem", positions=True).filter(F.col("l_returnflag") == "R")
    amount = F.col("l_extendedprice").cast("decimal(10,2)").cast("string")
    transactions = F.array(
        F.concat(F.lit('{"amount":"'), amount, F.lit('","test":false}')), F.lit('{"amount":"1.00"}'), F.lit("{}")
    )
    slot = F.col("l_linenumber") % 7
    df = rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        SOURCE_ROW,
        F.col("l_shipdate").alias("created_at"),
        F.when(slot == 6, F.array().cast("array<string>")).when(slot != 0, transactions).alias("transactions"),
        _after(
            "2024-01-10 00:00:00",
            "l_partkey % 28",
            "l_suppkey % 86400",
            "(cast(l_extendedprice as decimal(12,2)) * 100) % 1000000",
        ).alias(EXTRACTED),
    )
    return with_partition_columns(df, EXTRACTED)


REFUNDS_SQL = (
    f"""refunds_raw AS (
    SELECT *, {_dated_sql()} FROM (
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_linenumber % 7 AS slot,
            CAST(l_extendedprice AS DECIMAL(10,2)) AS amount,
            {_after_sql(
                "2024-01-10", "l_partkey % 28", "l_suppkey % 86400",
                "(CAST(l_extendedprice AS DECIMAL(12,2)) * 100) % 1000000")} AS {EXTRACTED}
        FROM lineitem WHERE l_returnflag = 'R'
    ))""",
    f"""refunds_latest AS (
    SELECT * FROM refunds_raw
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY {EXTRACTED} DESC) = 1)""",
    f"""refund_sums AS (
    SELECT order_id, CAST(sum(amount + 1.00) AS DECIMAL(18,2)) AS returns, max({EXTRACTED}) AS {EXTRACTED},
        max(year) AS year, max(month) AS month, max(day) AS day
    FROM refunds_latest WHERE slot NOT IN (0, 6) GROUP BY order_id)""",
)


def sales_sql(orders: str, condition: str = "true") -> str:
    """Sales per order: what was refunded counts against gross sales, the total builds on net sales.
    ``condition`` may use ``sold_at`` and ``refunded_at``, the versions of both sides."""
    return f"""SELECT order_id, order_date, cancelled_at, is_test_order, financial_status, fulfillment_status, cancel_reason,
        gross_sales, discounts, refunded AS returns, net AS net_sales, shipping, taxes,
        CAST(net + shipping + taxes AS DECIMAL(18,2)) AS total_sales,
        CASE WHEN refunded_at > sold_at THEN refunded_at ELSE sold_at END AS {EXTRACTED}
    FROM (
        SELECT *, CAST(gross_sales - discounts - refunded AS DECIMAL(18,2)) AS net
        FROM (
            SELECT sold.*, sold.{EXTRACTED} AS sold_at, back.{EXTRACTED} AS refunded_at,
                CAST(coalesce(back.returns, 0) AS DECIMAL(18,2)) AS refunded
            FROM {orders} AS sold LEFT JOIN refund_sums AS back ON back.order_id = sold.order_id))
    WHERE {condition}"""


SALES_SQL = (*ORDERS_SQL, *REFUNDS_SQL, f"sales AS ({sales_sql('orders_latest')})")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.split("c_name", "#")
    df = _versions(spread(table(spark, sf_dir, "customer", positions=True), "c_custkey"), "c_custkey").select(
        F.col("c_custkey").alias("id"),
        SOURCE_ROW,
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        name[0].alias("first_name"),
        name[1].alias("last_name"),
        _after("2020-01-01 00:00:00", "c_custkey % 1000").alias("created_at"),
        _after("2023-01-01 00:00:00", "v").alias("updated_at"),
        (F.col("c_custkey") % 17 + F.col("v")).alias("orders_count"),
        F.col("c_acctbal").alias("total_spent"),
        F.col("c_mktsegment").alias("tags"),
        F.when(F.col("v") > 1, "disabled").otherwise("enabled").alias("state"),
        _after("2024-02-01 00:00:00", "c_custkey % 20 + 20 * (v - 1)").alias(EXTRACTED),
    )
    return with_partition_columns(df, EXTRACTED)


CUSTOMERS_SQL = (
    f"""customers_latest AS (
    SELECT *, {_dated_sql()} FROM (
        SELECT c_custkey AS customer_id, 'c' || c_custkey || '@example.com' AS email,
            split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
            {_after_sql("2020-01-01", "c_custkey % 1000")} AS customer_created_at,
            {_after_sql("2023-01-01", "v")} AS customer_updated_at,
            c_custkey % 17 + v AS orders_count, CAST(c_acctbal AS DECIMAL(10,2)) AS total_spent,
            c_mktsegment AS tags, CASE WHEN v > 1 THEN 'disabled' ELSE 'enabled' END AS customer_state,
            {_after_sql("2024-02-01", "c_custkey % 20 + 20 * (v - 1)")} AS {EXTRACTED}
        FROM customer, {VERSIONS} WHERE {_has_version("c_custkey")})
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY {EXTRACTED} DESC) = 1)""",
)


# -- marketing: profiles, events, campaigns, flows, lists, metrics ------------------------


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    everyone = spread(table(spark, sf_dir, "customer", positions=True), "c_custkey")
    people = everyone.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))  # never the other way: one task would hold all
    key = F.col("c_custkey")
    location = F.struct(
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("country"),
        F.lpad(key.cast("string"), 10, "0").alias("zip"),
    )
    analytics = F.struct(
        F.col("c_acctbal").alias("total_clv"),
        F.col("c_acctbal").alias("historic_clv"),
        (key % 100).cast("double").alias("predicted_clv"),
        F.lit(0.25).alias("churn_probability"),
        F.concat((key % 50).cast("string"), F.lit(".5")).alias("average_order_value"),
        F.concat((key % 40).cast("string"), F.lit(".7")).alias("historic_number_of_orders"),
    )
    attributes = _json(
        created=_day_text("c_custkey"),
        updated=F.concat(F.lit("v"), F.col("v").cast("string")),
        email=F.concat(F.lit("p"), key.cast("string"), F.lit("@example.com")),
        phone_number=F.when(key % 4 != 0, F.concat(F.lit("+49"), key.cast("string"))),
        first_name=F.split("c_name", "#")[0],
        last_name=F.split("c_name", "#")[1],
        location=F.when(key % 6 != 0, location),
        last_event_date=_day_text("c_custkey"),
        predictive_analytics=analytics,
    )
    df = _versions(people, "c_custkey").select(
        F.concat(F.lit("prf-"), key.cast("string")).alias("id"),
        SOURCE_ROW,
        attributes.alias("attributes"),
        _after("2024-02-01 00:00:00", "c_custkey % 20 + 20 * (v - 1)").alias(EXTRACTED),
    )
    return with_partition_columns(df, EXTRACTED)


PROFILES_SQL = (
    f"""profiles_latest AS (
    SELECT *, {_dated_sql()} FROM (
        SELECT 'prf-' || c_custkey AS profile_id, {_day_text_sql("c_custkey")} AS created_at, 'v' || v AS updated_at,
            'p' || c_custkey || '@example.com' AS email,
            CASE WHEN c_custkey % 4 <> 0 THEN '+49' || c_custkey END AS phone_number,
            split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
            CASE WHEN c_custkey % 6 <> 0 THEN n_name END AS city,
            CASE WHEN c_custkey % 6 <> 0 THEN r_name END AS region,
            CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS country,
            CASE WHEN c_custkey % 6 <> 0 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS postal_code,
            {_day_text_sql("c_custkey")} AS last_event_date,
            c_acctbal AS total_clv, c_acctbal AS historic_clv, CAST(c_custkey % 100 AS DOUBLE) AS predicted_clv,
            CAST(0.25 AS DOUBLE) AS churn_probability, c_custkey % 50 + CAST(0.5 AS DOUBLE) AS average_order_value,
            c_custkey % 40 + 1 AS historic_orders,
            {_after_sql("2024-02-01", "c_custkey % 20 + 20 * (v - 1)")} AS {EXTRACTED}
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey, {VERSIONS}
        WHERE {_has_version("c_custkey")})
    QUALIFY row_number() OVER (PARTITION BY profile_id ORDER BY {EXTRACTED} DESC) = 1)""",
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = F.concat(
        F.lit('{"uuid":"u-'), F.col("event_id").cast("string"), F.lit("-"), F.col("v").cast("string"),
        F.lit('","timestamp":'), (F.col("event_id") + 1704067200).cast("string"),
        F.lit(',"event_properties":'), F.col("props"), F.lit("}"),
    )
    relationships = _json(
        metric=F.struct(F.struct(F.col("event_type").alias("id")).alias("data")),
        profile=F.struct(F.struct(F.col("user_id").cast("string").alias("id")).alias("data")),
    )
    df = _versions(table(spark, sf_dir, "events", positions=True), "event_id").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("datetime"),
        SOURCE_ROW,
        attributes.alias("attributes"),
        relationships.alias("relationships"),
        F.expr("ts + make_dt_interval(v - 1, 1)").alias(EXTRACTED),
    )
    return with_partition_columns(df, EXTRACTED)


EVENTS_SQL = (
    f"""events_raw AS (
    SELECT *, {_dated_sql()} FROM (
        SELECT CAST(event_id AS VARCHAR) AS event_id, v, CAST(user_id AS VARCHAR) AS profile_id,
            event_type AS metric_id, ts AS event_datetime,
            CAST(event_id + 1704067200 AS VARCHAR) AS event_timestamp,
            'u-' || event_id || '-' || v AS event_uuid, CAST(json(props) AS VARCHAR) AS properties,
            ts + to_days(v - 1) + to_hours(1) AS {EXTRACTED}
        FROM events, {VERSIONS} WHERE {_has_version("event_id")}))""",
    f"""events_latest AS (
    SELECT * FROM events_raw
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY {EXTRACTED} DESC) = 1)""",
)


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    attributes = _json(
        name=F.col("p_name"),
        status=F.col("p_brand"),
        channel=F.col("p_type"),
        archived=key % 2 == 0,
        created_at=_day_text("p_partkey"),
        updated_at=F.concat(F.lit("v"), F.col("v").cast("string")),
        scheduled_at=F.when(key % 3 != 0, _day_text("p_partkey")),
        audiences=F.struct(F.array(F.col("p_brand")).alias("included")),
    )
    df = _versions(spread(table(spark, sf_dir, "part", positions=True), "p_partkey"), "p_partkey").select(
        F.concat(F.lit("cmp-"), key.cast("string")).alias("id"),
        SOURCE_ROW,
        attributes.alias("attributes"),
        _after("2024-02-01 00:00:00", "p_partkey % 20 + 20 * (v - 1)").alias(EXTRACTED),
    )
    return with_partition_columns(df, EXTRACTED)


CAMPAIGNS_SQL = (
    f"""campaigns_raw AS (
    SELECT *, {_dated_sql()} FROM (
        SELECT 'cmp-' || p_partkey AS campaign_id, v, p_name AS campaign_name, p_brand AS status, p_type AS channel,
            p_partkey % 2 = 0 AS is_archived, {_day_text_sql("p_partkey")} AS created_at, 'v' || v AS updated_at,
            CASE WHEN p_partkey % 3 <> 0 THEN {_day_text_sql("p_partkey")} END AS scheduled_at,
            CAST(NULL AS VARCHAR) AS send_time,
            {_after_sql("2024-02-01", "p_partkey % 20 + 20 * (v - 1)")} AS {EXTRACTED}
        FROM part, {VERSIONS} WHERE {_has_version("p_partkey")}))""",
    f"""campaigns_latest AS (
    SELECT * FROM campaigns_raw
    QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY {EXTRACTED} DESC) = 1)""",
)


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = _json(
        name=F.col("s_name"),
        status=F.when(F.col("v") > 1, "live").otherwise("draft"),
        trigger_type=F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")),
        archived=F.col("s_suppkey") % 2 == 0,
        created=_day_text("s_suppkey"),
        updated=F.concat(F.lit("v"), F.col("v").cast("string")),
    )
    df = _versions(spread(table(spark, sf_dir, "supplier", positions=True), "s_suppkey"), "s_suppkey").select(
        F.concat(F.lit("flw-"), F.col("s_suppkey").cast("string")).alias("id"),
        SOURCE_ROW,
        attributes.alias("attributes"),
        _after("2024-02-01 00:00:00", "s_suppkey % 20 + 20 * (v - 1)").alias(EXTRACTED),
    )
    return with_partition_columns(df, EXTRACTED)


FLOWS_SQL = (
    f"""flows_latest AS (
    SELECT *, {_dated_sql()} FROM (
        SELECT 'flw-' || s_suppkey AS flow_id, s_name AS flow_name,
            CASE WHEN v > 1 THEN 'live' ELSE 'draft' END AS status, 'nation ' || s_nationkey AS trigger_type,
            s_suppkey % 2 = 0 AS is_archived, {_day_text_sql("s_suppkey")} AS created_at, 'v' || v AS updated_at,
            {_after_sql("2024-02-01", "s_suppkey % 20 + 20 * (v - 1)")} AS {EXTRACTED}
        FROM supplier, {VERSIONS} WHERE {_has_version("s_suppkey")})
    QUALIFY row_number() OVER (PARTITION BY flow_id ORDER BY {EXTRACTED} DESC) = 1)""",
)


def lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = _json(
        name=F.concat("c_mktsegment", F.lit(" "), "c_name"),
        opt_in_process=F.when(F.col("c_custkey") % 2 == 0, "single_opt_in").otherwise("double_opt_in"),
        created=_day_text("c_custkey"),
        updated=F.concat(F.lit("v"), F.col("v").cast("string")),
    )
    df = _versions(spread(table(spark, sf_dir, "customer", positions=True), "c_custkey"), "c_custkey").select(
        F.concat(F.lit("lst-"), F.col("c_custkey").cast("string")).alias("id"),
        SOURCE_ROW,
        attributes.alias("attributes"),
        _after("2024-02-01 00:00:00", "c_custkey % 20 + 20 * (v - 1)").alias(EXTRACTED),
    )
    return with_partition_columns(df, EXTRACTED)


LISTS_SQL = (
    f"""lists_latest AS (
    SELECT *, {_dated_sql()} FROM (
        SELECT 'lst-' || c_custkey AS list_id, c_mktsegment || ' ' || c_name AS list_name,
            CASE WHEN c_custkey % 2 = 0 THEN 'single_opt_in' ELSE 'double_opt_in' END AS opt_in_process,
            {_day_text_sql("c_custkey")} AS created_at, 'v' || v AS updated_at,
            {_after_sql("2024-02-01", "c_custkey % 20 + 20 * (v - 1)")} AS {EXTRACTED}
        FROM customer, {VERSIONS} WHERE {_has_version("c_custkey")})
    QUALIFY row_number() OVER (PARTITION BY list_id ORDER BY {EXTRACTED} DESC) = 1)""",
)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", positions=True).select("doc_id", "lang", "source", SOURCE_ROW)
    attributes = _json(
        name=F.concat("source", F.lit("/"), "lang"),
        created=_day_text("doc_id"),
        updated=F.concat(F.lit("v"), F.col("v").cast("string")),
        integration=F.struct(F.col("source").alias("name")),
    )
    df = _versions(documents, "doc_id").select(
        F.concat(F.lit("mtr-"), F.col("doc_id").cast("string")).alias("id"),
        SOURCE_ROW,
        attributes.alias("attributes"),
        _after("2024-02-01 00:00:00", "doc_id % 20 + 20 * (v - 1)").alias(EXTRACTED),
    )
    return with_partition_columns(df, EXTRACTED)


METRICS_SQL = (
    f"""metrics_latest AS (
    SELECT *, {_dated_sql()} FROM (
        SELECT 'mtr-' || doc_id AS metric_id, source || '/' || lang AS metric_name,
            {_day_text_sql("doc_id")} AS created_at, 'v' || v AS updated_at,
            {_after_sql("2024-02-01", "doc_id % 20 + 20 * (v - 1)")} AS {EXTRACTED}
        FROM documents, {VERSIONS} WHERE {_has_version("doc_id")})
    QUALIFY row_number() OVER (PARTITION BY metric_id ORDER BY {EXTRACTED} DESC) = 1)""",
)


# -- ERP: orders with tags, order lines ----------------------------------------------------


def _tags_sql(key: str, status: str, priority: str) -> str:
    """Tags as JSON text; the expression reads the same in both dialects."""
    return f"""CASE WHEN ({key} + v) % 7 = 0 THEN NULL
        WHEN ({key} + v) % 11 = 0 THEN '[]'
        WHEN ({key} + v) % 13 = 0 THEN ''
        WHEN ({key} + v) % 17 = 0 THEN concat('["', {status}, '",null,""]')
        WHEN ({key} + v) % 19 = 0 THEN '["twice","twice"]'
        ELSE concat('["', {priority}, '","', {status}, '","v', CAST(v AS STRING), '"]') END"""


def erp_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    df = _versions(table(spark, sf_dir, "orders", positions=True), "o_orderkey").select(
        key.alias("id"),
        "v",
        SOURCE_ROW,
        F.concat(F.lit("S"), F.lpad(key.cast("string"), 12, "0")).alias("order_reference"),
        F.expr("o_orderdate").alias("create_date"),
        F.expr("o_orderdate + make_dt_interval(v)").alias("write_date"),
        F.expr("o_orderdate + make_dt_interval(2)").alias("sales_date"),
        F.col("o_orderdate").alias("order_date"),
        F.when(key % 5 != 0, F.expr("o_orderdate + make_dt_interval(7)")).alias("delivery_date"),
        F.concat(F.lit("team "), (key % 5).cast("string")).alias("sales_team"),
        F.concat(F.lit("person "), (key % 50).cast("string")).alias("salesperson"),
        F.col("o_totalprice").alias("amount_untaxed"),
        (key % 13 + 0.5).cast("double").alias("amount_tax"),
        (key % 1000 + F.col("v")).cast("double").alias("amount_total"),
        F.lit("30 days").alias("payment_terms"),
        F.expr(_tags_sql("o_orderkey", "o_orderstatus", "o_orderpriority")).alias("tags"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("v") > 1, "invoiced").otherwise("to invoice").alias("invoice_status"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderpriority").alias("shipping_policy"),
        F.concat(F.lit("X"), key.cast("string")).alias("f_order_id"),
        F.when(key % 5 != 0, "full").alias("delivery_status"),
        F.lit("DE").alias("delivery_country"),
        F.concat(F.lit("state "), (key % 16).cast("string")).alias("delivery_state"),
        F.concat(F.lit("city "), (key % 100).cast("string")).alias("delivery_city"),
        F.lpad((key % 100000).cast("string"), 5, "0").alias("delivery_zip"),
        F.concat((F.lit(1704067200) + F.col("v") * 86400).cast("string"), F.lit(".5")).alias(LOAD),
        F.concat(F.lit("d"), key.cast("string"), F.lit("-"), F.col("v").cast("string")).alias("_dlt_id"),
        _after("2024-01-01 00:00:00", "o_orderkey % 14 + 14 * (v - 1)").alias("_at"),
    )
    return with_partition_columns(df, "_at").drop("_at")


#: The texts that hold no tags; NULL is no text.
HAS_TAGS = "tags NOT IN ('', '[]')"


def tags_sql(orders: str, per: str) -> str:
    """Filled tags, one row each, of the last order version that has any, among the rows that share ``per``."""
    return f"""SELECT order_id, tag, {LOAD} FROM (
        SELECT order_id, {LOAD}, unnest(from_json(tags, '["VARCHAR"]')) AS tag FROM (
            SELECT *, max({LOAD}) OVER (PARTITION BY {per}) AS newest FROM {orders}
            WHERE {HAS_TAGS})
        WHERE {LOAD} = newest)
    WHERE length(tag) > 0"""


ERP_ORDERS_SQL = (
    f"""erp_raw AS (
    SELECT * EXCLUDE (_at), {_dated_sql("_at")} FROM (
        SELECT o_orderkey AS order_id, v, 'S' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_reference,
            'X' || o_orderkey AS external_order_id, CAST(o_custkey AS VARCHAR) AS customer,
            o_orderdate AS order_created_at, o_orderdate + to_days(v) AS order_updated_at,
            o_orderdate + to_days(2) AS sales_date, o_orderdate AS order_date,
            CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + to_days(7) END AS delivery_date,
            o_orderstatus AS status, CASE WHEN v > 1 THEN 'invoiced' ELSE 'to invoice' END AS invoice_status,
            CASE WHEN o_orderkey % 5 <> 0 THEN 'full' END AS delivery_status,
            CAST(o_totalprice AS DECIMAL(10,2)) AS amount_untaxed,
            CAST(o_orderkey % 13 AS DECIMAL(10,2)) + CAST(0.5 AS DECIMAL(10,2)) AS amount_tax,
            CAST(o_orderkey % 1000 + v AS DECIMAL(10,2)) AS amount_total,
            'team ' || (o_orderkey % 5) AS sales_team, 'person ' || (o_orderkey % 50) AS salesperson,
            '30 days' AS payment_terms, o_orderpriority AS shipping_policy, 'DE' AS delivery_country,
            'state ' || (o_orderkey % 16) AS delivery_state, 'city ' || (o_orderkey % 100) AS delivery_city,
            lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS delivery_zip,
            {_tags_sql("o_orderkey", "o_orderstatus", "o_orderpriority")} AS tags,
            (1704067200 + v * 86400) || '.5' AS {LOAD}, 'd' || o_orderkey || '-' || v AS _dlt_id,
            {_after_sql("2024-01-01", "o_orderkey % 14 + 14 * (v - 1)")} AS _at
        FROM orders, {VERSIONS} WHERE {_has_version("o_orderkey")}))""",
    f"""erp_latest AS (
    SELECT * FROM erp_raw QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {LOAD} DESC) = 1)""",
    f"order_tags AS ({tags_sql('erp_raw', 'order_id')})",
)


def _line_load(date_text: str, cents: str) -> str:
    return (
        f"concat({date_text}, '.', lpad(cast(l_partkey as string), 12, '0'), "
        f"lpad(cast(l_suppkey as string), 12, '0'), lpad(cast({cents} as string), 14, '0'))"
    )


_CENTS = "cast(cast(l_extendedprice as decimal(12,2)) * 100 as bigint)"


def erp_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; ids repeat, the load id tells the versions apart."""
    line_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    df = table(spark, sf_dir, "lineitem", positions=True).select(
        line_id.alias("id"),
        SOURCE_ROW,
        F.concat(F.lit("S"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0")).alias("order_reference"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.col("l_returnflag").alias("product_category"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_tax").alias("unit_cost"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_linestatus").alias("sales_team"),
        F.concat(F.lit("person "), (F.col("l_suppkey") % 50).cast("string")).alias("salesperson"),
        F.col("l_shipdate").alias("write_date"),
        F.col("l_shipdate").alias("sales_date"),
        F.expr(_line_load("date_format(l_shipdate, 'yyyyMMdd')", _CENTS)).alias(LOAD),
        F.concat(F.lit("d"), line_id.cast("string")).alias("_dlt_id"),
    )
    return with_partition_columns(df, "write_date")


LINES_SQL = (
    f"""lines_latest AS (
    SELECT *, {_dated_sql("line_updated_at")} FROM (
        SELECT l_orderkey * 10 + l_linenumber AS line_id,
            'S' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS order_reference, 'SKU-' || l_partkey AS sku,
            l_returnflag AS product_category, CAST(l_quantity AS DECIMAL(10,2)) AS quantity,
            CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price, CAST(l_tax AS DECIMAL(10,2)) AS unit_cost,
            CAST(l_extendedprice AS DECIMAL(10,2)) AS subtotal, l_linestatus AS sales_team,
            'person ' || (l_suppkey % 50) AS salesperson, l_shipdate AS line_updated_at, l_shipdate AS sales_date,
            {_line_load("strftime(l_shipdate, '%Y%m%d')", _CENTS)} AS {LOAD},
            'd' || (l_orderkey * 10 + l_linenumber) AS _dlt_id
        FROM lineitem)
    QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY {LOAD} DESC) = 1)""",
)


# -- wholesale: order pages ----------------------------------------------------------------


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per order and version, with up to four items; some orders have no
    ``items`` at all, some items no price, some orders no address."""
    key = F.col("o_orderkey")
    size = (key % 5).cast("int")

    def item(i: Column) -> Column:
        price = F.struct(
            ((key * 7 + i) % 10000).alias("amount_minor"),
            F.when(key % 2 == 0, "EUR").otherwise("USD").alias("currency"),
        )
        return F.struct(
            F.concat(F.lit("li-"), key.cast("string"), F.lit("-"), i.cast("string")).alias("id"),
            _day_text("o_orderkey").alias("created_at"),
            F.concat(F.lit("v"), F.col("v").cast("string")).alias("updated_at"),
            F.concat(F.lit("p-"), ((key + i) % 1000).cast("string")).alias("product_id"),
            F.concat(F.lit("pv-"), ((key + i) % 3000).cast("string")).alias("variant_id"),
            ((key + i) % 9 + F.col("v")).alias("quantity"),
            F.concat(F.lit("SKU-"), ((key + i) % 1000).cast("string")).alias("sku"),
            F.lit("mug").alias("product_name"),
            F.lit("blue").alias("variant_name"),
            (i % 2 == 0).alias("includes_tester"),
            F.col("o_orderstatus").alias("state"),
            ((key * 7 + i) % 10000).alias("price_cents"),
            F.when((key + i) % 6 != 0, price).alias("price"),
        )

    address = F.struct(
        F.concat(F.lit("Shop "), F.col("o_custkey").cast("string")).alias("name"),
        F.concat(F.lit("city "), (F.col("o_custkey") % 100).cast("string")).alias("city"),
        F.lit("BE").alias("state"),
        F.lit("DE").alias("country"),
    )
    document = _json(
        id=F.concat(F.lit("bo-"), key.cast("string")),
        created_at=_day_text("o_orderkey"),
        updated_at=F.concat(F.lit("v"), F.col("v").cast("string")),
        state=F.col("o_orderstatus"),
        address=F.when(key % 10 != 0, address),
        items=F.when(size > 0, F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), item)),
    )
    df = _versions(table(spark, sf_dir, "orders", positions=True), "o_orderkey").select(
        document.alias("document"),
        SOURCE_ROW,
        F.concat((F.lit(1704067200) + F.col("v") * 86400).cast("string"), F.lit(".25")).alias(LOAD),
        F.concat(F.lit("d"), F.col("v").cast("string")).alias("_dlt_id"),
        _after("2024-01-01 00:00:00", "o_orderkey % 14 + 14 * (v - 1)").alias("_at"),
    )
    return with_partition_columns(df, "_at").drop("_at")


PAGES_SQL = (
    f"""page_items AS (
    SELECT * EXCLUDE (_at), {_dated_sql("_at")} FROM (
        SELECT 'li-' || o_orderkey || '-' || i AS id, {_day_text_sql("o_orderkey")} AS created_at,
            'v' || v AS updated_at, 'p-' || ((o_orderkey + i) % 1000) AS product_id,
            'pv-' || ((o_orderkey + i) % 3000) AS variant_id, (o_orderkey + i) % 9 + v AS quantity,
            'SKU-' || ((o_orderkey + i) % 1000) AS sku, 'mug' AS product_name, 'blue' AS variant_name,
            i % 2 = 0 AS includes_tester, o_orderstatus AS state, (o_orderkey * 7 + i) % 10000 AS price_cents,
            CASE WHEN (o_orderkey + i) % 6 <> 0 THEN (o_orderkey * 7 + i) % 10000 END AS price_amount_minor,
            CASE WHEN (o_orderkey + i) % 6 <> 0
                 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'EUR' ELSE 'USD' END END AS price_currency,
            'bo-' || o_orderkey AS order_id, {_day_text_sql("o_orderkey")} AS order_created_at,
            'v' || v AS order_updated_at, o_orderstatus AS order_state,
            CASE WHEN o_orderkey % 10 <> 0 THEN 'Shop ' || o_custkey END AS retailer_name,
            CASE WHEN o_orderkey % 10 <> 0 THEN 'city ' || (o_custkey % 100) END AS retailer_city,
            CASE WHEN o_orderkey % 10 <> 0 THEN 'BE' END AS retailer_state,
            CASE WHEN o_orderkey % 10 <> 0 THEN 'DE' END AS retailer_country,
            (1704067200 + v * 86400) || '.25' AS {LOAD}, 'd' || v AS _dlt_id,
            {_after_sql("2024-01-01", "o_orderkey % 14 + 14 * (v - 1)")} AS _at
        FROM orders, {VERSIONS}, generate_series(1, 4) AS items(i)
        WHERE {_has_version("o_orderkey")} AND i <= o_orderkey % 5))""",
)


# -- landing zones ---------------------------------------------------------------------------

_landed: dict[tuple[str, str, str], str] = {}


def landing(
    spark: SparkSession, sf_dir: str, name: str, rows: Callable[[SparkSession, str], DataFrame], load_id: str = "1704067200.1"
) -> str:
    """Root of a landing zone with a stream's rows, written once per session: it is the
    input of the scans and feeders, as a loader would have left it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        root = f"{work_dir(spark, 'landing')}/{name}"
        append_landing(rows(spark, sf_dir).drop(SOURCE_ROW), root, load_id)
        _landed[key] = root
    return _landed[key]
