"""The processed models and the sales fact."""

from __future__ import annotations

from millrace.catalogue import inputs as i
from millrace.catalogue.registry import query, with_
from millrace.operators.dedupe import SOURCE_FILE, SOURCE_ROW
from millrace.operators.flatten import flatten_order_items
from millrace.plans import enriched, processed
from millrace.plans.processed import EXTRACTED, LOAD

DATED = "year, month, day"


def _columns(model_outs: str, version: str) -> str:
    meta = EXTRACTED if version == EXTRACTED else f"{LOAD}, _dlt_id"
    return f"{model_outs}, {meta}, {DATED}"


def _register(key, model, rows, ctes, relation, columns):
    @query(key, f"{with_(ctes)}\nSELECT {_columns(columns, model.version)} FROM {relation}")
    def run(spark, sf_dir):
        return model(rows(spark, sf_dir)).drop(SOURCE_FILE)


def _register_all():
    _register(
        "model_orders", processed.ORDERS, i.orders, i.ORDERS_SQL, "orders_latest",
        "order_id, customer_id, order_date, order_updated_at, cancelled_at, is_test_order, financial_status, "
        "fulfillment_status, cancel_reason, gross_sales, discounts, shipping, taxes",
    )
    _register(
        "model_customers", processed.CUSTOMERS, i.customers, i.CUSTOMERS_SQL, "customers_latest",
        "customer_id, email, first_name, last_name, customer_created_at, customer_updated_at, orders_count, "
        "total_spent, tags, customer_state",
    )
    _register(
        "model_profiles", processed.PROFILES, i.profiles, i.PROFILES_SQL, "profiles_latest",
        "profile_id, created_at, updated_at, email, phone_number, first_name, last_name, city, region, country, "
        "postal_code, last_event_date, total_clv, historic_clv, predicted_clv, churn_probability, "
        "average_order_value, historic_orders",
    )
    _register(
        "model_events", processed.EVENTS, i.events, i.EVENTS_SQL, "events_latest",
        "event_id, profile_id, metric_id, event_datetime, event_timestamp, event_uuid, properties",
    )
    _register(
        "model_campaigns", processed.CAMPAIGNS, i.campaigns, i.CAMPAIGNS_SQL, "campaigns_latest",
        "campaign_id, campaign_name, status, channel, is_archived, created_at, updated_at, scheduled_at, send_time",
    )
    _register(
        "model_flows", processed.FLOWS, i.flows, i.FLOWS_SQL, "flows_latest",
        "flow_id, flow_name, status, trigger_type, is_archived, created_at, updated_at",
    )
    _register(
        "model_lists", processed.LISTS, i.lists, i.LISTS_SQL, "lists_latest",
        "list_id, list_name, opt_in_process, created_at, updated_at",
    )
    _register(
        "model_metrics", processed.METRICS, i.metrics, i.METRICS_SQL, "metrics_latest",
        "metric_id, metric_name, created_at, updated_at",
    )
    _register(
        "model_erp_orders", processed.ERP_ORDERS, i.erp_orders, i.ERP_ORDERS_SQL, "erp_latest",
        "order_id, order_reference, external_order_id, customer, order_created_at, order_updated_at, sales_date, "
        "order_date, delivery_date, status, invoice_status, delivery_status, amount_untaxed, amount_tax, "
        "amount_total, sales_team, salesperson, payment_terms, shipping_policy, delivery_country, delivery_state, "
        "delivery_city, delivery_zip",
    )
    _register(
        "model_erp_order_lines", processed.ERP_ORDER_LINES, i.erp_order_lines, i.LINES_SQL, "lines_latest",
        "line_id, order_reference, sku, product_category, quantity, unit_price, unit_cost, subtotal, sales_team, "
        "salesperson, line_updated_at, sales_date",
    )


_register_all()


@query(
    "model_order_refunds",
    f"{with_(i.REFUNDS_SQL)}\nSELECT order_id, returns, {EXTRACTED}, {DATED} FROM refund_sums",
)
def model_order_refunds(spark, sf_dir):
    sums = processed.ORDER_REFUNDS(i.refunds(spark, sf_dir))
    return sums.withColumn("returns", sums["returns"].cast("decimal(18,2)"))


@query("model_order_tags", f"{with_(i.ERP_ORDERS_SQL)}\nSELECT order_id, tag, {LOAD} FROM order_tags")
def model_order_tags(spark, sf_dir):
    return processed.ORDER_TAGS(i.erp_orders(spark, sf_dir))


@query(
    "model_wholesale_lines",
    f"""{with_(i.PAGES_SQL)}
SELECT id AS line_id, order_id, product_id, variant_id, sku, quantity, price_amount_minor, price_currency,
    state AS line_state, includes_tester, order_state, order_created_at, order_updated_at, retailer_name,
    retailer_city, retailer_state, retailer_country, created_at AS line_created_at, updated_at AS line_updated_at,
    {LOAD}, _dlt_id, {DATED}
FROM page_items QUALIFY row_number() OVER (PARTITION BY id ORDER BY {LOAD} DESC) = 1""",
)
def model_wholesale_lines(spark, sf_dir):
    pages = i.order_pages(spark, sf_dir)
    return processed.WHOLESALE_LINES(flatten_order_items(pages, carry=[LOAD, "_dlt_id", "year", "month", "day", SOURCE_ROW]))


def sales_facts(spark, sf_dir):
    """The sales fact over all orders and refunds."""
    orders = processed.ORDERS(i.orders(spark, sf_dir))
    refunds = processed.ORDER_REFUNDS(i.refunds(spark, sf_dir))
    return enriched.sales(orders, refunds)


query("fct_sales", f"{with_(i.SALES_SQL)}\nSELECT * FROM sales")(sales_facts)
