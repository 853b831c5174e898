"""The processed models: one keyed table per entity, latest version of each record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.payload import json_text, or_raise, payload, to_bigint, to_boolean, to_double, to_money
from millrace.operators.dedupe import SOURCE_FILE, SOURCE_ROW, latest_per_key
from millrace.operators.flatten import explode_text_array, filled_array_text
from millrace.plans.model import Out, ProcessedModel, latest_and_shape

EXTRACTED = "_airbyte_extracted_at"
LOAD = "_dlt_load_id"

# Fixed values from here on: names of tables, streams, columns and payload paths.

_DATED = {"year": "year", "month": "month", "day": "day"}
_FILE = {SOURCE_FILE: SOURCE_FILE}
_SYNCED = {EXTRACTED: EXTRACTED, **_DATED}
_LOADED = {LOAD: LOAD, "_dlt_id": "_dlt_id", **_DATED}


def _model(name: str, source: str, stream: str, key: str, version: str, outs: dict) -> ProcessedModel:
    meta = _SYNCED if version == EXTRACTED else _LOADED
    build = latest_and_shape("id", version, {**_FILE, key: "id", **outs, **meta})
    payloads = dict.fromkeys(o.source for o in outs.values() if isinstance(o, Out) and o.path is not None)
    return ProcessedModel(name, (source, stream), (key,), version, build, tuple(payloads))


def _attribute(path: str, cast=None) -> Out:
    return Out("attributes", path, cast)


def _predicted(path: str, cast=to_double) -> Out:
    return Out("attributes", f"predictive_analytics.{path}", cast)


ORDERS = _model(
    "int_shopify__orders", "shopify", "orders", "order_id", EXTRACTED,
    {
        "customer_id": Out("customer", "id", to_bigint),
        "order_date": "created_at",
        "order_updated_at": "updated_at",
        "cancelled_at": "cancelled_at",
        "is_test_order": "test",
        "financial_status": "financial_status",
        "fulfillment_status": "fulfillment_status",
        "cancel_reason": "cancel_reason",
        "gross_sales": Out("total_line_items_price", cast=to_money),
        "discounts": Out("total_discounts", cast=to_money),
        "shipping": Out("total_shipping_price_set", "shop_money.amount", to_money),
        "taxes": Out("total_tax", cast=to_money),
    },
)

CUSTOMERS = _model(
    "int_shopify__customers", "shopify", "customers", "customer_id", EXTRACTED,
    {
        "email": "email",
        "first_name": "first_name",
        "last_name": "last_name",
        "customer_created_at": "created_at",
        "customer_updated_at": "updated_at",
        "orders_count": "orders_count",
        "total_spent": Out("total_spent", cast=to_money),
        "tags": "tags",
        "customer_state": "state",
    },
)

PROFILES = _model(
    "int_klaviyo__profiles", "klaviyo", "profiles", "profile_id", EXTRACTED,
    {
        "created_at": _attribute("created"),
        "updated_at": _attribute("updated"),
        "email": _attribute("email"),
        "phone_number": _attribute("phone_number"),
        "first_name": _attribute("first_name"),
        "last_name": _attribute("last_name"),
        "city": _attribute("location.city"),
        "region": _attribute("location.region"),
        "country": _attribute("location.country"),
        "postal_code": _attribute("location.zip"),
        "last_event_date": _attribute("last_event_date"),
        "total_clv": _predicted("total_clv"),
        "historic_clv": _predicted("historic_clv"),
        "predicted_clv": _predicted("predicted_clv"),
        "churn_probability": _predicted("churn_probability"),
        "average_order_value": _predicted("average_order_value"),
        "historic_orders": _predicted("historic_number_of_orders", to_bigint),
    },
)

EVENTS = _model(
    "int_klaviyo__events", "klaviyo", "events", "event_id", EXTRACTED,
    {
        "profile_id": Out("relationships", "profile.data.id"),
        "metric_id": Out("relationships", "metric.data.id"),
        "event_datetime": "datetime",
        "event_timestamp": _attribute("timestamp"),
        "event_uuid": _attribute("uuid"),
        "properties": Out("attributes", "event_properties", raw=True),
    },
)

CAMPAIGNS = _model(
    "int_klaviyo__campaigns", "klaviyo", "campaigns", "campaign_id", EXTRACTED,
    {
        "campaign_name": _attribute("name"),
        "status": _attribute("status"),
        "channel": _attribute("channel"),
        "is_archived": _attribute("archived", to_boolean),
        "created_at": _attribute("created_at"),
        "updated_at": _attribute("updated_at"),
        "scheduled_at": _attribute("scheduled_at"),
        "send_time": _attribute("send_time"),
    },
)

FLOWS = _model(
    "int_klaviyo__flows", "klaviyo", "flows", "flow_id", EXTRACTED,
    {
        "flow_name": _attribute("name"),
        "status": _attribute("status"),
        "trigger_type": _attribute("trigger_type"),
        "is_archived": _attribute("archived", to_boolean),
        "created_at": _attribute("created"),
        "updated_at": _attribute("updated"),
    },
)

LISTS = _model(
    "int_klaviyo__lists", "klaviyo", "lists", "list_id", EXTRACTED,
    {
        "list_name": _attribute("name"),
        "opt_in_process": _attribute("opt_in_process"),
        "created_at": _attribute("created"),
        "updated_at": _attribute("updated"),
    },
)

METRICS = _model(
    "int_klaviyo__metrics", "klaviyo", "metrics", "metric_id", EXTRACTED,
    {
        "metric_name": _attribute("name"),
        "created_at": _attribute("created"),
        "updated_at": _attribute("updated"),
    },
)

ERP_ORDERS = _model(
    "int_odoo__orders", "odoo", "orders", "order_id", LOAD,
    {
        "order_reference": "order_reference",
        "external_order_id": "f_order_id",
        "customer": "customer",
        "order_created_at": "create_date",
        "order_updated_at": "write_date",
        "sales_date": "sales_date",
        "order_date": "order_date",
        "delivery_date": "delivery_date",
        "status": "status",
        "invoice_status": "invoice_status",
        "delivery_status": "delivery_status",
        "amount_untaxed": Out("amount_untaxed", cast=to_money),
        "amount_tax": Out("amount_tax", cast=to_money),
        "amount_total": Out("amount_total", cast=to_money),
        "sales_team": "sales_team",
        "salesperson": "salesperson",
        "payment_terms": "payment_terms",
        "shipping_policy": "shipping_policy",
        "delivery_country": "delivery_country",
        "delivery_state": "delivery_state",
        "delivery_city": "delivery_city",
        "delivery_zip": "delivery_zip",
    },
)

ERP_ORDER_LINES = _model(
    "int_odoo__order_lines", "odoo", "order_lines", "line_id", LOAD,
    {
        "order_reference": "order_reference",
        "sku": "sku",
        "product_category": "product_category",
        "quantity": Out("quantity", cast=to_money),
        "unit_price": Out("unit_price", cast=to_money),
        "unit_cost": Out("unit_cost", cast=to_money),
        "subtotal": Out("subtotal", cast=to_money),
        "sales_team": "sales_team",
        "salesperson": "salesperson",
        "line_updated_at": "write_date",
        "sales_date": "sales_date",
    },
)

WHOLESALE_LINES = _model(
    "int_faire__order_lines", "faire", "order_lines", "line_id", LOAD,
    {
        "order_id": "order_id",
        "product_id": "product_id",
        "variant_id": "variant_id",
        "sku": "sku",
        "quantity": "quantity",
        "price_amount_minor": "price_amount_minor",
        "price_currency": "price_currency",
        "line_state": "state",
        "includes_tester": "includes_tester",
        "order_state": "order_state",
        "order_created_at": "order_created_at",
        "order_updated_at": "order_updated_at",
        "retailer_name": "retailer_name",
        "retailer_city": "retailer_city",
        "retailer_state": "retailer_state",
        "retailer_country": "retailer_country",
        "line_created_at": "created_at",
        "line_updated_at": "updated_at",
    },
)


def sum_refunds(refunds: DataFrame) -> DataFrame:
    """Refund transactions summed per order; the sums start before the shuffle."""
    lines = refunds.select("order_id", EXTRACTED, *_DATED, F.explode("transactions").alias("transaction"))
    transaction = payload(lines, "transaction")
    money = to_money(or_raise(transaction, json_text(transaction, "amount")))
    return lines.groupBy("order_id").agg(
        F.sum(money).alias("returns"),
        F.max(EXTRACTED).alias(EXTRACTED),
        *[F.max(c).alias(c) for c in _DATED],
    )


ORDER_REFUNDS = ProcessedModel(
    "int_shopify__order_refunds",
    ("shopify", "order_refunds"),
    ("order_id",),
    EXTRACTED,
    lambda landing: sum_refunds(latest_per_key(landing, ["id"], EXTRACTED)),
)

#: Refund grain for ``recompute``: refunds of one order that arrive in different batches add up.
REFUND_LINES = ProcessedModel(
    "int_shopify__refunds_by_id",
    ("shopify", "order_refunds"),
    ("id",),
    EXTRACTED,
    lambda landing: latest_per_key(landing, ["id"], EXTRACTED).drop(SOURCE_ROW),
)


def order_tags(landing: DataFrame, newest_first: bool = False) -> DataFrame:
    """One row per order and tag, from the latest version that has tags at all.

    With ``newest_first`` the latest version decides even if its tags are empty.
    """
    tagged = filled_array_text(F.col("tags"))
    if newest_first:
        newest = latest_per_key(landing, ["id"], LOAD).filter(tagged)
    else:
        newest = latest_per_key(landing.filter(tagged), ["id"], LOAD)
    rows = newest.select(F.col("id").alias("order_id"), "tags", LOAD)
    return explode_text_array(rows, "tags", "tag").select("order_id", "tag", LOAD)


ORDER_TAGS = ProcessedModel(
    "int_odoo__order_tags", ("odoo", "orders"), ("order_id", "tag"), LOAD, order_tags, parent=("order_id",)
)

PROCESSED = [
    ORDERS, ORDER_REFUNDS, CUSTOMERS, PROFILES, EVENTS, CAMPAIGNS, FLOWS, LISTS, METRICS,
    ERP_ORDERS, ERP_ORDER_LINES, ORDER_TAGS, WHOLESALE_LINES,
]
