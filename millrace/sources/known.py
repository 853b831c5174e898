"""Contracts of the streams the built-in models read.

Fixed values: names, types, keys and sync modes of the streams. Only fields that a model
reads, or that key or order a stream, are listed; a deployment that lands more loads its
own contract files with ``StreamContract.from_json``.
"""

from __future__ import annotations

from millrace.sources.contracts import StreamContract

_INTEGER = {"type": "integer"}
_NUMBER = {"type": "number"}
_STRING = {"type": "string"}
_BOOLEAN = {"type": "boolean"}
_TIME = {"type": "string", "format": "date-time"}


def _object(**properties):
    return {"type": "object", "properties": properties} if properties else {"type": "object"}


_MONEY = _object(amount=_NUMBER, currency_code=_STRING)
_LINK = _object(data=_object(id=_STRING))

_STREAMS = [
    StreamContract(
        "shopify", "orders", cursor_field="updated_at",
        fields={
            "id": _INTEGER, "created_at": _TIME, "updated_at": _TIME, "cancelled_at": _TIME, "test": _BOOLEAN,
            "total_line_items_price": _NUMBER, "total_discounts": _NUMBER, "total_tax": _NUMBER,
            "total_shipping_price_set": _object(shop_money=_MONEY, presentment_money=_MONEY),
            "financial_status": _STRING, "fulfillment_status": _STRING, "cancel_reason": _STRING,
            "customer": _object(id=_INTEGER),
        },
    ),
    StreamContract(
        "shopify", "order_refunds", cursor_field="created_at",
        fields={
            "id": _INTEGER, "order_id": _INTEGER, "created_at": _TIME,
            "transactions": {"type": "array", "items": {"amount": _STRING, "test": _BOOLEAN}},
        },
    ),
    StreamContract(
        "shopify", "customers", cursor_field="updated_at",
        fields={
            "id": _INTEGER, "email": _STRING, "first_name": _STRING, "last_name": _STRING, "created_at": _TIME,
            "updated_at": _TIME, "orders_count": _INTEGER, "total_spent": _NUMBER, "tags": _STRING, "state": _STRING,
        },
    ),
    StreamContract(
        "klaviyo", "profiles", cursor_field="updated",
        fields={
            "id": _STRING,
            "attributes": _object(
                email=_STRING, phone_number=_STRING, first_name=_STRING, last_name=_STRING, created=_TIME, updated=_TIME,
                last_event_date=_TIME,
                location=_object(city=_STRING, region=_STRING, country=_STRING, zip=_STRING),
                predictive_analytics=_object(
                    total_clv=_NUMBER, historic_clv=_NUMBER, predicted_clv=_NUMBER, churn_probability=_NUMBER,
                    average_order_value=_NUMBER, historic_number_of_orders=_INTEGER,
                ),
            ),
        },
    ),
    StreamContract(
        "klaviyo", "events", cursor_field="datetime",
        fields={
            "id": _STRING, "datetime": _TIME,
            "attributes": _object(uuid=_STRING, timestamp=_INTEGER, event_properties=_object()),
            "relationships": _object(metric=_LINK, profile=_LINK),
        },
    ),
    StreamContract(
        "klaviyo", "campaigns", cursor_field="updated_at",
        fields={
            "id": _STRING,
            "attributes": _object(
                name=_STRING, status=_STRING, channel=_STRING, archived=_BOOLEAN, created_at=_TIME, updated_at=_TIME,
                scheduled_at=_TIME, send_time=_TIME,
            ),
        },
    ),
    StreamContract(
        "klaviyo", "flows", cursor_field="updated",
        fields={
            "id": _STRING,
            "attributes": _object(
                name=_STRING, status=_STRING, trigger_type=_STRING, archived=_BOOLEAN, created=_TIME, updated=_TIME
            ),
        },
    ),
    StreamContract(
        "klaviyo", "lists", cursor_field="updated",
        fields={"id": _STRING, "attributes": _object(name=_STRING, opt_in_process=_STRING, created=_TIME, updated=_TIME)},
    ),
    StreamContract(
        "klaviyo", "metrics", cursor_field="updated", sync_mode="full_refresh", destination_sync_mode="overwrite",
        fields={"id": _STRING, "attributes": _object(name=_STRING, created=_TIME, updated=_TIME, integration=_object())},
    ),
    StreamContract(
        "odoo", "orders", cursor_field="write_date", destination_sync_mode="append",
        initial_value="2020-01-01 00:00:00", metadata=("_dlt_load_id", "_dlt_id"),
        fields={
            "id": _INTEGER, "order_reference": _STRING, "create_date": _TIME, "write_date": _TIME, "sales_date": _TIME,
            "order_date": _TIME, "delivery_date": _TIME, "sales_team": _STRING, "salesperson": _STRING,
            "amount_untaxed": _NUMBER, "amount_tax": _NUMBER, "amount_total": _NUMBER, "payment_terms": _STRING,
            "tags": {"type": "array", "items": _STRING}, "status": _STRING, "invoice_status": _STRING,
            "customer": _STRING, "shipping_policy": _STRING, "f_order_id": _STRING, "delivery_status": _STRING,
            "delivery_country": _STRING, "delivery_state": _STRING, "delivery_city": _STRING, "delivery_zip": _STRING,
        },
    ),
    StreamContract(
        "odoo", "order_lines", cursor_field="write_date", destination_sync_mode="append",
        initial_value="2020-01-01 00:00:00", metadata=("_dlt_load_id", "_dlt_id"),
        fields={
            "id": _INTEGER, "write_date": _TIME, "order_reference": _STRING, "sales_team": _STRING,
            "salesperson": _STRING, "product_category": _STRING, "sku": _STRING, "quantity": _NUMBER,
            "subtotal": _NUMBER, "unit_cost": _NUMBER, "unit_price": _NUMBER, "sales_date": _TIME,
        },
    ),
    StreamContract(
        "faire", "order_lines", cursor_field="order_updated_at", destination_sync_mode="merge",
        initial_value="2020-01-01T00:00:00.000Z", metadata=("_dlt_load_id", "_dlt_id"),
        fields={
            "id": _STRING, "created_at": _TIME, "updated_at": _TIME, "product_id": _STRING, "variant_id": _STRING,
            "quantity": _INTEGER, "sku": _STRING, "includes_tester": _BOOLEAN, "state": _STRING,
            "price_amount_minor": _INTEGER, "price_currency": _STRING, "order_id": _STRING, "order_created_at": _TIME,
            "order_updated_at": _TIME, "order_state": _STRING, "retailer_name": _STRING, "retailer_city": _STRING,
            "retailer_state": _STRING, "retailer_country": _STRING,
        },
    ),
]

CONTRACTS = {(c.source, c.stream): c for c in _STREAMS}
