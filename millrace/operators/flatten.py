"""Nested payloads to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.payload import or_raise

#: Layout of one order document as the wholesale API returns it.
ORDER_DOCUMENT = """
    id string, created_at string, updated_at string, state string,
    address struct<name string, city string, state string, country string>,
    items array<struct<
        id string, created_at string, updated_at string, product_id string, variant_id string,
        quantity bigint, sku string, product_name string, variant_name string,
        includes_tester boolean, state string, price_cents bigint,
        price struct<amount_minor bigint, currency string>>>
"""
ITEM_COLUMNS = [
    "id", "created_at", "updated_at", "product_id", "variant_id", "quantity", "sku",
    "product_name", "variant_name", "includes_tester", "state", "price_cents",
]
ORDER_COLUMNS = ["id", "created_at", "updated_at", "state"]
ADDRESS_COLUMNS = ["name", "city", "state", "country"]


def flatten_order_items(
    pages: DataFrame, document: str = "document", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per order item with the context of its order and retailer.

    Orders without items give no row; an item without a price has NULL price columns.
    """
    parsed = pages.select(*carry, F.from_json(F.col(document), ORDER_DOCUMENT, {"mode": "PERMISSIVE"}).alias("o"))
    # only the context columns go on beside each item, not the document with all its items
    items = parsed.select(
        *[F.col(f"o.{c}").alias(f"order_{c}") for c in ORDER_COLUMNS],
        *[F.col(f"o.address.{c}").alias(f"retailer_{c}") for c in ADDRESS_COLUMNS],
        *carry,
        F.explode("o.items").alias("i"),
    )
    return items.select(
        *[F.col(f"i.{c}").alias(c) for c in ITEM_COLUMNS],
        F.col("i.price.amount_minor").alias("price_amount_minor"),
        F.col("i.price.currency").alias("price_currency"),
        *[c for c in items.columns if c != "i"],
    )


def filled_array_text(column: Column) -> Column:
    """Text that holds a JSON array with something in it."""
    return column.isNotNull() & (column != "[]") & (column != "")


def explode_text_array(df: DataFrame, column: str, alias: str) -> DataFrame:
    """One row per non-empty element of a JSON array held as text; broken text is an error."""
    elements = or_raise(F.col(column), F.from_json(F.col(column), "array<string>"))
    element = F.explode(elements).alias(alias)
    others = [c for c in df.columns if c != column]
    return df.select(*others, element).filter(F.col(alias).isNotNull() & (F.col(alias) != ""))
