"""The enriched models: facts joined from processed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.increment import changed_keys, changed_left_join, newer_than, of_keys
from millrace.plans.model import Context, EnrichedModel
from millrace.plans.processed import EXTRACTED, ORDER_REFUNDS, ORDERS, REFUND_LINES, sum_refunds

REFUND_EXTRACTED = "_refund_extracted_at"


def refund_side(refunds: DataFrame) -> DataFrame:
    return refunds.select("order_id", "returns", F.col(EXTRACTED).alias(REFUND_EXTRACTED))


def sales_columns(joined: DataFrame) -> DataFrame:
    """Sales metrics of orders joined to their refund sums; a NULL term makes its metric
    NULL, except missing returns, which count as zero."""
    returns = F.coalesce("returns", F.lit(0).cast("decimal(10,2)"))
    net = F.col("gross_sales") - F.col("discounts") - returns
    return joined.select(
        "order_id", "order_date", "cancelled_at", "is_test_order",
        "financial_status", "fulfillment_status", "cancel_reason",
        F.col("gross_sales"),
        F.col("discounts"),
        returns.cast("decimal(18,2)").alias("returns"),
        net.cast("decimal(18,2)").alias("net_sales"),
        F.col("shipping"),
        F.col("taxes"),
        (net + F.col("shipping") + F.col("taxes")).cast("decimal(18,2)").alias("total_sales"),
        F.greatest(EXTRACTED, REFUND_EXTRACTED).alias(EXTRACTED),
    )


def sales(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """All orders with their sales metrics."""
    return sales_columns(orders.join(refund_side(refunds), "order_id", "left"))


def sales_since(orders: DataFrame, refunds: DataFrame, mark: str | None, stored: bool = False) -> DataFrame:
    """Sales of the orders that changed, or whose refunds changed, after a mark."""
    sides = orders, refund_side(refunds)
    return sales_columns(changed_left_join(*sides, "order_id", EXTRACTED, REFUND_EXTRACTED, mark, stored))


def _newer(orders: DataFrame, refunds: DataFrame, mark: str | None) -> DataFrame:
    """Sales of those orders, of few, that are new or have new refunds."""
    joined = orders.join(refund_side(refunds), "order_id", "left")
    new = newer_than(joined, EXTRACTED, mark) | F.coalesce(newer_than(joined, REFUND_EXTRACTED, mark), F.lit(False))
    return sales_columns(joined.filter(new))


def sales_since_landing(orders: DataFrame, refunds: DataFrame, mark: str | None) -> DataFrame:
    """The same from landing rows: what changed is found by keys and versions alone, and both inputs
    are cut to those orders before they are deduplicated, parsed and summed, so each is read in full
    once. Versions of a refund belong to one order."""
    changed = changed_keys([(orders, "id", EXTRACTED), (refunds, "order_id", EXTRACTED)], "order_id", mark)
    return _newer(ORDERS(of_keys(orders, "id", changed)), ORDER_REFUNDS(of_keys(refunds, "order_id", changed)), mark)


def _build_sales(ctx: Context) -> DataFrame:
    if not ctx.incremental:
        return sales(ctx.ref(ORDERS.name), ctx.ref(ORDER_REFUNDS.name))
    changed, mark = _changed_orders(ctx, ORDER_REFUNDS.name)
    return _newer(ctx.ref(ORDERS.name, changed), ctx.ref(ORDER_REFUNDS.name, changed), mark)


def _changed_orders(ctx: Context, refunds: str) -> tuple[DataFrame, str | None]:
    """Orders that have changed, or whose refunds have, since the fact's newest row."""
    mark = ctx.target.high_water_mark(EXTRACTED)
    sides = [(ctx.ref(name), "order_id", EXTRACTED) for name in (ORDERS.name, refunds)]
    return changed_keys(sides, "order_id", mark), mark


FCT_SALES = EnrichedModel(
    "fct_sales", (ORDERS.name, ORDER_REFUNDS.name), ("order_id",), EXTRACTED, _build_sales
)

ENRICHED = [FCT_SALES]


def _build_recomputed(ctx: Context) -> DataFrame:
    if not ctx.incremental:
        return sales(ctx.ref(ORDERS.name), sum_refunds(ctx.ref(REFUND_LINES.name)))
    changed, mark = _changed_orders(ctx, REFUND_LINES.name)
    return _newer(ctx.ref(ORDERS.name, changed), sum_refunds(ctx.ref(REFUND_LINES.name, changed)), mark)


#: The same fact over refunds kept one by one: refunds of an order add up whatever batches they came
#: in. Feed ``REFUND_LINES`` instead of the sums by order, which only hold the last batch's refunds.
FCT_SALES_RECOMPUTE = EnrichedModel(
    "fct_sales_recompute", (ORDERS.name, REFUND_LINES.name), ("order_id",), EXTRACTED, _build_recomputed
)


def valid_sales(facts: DataFrame) -> DataFrame:
    """Neither test orders (an unknown flag counts as test) nor cancelled ones."""
    return facts.filter((F.col("is_test_order") == F.lit(False)) & F.col("cancelled_at").isNull())


def paid_sales(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("financial_status") == "paid")


def daily_totals(facts: DataFrame) -> DataFrame:
    day = F.date_trunc("day", "order_date").cast("timestamp_ntz")
    return (
        facts.filter(F.col("is_test_order") == F.lit(False))
        .groupBy(day.alias("day"))
        .agg(F.sum("total_sales").cast("decimal(18,2)").alias("total_sales"))
    )
