"""Semantic models: generated and declared, queried by dimension, time grain and rollup."""

from __future__ import annotations

from millrace.catalogue import inputs as i
from millrace.catalogue.models import sales_facts
from millrace.catalogue.registry import query, with_
from millrace.plans import enriched, processed
from millrace.plans.semantic import Dimension, Filter, Measure, SemanticModel
from millrace.plans.refresh import refresh_fact, run_processed
from millrace.session import work_dir
from millrace.tables import TableStore


def sales_model(spark, sf_dir):
    return SemanticModel.from_table("fct_sales", sales_facts(spark, sf_dir), "order_id", enriched=True)


_TOTALS = "CAST(sum(total_sales) AS DECIMAL(38,2)) AS total_total_sales"


@query(
    "semantic_model",
    f"""{with_(i.SALES_SQL)}
SELECT count(*) AS count, CAST(sum(discounts) AS DECIMAL(38,2)) AS total_discounts, {_TOTALS} FROM sales""",
)
def semantic_model(spark, sf_dir):
    """Every measure the naming rules find in the sales fact."""
    return sales_model(spark, sf_dir).query()


@query("measure_count", f"{with_(i.LINES_SQL)}\nSELECT count(*) AS count FROM lines_latest")
def measure_count(spark, sf_dir):
    lines = processed.ERP_ORDER_LINES(i.erp_order_lines(spark, sf_dir))
    return SemanticModel.from_table("int_odoo__order_lines", lines, "line_id").query(["count"])


@query(
    "measure_sums",
    f"""{with_(i.LINES_SQL)}
SELECT CAST(sum(quantity) AS DECIMAL(38,2)) AS total_quantity, CAST(sum(unit_price) AS DECIMAL(38,2)) AS total_unit_price,
    CAST(sum(subtotal) AS DECIMAL(38,2)) AS total_subtotal, CAST(sum(year) AS BIGINT) AS total_year,
    CAST(sum(month) AS BIGINT) AS total_month, CAST(sum(day) AS BIGINT) AS total_day FROM lines_latest""",
)
def measure_sums(spark, sf_dir):
    lines = processed.ERP_ORDER_LINES(i.erp_order_lines(spark, sf_dir))
    model = SemanticModel.from_table("int_odoo__order_lines", lines, "line_id")
    return model.query([m for m in model.measures if m != "count"])


@query(
    "semantic_manual",
    """SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS count,
    CAST(sum(l_linenumber) AS BIGINT) AS line_total FROM lineitem GROUP BY ALL""",
)
def semantic_manual(spark, sf_dir):
    """A model declared by hand."""
    model = SemanticModel(
        "lines",
        i.table(spark, sf_dir, "lineitem"),
        {"flag": Dimension("l_returnflag"), "status": Dimension("l_linestatus")},
        {"count": Measure("count"), "line_total": Measure("sum", "l_linenumber")},
    )
    return model.query(dimensions=["flag", "status"])


@query(
    "semantic_query",
    f"""{with_(i.SALES_SQL)}
SELECT financial_status, fulfillment_status, count(*) AS count, {_TOTALS} FROM sales
WHERE is_test_order = false AND cancelled_at IS NULL GROUP BY ALL""",
)
def semantic_query(spark, sf_dir):
    return sales_model(spark, sf_dir).query(
        ["count", "total_total_sales"],
        ["financial_status", "fulfillment_status"],
        filters=[Filter("is_test_order", "equals", False), Filter("cancelled_at", "not_set")],
        order=["-total_total_sales"],
    )


@query(
    "semantic_time_grain",
    f"""{with_(i.SALES_SQL)}
SELECT CAST(date_trunc('day', order_date) AS TIMESTAMP) AS order_date_day, {_TOTALS} FROM sales GROUP BY 1""",
)
def semantic_time_grain(spark, sf_dir):
    return sales_model(spark, sf_dir).query(["total_total_sales"], time_dimension="order_date", order=["order_date_day"])


@query(
    "semantic_rollup",
    f"{with_(i.SALES_SQL)}\nSELECT financial_status, count(*) AS count, {_TOTALS} FROM sales GROUP BY ALL",
)
def semantic_rollup(spark, sf_dir):
    """Answered from a stored daily rollup by status."""
    store = TableStore(spark, work_dir(spark, "rollup"))
    model = sales_model(spark, sf_dir).build_rollup(
        store.table("fct_sales_daily"), ["financial_status", "is_test_order"], "order_date"
    )
    return model.query(["count", "total_total_sales"], ["financial_status"])


@query(
    "semantic_rollup_month",
    f"""{with_(i.SALES_SQL)}
SELECT financial_status, CAST(date_trunc('month', order_date) AS TIMESTAMP) AS order_date_month, count(*) AS count, {_TOTALS}
FROM sales GROUP BY ALL""",
)
def semantic_rollup_month(spark, sf_dir):
    """Months by status out of days by status and test flag."""
    store = TableStore(spark, work_dir(spark, "rollup"), buckets=i.BUCKETS)
    model = sales_model(spark, sf_dir).build_rollup(
        store.table("fct_sales_daily"), ["financial_status", "is_test_order"], "order_date"
    )
    return model.query(["count", "total_total_sales"], ["financial_status"], "order_date", "month")


@query(
    "semantic_rollup_refresh",
    f"""{with_(i.SALES_SQL)}
SELECT financial_status, CAST(date_trunc('quarter', order_date) AS TIMESTAMP) AS order_date_quarter, count(*) AS count, {_TOTALS}
FROM sales GROUP BY ALL""",
)
def semantic_rollup_refresh(spark, sf_dir):
    """A daily rollup of the first versions of all orders, brought up to date after the later ones."""
    store = TableStore(spark, work_dir(spark, "rollup"), buckets=i.BUCKETS)
    rows, fact = i.orders(spark, sf_dir), enriched.FCT_SALES
    run_processed(store, processed.ORDER_REFUNDS, i.refunds(spark, sf_dir))
    run_processed(store, processed.ORDERS, rows.filter("v = 1"))
    refresh_fact(store, fact, full=True)
    table = store.table(fact.name)
    model = SemanticModel.from_table(fact.name, table.read(), "order_id", enriched=True, versioned=table)
    model = model.build_rollup(store.table("fct_sales_daily"), ["financial_status"], "order_date")
    later = processed.ORDERS(rows.filter("v > 1"))
    run_processed(store, processed.ORDERS, rows.filter("v > 1"))
    facts = enriched.sales(store.read(processed.ORDERS.name), store.read(processed.ORDER_REFUNDS.name))
    table.upsert(facts.join(later.select("order_id"), "order_id", "left_semi"), fact.keys)
    return model.refreshed().query(["count", "total_total_sales"], ["financial_status"], "order_date", "quarter")
