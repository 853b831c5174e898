import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import (
    changed_left_join,
    explode_text_array,
    flatten_order_items,
    high_water_mark,
    latest_per_key,
    newer_than,
    replaced_rows,
)
from millrace.operators.dedupe import SOURCE_FILE
from millrace.plans import enriched, processed
from millrace.plans.processed import EXTRACTED, LOAD
from millrace.sources.known import CONTRACTS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(n):
    return dt.datetime(2024, 1, n)


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, None, "c"), (2, 1, "d"), (None, 1, "e"), (None, 2, "f")], "id long, v int, x string")
    assert rows(latest_per_key(df, ["id"], "v")) == [(1, 2, "b"), (2, 1, "d"), (None, 2, "f")]


def test_equal_versions_are_settled_the_same_way_however_rows_are_spread(spark):
    data = [(k, 1, f"x{i}") for k in range(5) for i in range(40)]
    df = spark.createDataFrame(data, "id long, v int, x string")
    results = {tuple(rows(latest_per_key(df.repartition(n), ["id"], "v"))) for n in (1, 3, 11)}
    assert len(results) == 1


def test_hot_key_is_one_row_per_task_after_the_map_side(spark):
    hot = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    latest = latest_per_key(hot, ["k"], "v")
    assert latest.filter("k = 0").first()["v"] == 59_999
    assert latest.count() == 20_000


def test_replaced_rows(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (2, "old2"), (None, "old")], "k long, x string")
    batch = spark.createDataFrame([(2, "new"), (3, "new"), (3, "new"), (None, "new")], "k long, x string")
    assert rows(replaced_rows(target, batch, ["k"])) == [(2, "old"), (2, "old2")]


def test_order_items(spark):
    documents = [
        '{"id":"o1","state":"NEW","address":{"city":"Ghent"},"items":[{"id":"i1","price":{"amount_minor":5,"currency":"EUR"}},{"id":"i2"}]}',
        '{"id":"o2","state":"NEW"}',
        '{"id":"o3","items":[]}',
    ]
    df = flatten_order_items(spark.createDataFrame([(d,) for d in documents], "document string"))
    got = rows(df.select("id", "price_amount_minor", "price_currency", "order_id", "order_state", "retailer_city", "retailer_name"))
    assert got == [("i1", 5, "EUR", "o1", "NEW", "Ghent", None), ("i2", None, None, "o1", "NEW", "Ghent", None)]


def test_text_arrays(spark):
    df = spark.createDataFrame([(1, '["a","",null,"b",5,{"x":1}]')], "id long, tags string")
    assert rows(explode_text_array(df, "tags", "tag")) == [(1, "5"), (1, "a"), (1, "b"), (1, '{"x":1}')]


TAGS = "id long, tags string, _dlt_load_id string"


def test_tags_come_from_the_latest_version_that_has_some(spark):
    data = [
        (1, '["a","b"]', "1"), (1, "[]", "2"), (2, '["x"]', "1"), (2, '["y","y"]', "2"),
        (3, None, "1"), (4, "", "1"), (5, '[null,""]', "1"),
    ]
    landing = spark.createDataFrame(data, TAGS)
    assert rows(processed.ORDER_TAGS(landing)) == [(1, "a", "1"), (1, "b", "1"), (2, "y", "2"), (2, "y", "2")]
    assert rows(processed.order_tags(landing, newest_first=True)) == [(2, "y", "2"), (2, "y", "2")]


REFUNDS = f"id long, order_id long, transactions array<string>, {EXTRACTED} timestamp_ntz, year int, month int, day int"


def refunds(spark, data):
    return spark.createDataFrame([(i, o, t, day(d), 2024, 1, d) for i, o, t, d in data], REFUNDS)


def test_refund_sums(spark):
    amount = lambda text: '{"amount":"%s"}' % text
    landing = refunds(
        spark,
        [
            (1, 10, [amount("1.10"), amount("2.20"), "{}"], 1),
            (1, 10, [amount("5.00")], 2),  # newer version of the same refund
            (2, 10, [amount("0.50")], 1),
            (3, 11, [], 1),
            (4, 12, None, 1),
        ],
    )
    got = processed.ORDER_REFUNDS(landing).select("order_id", "returns", EXTRACTED, "day")
    assert rows(got) == [(10, Decimal("5.50"), day(2), 2)]


def test_refund_transactions_as_structs(spark):
    landing = refunds(spark, [(1, 10, ['{"amount":"1.10"}'], 1)])
    landing = landing.withColumn("transactions", F.transform("transactions", lambda t: F.from_json(t, "amount string")))
    assert processed.ORDER_REFUNDS(landing).first()["returns"] == Decimal("1.10")


ORDERS = f"""order_id long, order_date timestamp_ntz, cancelled_at timestamp_ntz, is_test_order boolean,
    financial_status string, fulfillment_status string, cancel_reason string, gross_sales decimal(10,2),
    discounts decimal(10,2), shipping decimal(10,2), taxes decimal(10,2), {EXTRACTED} timestamp_ntz"""
SUMS = f"order_id long, returns decimal(20,2), {EXTRACTED} timestamp_ntz"


def orders(spark, data):
    d = Decimal
    full = [(k, day(1), None, test, "paid", None, None, d("100"), discount and d(discount), d("5"), d("2"), day(n)) for k, test, discount, n in data]
    return spark.createDataFrame(full, ORDERS)


def sums(spark, data):
    return spark.createDataFrame([(k, Decimal(r), day(n)) for k, r, n in data], SUMS)


def test_sales_metrics(spark):
    facts = enriched.sales(
        orders(spark, [(1, False, "10", 1), (2, False, None, 1), (3, None, "0", 3)]),
        sums(spark, [(1, "7.50", 2), (9, "1.00", 2)]),  # refund 9 has no order
    )
    got = rows(facts.select("order_id", "returns", "net_sales", "total_sales", EXTRACTED))
    d = Decimal
    assert got == [
        (1, d("7.50"), d("82.50"), d("89.50"), day(2)),
        (2, d("0.00"), None, None, day(1)),
        (3, d("0.00"), d("100.00"), d("107.00"), day(3)),
    ]
    # an unknown test flag is not a valid sale
    assert rows(enriched.valid_sales(facts).select("order_id")) == [(1,), (2,)]
    assert enriched.paid_sales(facts).count() == 3


def test_mark_is_strict_and_an_empty_target_admits_nothing(spark):
    target = orders(spark, [(1, False, "0", 5)])
    arrived = orders(spark, [(2, False, "0", 5), (3, False, "0", 4), (4, False, "0", 6)])
    mark = high_water_mark(target, EXTRACTED)
    assert rows(arrived.filter(newer_than(arrived, EXTRACTED, mark)).select("order_id")) == [(4,)]
    empty = high_water_mark(target.limit(0), EXTRACTED)
    assert empty is None
    assert arrived.filter(newer_than(arrived, EXTRACTED, empty)).count() == 0


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("mark_day", [0, 1, 8, 15, 27, 28])
def test_changed_left_join_equals_the_filtered_join(spark, mark_day, stored):
    left = spark.range(2000).select(
        F.when(F.col("id") < 1999, F.col("id")).alias("k"), (F.col("id") * 7 % 28).cast("int").alias("lv"), F.col("id").alias("x")
    )
    left = left.withColumn("lv", F.when(F.col("x") % 11 != 0, F.col("lv")))
    right = spark.range(500, 1800).select(F.col("id").alias("k"), (F.col("id") * 5 % 28).cast("int").alias("rv"))
    naive = left.join(right, "k", "left").filter((F.col("lv") > mark_day) | (F.col("rv") > mark_day))
    assert rows(changed_left_join(left, right, "k", "lv", "rv", str(mark_day), stored)) == rows(naive)


def test_late_refund_brings_its_order_back(spark):
    o = orders(spark, [(1, False, "0", 1), (2, False, "0", 1)])
    r = sums(spark, [(1, "5.00", 4)])
    got = enriched.sales_since(o, r, "2024-01-03 00:00:00").select("order_id", "returns")
    assert rows(got) == [(1, Decimal("5.00"))]


def test_wholesale_model_takes_the_highest_load(spark):
    df = spark.createDataFrame([("l1", "9", "b", "1"), ("l1", "10", "a", "1")], f"id string, {LOAD} string, sku string, state string")
    df = df.withColumn(SOURCE_FILE, F.lit("f"))
    missing = [f for f in CONTRACTS["faire", "order_lines"].landing_schema() if f.name not in df.columns]
    df = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    # load ids are text and compare as text
    assert processed.WHOLESALE_LINES(df).select("sku").first()["sku"] == "b"


def test_increment_from_landing_is_cut_before_it_is_built(spark, sf_dir):
    """Orders and refunds meet the changed keys below their dedupe and sum; rows are those of the filtered whole."""
    from millrace.catalogue import inputs as i

    mark = "2024-02-10 00:00:00"
    odd = i.orders(spark, sf_dir).limit(3).withColumn("id", F.lit(None).cast("long"))
    landing, refunds = i.orders(spark, sf_dir).unionByName(odd), i.refunds(spark, sf_dir)
    got = enriched.sales_since_landing(landing, refunds, mark)
    whole = enriched.sales(processed.ORDERS(landing), processed.ORDER_REFUNDS(refunds))
    assert rows(got) == rows(whole.filter(F.col(EXTRACTED) > F.lit(mark).cast("timestamp_ntz"))) and got.count() > 50
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") >= 2
    # printed from the result down to the scans: sums and ranks above the semi-joins
    assert text.index("Window") < text.index("LeftSemi") and text.index("Aggregate") < text.rindex("Window") < text.rindex("LeftSemi")
