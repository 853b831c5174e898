import datetime as dt
import warnings
from decimal import Decimal

import pytest

from millrace.plans.semantic import Dimension, Filter, Measure, SemanticModel, adds_up, kind_from_name, models_of
from millrace.tables import TableStore

SCHEMA = """order_id long, order_date timestamp_ntz, status string, total_sales decimal(10,2), net_sales decimal(10,2),
    price_currency string, discounts decimal(10,2), year int"""


@pytest.fixture()
def table(spark):
    d = Decimal
    return spark.createDataFrame(
        [
            (1, dt.datetime(2024, 1, 1, 5), "paid", d("10.00"), d("9.00"), "EUR", d("1.00"), 2024),
            (2, dt.datetime(2024, 1, 1, 9), "open", d("20.00"), d("19.00"), "EUR", None, 2024),
            (3, dt.datetime(2024, 2, 3, 9), "paid", None, d("1.00"), "USD", d("2.00"), 2024),
        ],
        SCHEMA,
    )


@pytest.mark.parametrize(
    "name,kind",
    [
        ("order_date", "time"), ("created_at", "time"), ("event_timestamp", "time"), ("total_sales", "number"),
        ("net_sales", "string"), ("price_currency", "number"), ("customer_id", "string"), ("id", "string"),
        ("year", "number"), ("orders_count", "number"), ("discounts", "number"), ("revenue", "string"), ("account_id", "number"),
    ],
)
def test_kind_from_name(name, kind):
    assert kind_from_name(name) == kind


def test_enriched_tables_know_more_words():
    assert kind_from_name("revenue", enriched=True) == "number"


def make(table):
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        model = SemanticModel.from_table("fct_sales", table, "order_id", enriched=True)
    return model, [str(w.message) for w in caught]


def test_generated_model(table):
    model, messages = make(table)
    assert list(model.measures) == ["count", "total_total_sales", "total_discounts", "total_year"]
    assert messages == ["fct_sales: no sum for price_currency, it is not numeric"]
    assert model.dimensions["order_id"].primary_key and not model.dimensions["status"].primary_key
    assert SemanticModel.from_table("t", table.select("order_id", "status"), ["order_id", "status"]).dimensions["status"].primary_key is False
    row = model.query().first()
    assert (row["count"], row["total_total_sales"], row["total_discounts"], row["total_year"]) == (3, Decimal("30.00"), Decimal("3.00"), 6072)


def test_query(table):
    model, _ = make(table)
    got = model.query(["count"], ["status"], "order_date", "month", [Filter("year", "gte", 2024)], ["-count", "status"], 2)
    assert [tuple(r) for r in got.collect()] == [
        ("open", dt.datetime(2024, 1, 1), 1),
        ("paid", dt.datetime(2024, 1, 1), 1),
    ]
    for condition, count in (
        (Filter("status", "in", ["paid", "void"]), 2),
        (Filter("discounts", "not_set"), 1),
        (Filter("discounts", "set"), 2),
        (Filter("order_id", "lt", 3), 2),
        (Filter("status", "equals", "void"), 0),
    ):
        assert model.query(["count"], filters=[condition]).first()["count"] == count
    assert model.query(["count"], ["status"], filters=[Filter("status", "equals", "void")]).count() == 0


def test_declared_model(table):
    model = SemanticModel("s", table, {"state": Dimension("status")}, {"n": Measure("count"), "net": Measure("sum", "net_sales")})
    assert sorted(tuple(r) for r in model.query(dimensions=["state"]).collect()) == [("open", 1, Decimal("19.00")), ("paid", 2, Decimal("10.00"))]


def test_rollup_answers_what_it_covers(table, store):
    model, _ = make(table)
    rolled = model.build_rollup(store.table("daily"), ["status"], "order_date")
    rollup = rolled.rollups[0]
    for args, covered in (
        ({"measures": ["count", "total_total_sales"], "dimensions": ["status"]}, True),
        ({"measures": ["count"], "time_dimension": "order_date"}, True),
        ({"measures": ["count"], "filters": [Filter("status", "equals", "paid")]}, True),
        ({"measures": ["count"], "filters": [Filter("status", "equals", "void")]}, True),
        ({"measures": ["count"], "dimensions": ["price_currency"]}, False),
        ({"measures": ["count"], "time_dimension": "order_date", "granularity": "month"}, True),
        ({"measures": ["count"], "time_dimension": "order_date", "granularity": "week"}, True),
        ({"measures": ["count"], "time_dimension": "order_date", "granularity": "hour"}, False),
        ({"measures": ["count"], "filters": [Filter("year", "equals", 2024)]}, False),
    ):
        plain, answered = model.query(**args), rolled.query(**args)
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, answered.collect()))
        plan = answered._jdf.queryExecution().analyzed().toString()
        assert ("parquet" in plan) == covered
    assert rollup.table.count() == 3


def test_rollups_of_an_older_version_are_not_used(table, store):
    source = store.table("fct_b")
    source.append(table.selectExpr("order_id", "discounts AS revenue"))
    model = models_of(store)["fct_b"]
    counted = SemanticModel("b", model.table, model.dimensions, {"n": Measure("count")}, versioned=source)
    rolled = counted.build_rollup(store.table("rollup"), ["order_id"])
    assert rolled.query(["n"], filters=[Filter("order_id", "equals", -5)]).first()["n"] == 0
    before = rolled.query(["n"]).first()["n"]
    source.append(table.selectExpr("order_id", "discounts AS revenue"))
    again = SemanticModel("b", source.read(), model.dimensions, {"n": Measure("count")}, rolled.rollups, source)
    assert again.query(["n"]).first()["n"] == 2 * before


def test_models_of_a_store(table, store):
    for name in ("int_a", "fct_b", "feeder_cursors"):
        store.table(name).append(table.selectExpr("order_id", "discounts AS revenue"))
    models = models_of(store, {"int_a": "order_id"})
    assert sorted(models) == ["fct_b", "int_a"]
    assert list(models["int_a"].measures) == ["count"] and list(models["fct_b"].measures) == ["count", "total_revenue"]
    assert models["int_a"].dimensions["order_id"].primary_key


def test_grains_that_add_up():
    assert adds_up("month", "day") and adds_up("week", "day") and adds_up("year", "quarter") and adds_up("week", "week")
    assert not adds_up("month", "week") and not adds_up("week", "month") and not adds_up("day", "month")


def test_the_coarsest_rollup_answers(table, store):
    model, _ = make(table)
    for name, grain in (("daily", "day"), ("monthly", "month"), ("hourly", "hour")):
        model = model.build_rollup(store.table(name), ["status"], "order_date", grain)
    for grain, name in (("year", "monthly"), ("week", "daily"), ("hour", "hourly")):
        read = model.query(["count"], time_dimension="order_date", granularity=grain).inputFiles()
        assert read and all(f"/{name}/" in path for path in read)


def test_refreshed_rollups(spark, tmp_path):
    """Rows changed, added and removed, values that become NULL, a group that vanishes: the same as anew,
    and only changed buckets are read beside the rollup."""
    store = TableStore(spark, f"{tmp_path}/bucketed", buckets=8)
    source, kind = store.table("fct_b"), "id int, status string, at timestamp_ntz, price decimal(10,4), amount long"
    day = [dt.datetime(2024, 1, n) for n in (1, 2, 3)]
    rows = [(n, "open" if n % 2 else None, day[n % 3], Decimal("0.0049"), n) for n in range(40)] + [(99, "once", day[0], None, None)]
    source.overwrite(spark.createDataFrame(rows, kind), ["id"])
    model = SemanticModel.from_table("b", source.read(), "id", versioned=source)
    model = model.build_rollup(store.table("rollup"), ["status"], "at")
    assert model.refreshed().rollups[0] == model.rollups[0]  # nothing to do
    changed = [(1, "open", day[0], Decimal("5"), None), (99, "now", day[0], None, None), (100, "new", None, Decimal("1"), 7)]
    source.upsert(spark.createDataFrame(changed, kind), ["id"])
    gone, come = source.changed_rows(1)
    assert come.count() - gone.count() == 1 and gone.count() < 41
    now = model.refreshed()
    anew = SemanticModel.from_table("b", source.read(), "id")
    for args in ({"dimensions": ["status"]}, {"time_dimension": "at", "granularity": "month"}, {}):
        answered = now.query(**args)
        assert sorted(map(str, answered.collect())) == sorted(map(str, anew.query(**args).collect()))
        assert answered.inputFiles() and all("/rollup/" in path for path in answered.inputFiles())
    assert "once" not in [r.status for r in now.query(["count"], ["status"]).collect()]
    source.upsert(spark.createDataFrame([(n, "open", day[0], None, None) for n in range(101)], kind), ["id"])
    last = now.refreshed().query(dimensions=["status"]).collect()
    assert [tuple(r) for r in last] == [("open", 101, None)] or [r["total_price"] for r in last] == [None]


def test_rollups_of_floating_point_sums_are_computed_anew(spark, tmp_path):
    store = TableStore(spark, f"{tmp_path}/bucketed", buckets=2)
    source = store.table("fct_b")
    source.overwrite(spark.createDataFrame([(1, 0.1), (2, 1e16)], "id int, price double"), ["id"])
    model = SemanticModel.from_table("b", source.read(), "id", versioned=source).build_rollup(store.table("rollup"), [])
    source.upsert(spark.createDataFrame([(2, 0.2)], "id int, price double"), ["id"])
    assert model.refreshed().query(["total_price"]).first()[0] == 0.1 + 0.2
    with pytest.raises(ValueError):
        SemanticModel.from_table("b", source.read(), "id").refreshed()
