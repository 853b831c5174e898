import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace import files
from millrace.operators.dedupe import SOURCE_FILE
from millrace.plans import enriched, processed
from millrace.plans.enriched import FCT_SALES
from millrace.plans.model import EnrichedModel
from millrace.plans.processed import EXTRACTED, LOAD
from millrace.plans.refresh import in_dependency_order, processed_models, refresh_dependents, refresh_fact, run_processed
from millrace.sources.known import CONTRACTS
from millrace.sources.landing import (
    append_landing,
    day_folders,
    extract_increment,
    files_after_cursor,
    list_files,
    scan_files,
    scan_landing,
)
from millrace.streaming import CursorTable, feed_files, land_records, read_metrics, stream_files

UNTIL = dt.date(2024, 12, 31)
LIST = ("klaviyo", "lists")
LIST_SCHEMA = CONTRACTS[LIST].landing_schema()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def land(spark, root, data, load="1.0"):
    """Marketing lists as (id, name, day of January)."""
    schema = f"id string, attributes string, {EXTRACTED} timestamp_ntz"
    records = [(i, '{"name":"%s"}' % name, dt.datetime(2024, 1, day)) for i, name, day in data]
    append_landing(spark.createDataFrame(records, schema), root, load, EXTRACTED)


@pytest.fixture()
def root(tmp_path):
    return f"{tmp_path}/raw/klaviyo/lists"


def names(store):
    return rows(store.read("int_klaviyo__lists").select("list_id", "list_name"))


def feed(store, root, **options):
    return feed_files(store, root, *LIST, LIST_SCHEMA, until=UNTIL, **options)


def test_landing_layout(spark, root):
    land(spark, root, [("a", "x", 3), ("b", "y", 12)], "1704067200.5")
    land(spark, root, [("c", "z", 3)], "1704153600.5")
    assert [d[len(root) :] for d in day_folders(spark, root)] == ["/year=2024/month=01/day=03", "/year=2024/month=01/day=12"]
    found = [r["path"].split("/")[-1] for r in files_after_cursor(spark, root, None).collect()]
    assert [f.split("-")[0] for f in found] == ["1704067200.5", "1704153600.5", "1704067200.5"]
    df = scan_landing(spark, root, schema=LIST_SCHEMA)
    assert rows(df.select("id", "year", "month", "day")) == [("a", 2024, 1, 3), ("b", 2024, 1, 12), ("c", 2024, 1, 3)]
    one = [r["path"] for r in list_files(spark, [root]).collect() if "day=12" in r["path"]]
    assert rows(scan_files(spark, root, one, LIST_SCHEMA).select("id", "day")) == [("b", 12)]


def test_a_big_day_is_split_and_a_record_limit_rotates_files(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), F.expr("timestamp_ntz'2024-01-01' ").alias("at"))
    append_landing(df, f"{tmp_path}/r", "1", "at", max_records_per_file=30)
    assert list_files(spark, [f"{tmp_path}/r"]).count() >= 4


def test_date_range_and_missing_days(spark, root):
    land(spark, root, [("a", "x", 3), ("b", "y", 12), ("c", "z", 20)])
    df = scan_landing(spark, root, dt.date(2024, 1, 4), dt.date(2024, 1, 12), LIST_SCHEMA)
    assert rows(df.select("id")) == [("b",)]
    assert scan_landing(spark, root, dt.date(2024, 2, 1), dt.date(2024, 3, 1), LIST_SCHEMA).count() == 0
    assert day_folders(spark, f"{root}/none") == []


def test_listing_errors_raise(spark, root, store):
    land(spark, root, [("a", "x", 3)])
    feed(store, root)
    land(spark, root, [("b", "y", 4)])
    os.makedirs(f"{root}/year=2024/month=02")
    with open(f"{root}/year=2024/month=02/day=01", "w"):
        pass  # a file where a folder should be
    before = CursorTable(store).get(*LIST)
    real = files.child_names

    def unreadable(session, path):
        if path.endswith("month=02"):
            raise PermissionError(path)
        return real(session, path)

    files.child_names = unreadable
    try:
        with pytest.raises(PermissionError):
            feed(store, root)
    finally:
        files.child_names = real
    assert CursorTable(store).get(*LIST) == before and names(store) == [("a", "x")]


def test_cursor(spark, root, store):
    land(spark, root, [("a", "x", 3), ("b", "y", 4)])
    result = feed(store, root)
    assert (result.status, result.processed, sum(result.rows)) == ("complete", 2, 2)
    assert "day=04" in result.cursor and CursorTable(store).get(*LIST) == result.cursor
    assert feed(store, root).status == "no_files"
    land(spark, root, [("c", "late", 2)])  # below the cursor: never read
    land(spark, root, [("d", "same day", 4)], "2.0")
    assert feed(store, root).processed == 1
    assert names(store) == [("a", "x"), ("b", "y"), ("d", "same day")]
    CursorTable(store).clear(*LIST)
    assert CursorTable(store).get(*LIST) is None
    assert feed(store, root).processed == 4


def test_unreadable_cursor_means_all_files(spark, root):
    land(spark, root, [("a", "x", 3), ("b", "y", 4)])
    assert files_after_cursor(spark, root, "somewhere/else.parquet").count() == 2
    assert files_after_cursor(spark, f"{root}-missing", None).count() == 0


def test_files_up_to_a_day_without_a_cursor(spark, root):
    land(spark, root, [("a", "x", 3), ("b", "y", 4)])
    days = [int(r["path"].split("day=")[1][:2]) for r in files_after_cursor(spark, root, None).collect()]
    until = dt.date(2024, 1, min(days))
    assert files_after_cursor(spark, root, None, until).count() == 1


def test_missing_landing_columns_are_an_error(spark):
    rows = spark.createDataFrame([("a", None)], f"id string, {EXTRACTED} timestamp")
    with pytest.raises(Exception, match="attributes"):
        processed.LISTS(rows)


def test_cursors_of_other_streams_stay(store):
    cursors = CursorTable(store)
    cursors.set("s", "a", "p1")
    cursors.set("s", "b", "p2")
    cursors.set("s", "a", "p3")
    assert rows(cursors.read().select("stream", "cursor_path")) == [("a", "p3"), ("b", "p2")]
    assert [r["stream"] for r in cursors.freshness().collect()] == ["a", "b"]
    cursors.clear("s", "a")
    assert rows(cursors.read().select("stream")) == [("b",)]


def test_last_batch_wins_or_newest_version(spark, root, store):
    land(spark, root, [("a", "new", 9)], "1.0")
    feed(store, root)
    old = scan_landing(spark, root, schema=LIST_SCHEMA).withColumn(EXTRACTED, F.expr("timestamp_ntz'2024-01-01'"))
    old = old.withColumn("attributes", F.lit('{"name":"old"}'))
    run_processed(store, processed.LISTS, old, guard_version=True)
    assert names(store) == [("a", "new")]
    run_processed(store, processed.LISTS, old)
    assert names(store) == [("a", "old")]


def test_failure_in_the_second_batch(spark, root, store):
    land(spark, root, [("a", "x", 1), ("b", "y", 2), ("c", "z", 3)])

    def fail(number):
        if number == 2:
            raise RuntimeError("stop")

    with pytest.raises(RuntimeError, match="stop"):
        feed(store, root, files_per_batch=1, on_batch=fail)
    assert "day=01" in CursorTable(store).get(*LIST)
    assert feed(store, root, files_per_batch=1).files == [1, 1]
    assert names(store) == [("a", "x"), ("b", "y"), ("c", "z")]


def test_malformed_payloads(spark, root, store):
    land(spark, root, [("a", "x", 1), ("b", 'y"', 2)])  # the quote breaks b's JSON
    with pytest.raises(Exception, match="malformed JSON"):
        feed(store, root)
    assert CursorTable(store).get(*LIST) is None
    aside = []
    feed(store, root, quarantine=lambda df: aside.extend(r["id"] for r in df.collect()))
    assert names(store) == [("a", "x")] and aside == ["b"]


def test_a_stream_without_model_is_an_error(spark, root, store):
    land(spark, root, [("a", "x", 1)])
    with pytest.raises(LookupError):
        feed_files(store, root, "klaviyo", "unknown")
    assert CursorTable(store).get("klaviyo", "unknown") is None
    assert {m.name for m in processed_models("odoo", "orders")} == {"int_odoo__orders", "int_odoo__order_tags"}
    for stream in CONTRACTS:
        assert processed_models(*stream)


def test_stream_equals_batch_and_does_not_repeat(spark, root, store, tmp_path):
    land(spark, root, [("a", "x", 1), ("b", "y", 2), ("a", "x2", 3)])
    checkpoint = f"{tmp_path}/checkpoint"

    def run():
        query = stream_files(store, root, *LIST, LIST_SCHEMA, checkpoint, files_per_batch=1)
        query.awaitTermination()

    run()
    whole = processed.LISTS(scan_landing(spark, root, schema=LIST_SCHEMA)).select("list_id", "list_name")
    assert names(store) == rows(whole) == [("a", "x2"), ("b", "y")]
    version = store.table("int_klaviyo__lists").current_version()
    run()
    assert store.table("int_klaviyo__lists").current_version() == version
    land(spark, root, [("c", "earlier day, later arrival", 1)], "2.0")
    run()
    assert ("c", "earlier day, later arrival") in names(store)


REFUNDS = f"id long, order_id long, transactions array<string>, {EXTRACTED} timestamp_ntz, year int, month int, day int"


def refund(spark, number, amount, day):
    return spark.createDataFrame([(number, 10, ['{"amount":"%s"}' % amount], dt.datetime(2024, 1, day), 2024, 1, day)], REFUNDS)


def test_refunds_of_one_order_in_two_batches(spark, store):
    for number, amount, day in ((1, "10.00", 1), (2, "5.00", 2)):
        run_processed(store, processed.ORDER_REFUNDS, refund(spark, number, amount, day))
        run_processed(store, processed.REFUND_LINES, refund(spark, number, amount, day))
    assert [float(r["returns"]) for r in store.read(processed.ORDER_REFUNDS.name).collect()] == [5.0]
    recomputed = processed.sum_refunds(store.read(processed.REFUND_LINES.name))
    assert [float(r["returns"]) for r in recomputed.collect()] == [15.0]


def test_removed_tags(spark, store):
    schema = f"id long, tags string, {LOAD} string"
    batches = [[(1, '["a","b"]', "1"), (2, '["c"]', "1")], [(1, '["a"]', "2"), (2, "[]", "2")]]
    for data in batches:
        run_processed(store, processed.ORDER_TAGS, spark.createDataFrame(data, schema))
    assert rows(store.read(processed.ORDER_TAGS.name)) == [(1, "a", "2"), (1, "b", "1"), (2, "c", "1")]
    store.drop(processed.ORDER_TAGS.name)
    for data in batches:
        run_processed(store, processed.ORDER_TAGS, spark.createDataFrame(data, schema), replace_parent=True)
    assert rows(store.read(processed.ORDER_TAGS.name)) == [(1, "a", "2")]


def test_fact_follows_its_inputs(spark, store):
    from test_operators import SUMS, orders, sums

    assert refresh_dependents(store, [processed.ORDERS.name]) == []  # refunds are not there yet
    store.table(processed.ORDERS.name).upsert(orders(spark, [(1, False, "0", 1), (2, False, "0", 1)]), ["order_id"])
    store.create(processed.ORDER_REFUNDS.name, spark.createDataFrame([], SUMS).schema)
    assert refresh_dependents(store, [processed.ORDERS.name]) == [FCT_SALES.name]
    assert refresh_dependents(store, ["something else"]) == []
    store.table(processed.ORDER_REFUNDS.name).upsert(sums(spark, [(1, "5.00", 4), (9, "1.00", 4)]), ["order_id"])
    store.table(processed.ORDERS.name).upsert(orders(spark, [(3, False, "0", 1), (4, False, "0", 3)]), ["order_id"])
    refresh_dependents(store, [processed.ORDER_REFUNDS.name])
    facts = store.read(FCT_SALES.name)
    # 3 is late and stays out; a refund newer than the mark brought 1 back
    assert rows(facts.select("order_id", F.col("returns").cast("double"))) == [(1, 5.0), (2, 0.0), (4, 0.0)]
    refresh_fact(store, FCT_SALES, full=True)
    assert store.read(FCT_SALES.name).count() == 4
    assert enriched.daily_totals(store.read(FCT_SALES.name)).count() == 1


def test_fact_over_an_empty_target_admits_nothing(spark, store):
    from test_operators import SUMS, orders

    store.create(processed.ORDER_REFUNDS.name, spark.createDataFrame([], SUMS).schema)
    store.table(processed.ORDERS.name).upsert(orders(spark, [(1, False, "0", 1)]), ["order_id"])
    refresh_fact(store, FCT_SALES)
    schema = store.table(FCT_SALES.name).schema()
    store.drop(FCT_SALES.name)
    store.create(FCT_SALES.name, schema)
    refresh_fact(store, FCT_SALES)
    assert store.read(FCT_SALES.name).count() == 0


def test_incremental_extract(spark):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)], "write_date string, id int")
    fresh, cursor = extract_increment(df, "write_date", "2024-01-02")
    assert rows(fresh.select("id")) == [(2,), (3,)] and cursor == "2024-01-03"
    fresh, cursor = extract_increment(df, "write_date", None)
    assert fresh.count() == 3
    fresh, cursor = extract_increment(df, "write_date", "2025-01-01")
    assert fresh.count() == 0 and cursor == "2025-01-01"


def test_extract_run(spark, store, tmp_path):
    contract = replace(CONTRACTS["odoo", "order_lines"], initial_value="2024-01-02")
    root = f"{tmp_path}/raw"
    schema = "id long, write_date string, sku string, secret string"
    first = spark.createDataFrame([(1, "2024-01-01", "a", "s"), (2, "2024-01-02", "b", "s"), (3, "2024-01-05", "c", "s")], schema)
    planned = land_records(store, first, contract, root, dry_run=True)
    assert (planned.status, planned.cursor, planned.fields) == ("dry_run", "2024-01-02", ("id", "write_date", "sku"))
    done = land_records(store, first, contract, root)
    assert (done.status, done.records, done.cursor) == ("success", 2, "2024-01-05")
    later = spark.createDataFrame([(3, "2024-01-05", "c", "s"), (4, "2024-01-06", "d", "s"), (5, "2024-01-03", "e", "s")], schema)
    assert land_records(store, later, contract, root).records == 1  # the boundary is known, 5 is late
    twin = spark.createDataFrame([(4, "2024-01-06", "d", "s"), (6, "2024-01-06", "f", "s")], schema)
    assert [land_records(store, twin, contract, root).records for _ in range(2)] == [1, 0]
    landed = scan_landing(spark, root)
    assert "secret" not in landed.columns and landed.select("_dlt_load_id").distinct().count() == 3
    assert rows(landed.select("id")) == [(2,), (3,), (4,), (6,)]
    whole = scan_landing(spark, root, schema=contract.landing_schema())
    assert rows(processed.ERP_ORDER_LINES(whole).select("line_id", "sku")) == [(2, "b"), (3, "c"), (4, "d"), (6, "f")]


def test_extraction_reads_its_source_once(spark, store, tmp_path):
    contract = replace(CONTRACTS["odoo", "order_lines"], initial_value="2024-01-02")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    schema = "id long, write_date string, sku string"
    first = [(1, "2024-01-01", "a"), (2, "2024-01-02", "b"), (3, "2024-01-05", "c")]
    for records, landed in ((first, 2), ([*first, (4, "2024-01-05", "d"), (4, "2024-01-05", "d"), (5, "2024-01-07", "e"), (6, None, "f")], 3)):
        before = read.value
        source = spark.createDataFrame(records, schema).mapInArrow(counted, schema)
        assert land_records(store, source, contract, f"{tmp_path}/raw").records == landed
        assert read.value - before == len(records)
    assert rows(scan_landing(spark, f"{tmp_path}/raw").select("id")) == [(2,), (3,), (4,), (4,), (5,)]


def test_extract_needs_an_initial_value_and_selection(spark, store, tmp_path):
    contract = CONTRACTS["odoo", "orders"]
    assert land_records(store, spark.range(1), replace(contract, selected=False), f"{tmp_path}/raw").status == "skipped"
    with pytest.raises(ValueError, match="initial_value"):
        land_records(store, spark.range(1), replace(contract, initial_value=None), f"{tmp_path}/raw")


def test_source_file_is_kept(spark, root, store):
    land(spark, root, [("a", "x", 1)])
    feed(store, root)
    assert "day=01" in store.read("int_klaviyo__lists").first()[SOURCE_FILE]


def test_models_run_in_the_order_of_their_tables():
    def model(name, *refs):
        return EnrichedModel(name, refs, ("k",), "v", None)

    a, b, c = model("a", "raw"), model("b", "a", "raw"), model("c", "b")
    assert [m.name for m in in_dependency_order([c, b, a])] == ["a", "b", "c"]
    with pytest.raises(ValueError, match="need each other"):
        in_dependency_order([model("x", "y"), model("y", "x")])


def test_metrics_of_stream_batches(spark, root, store, tmp_path):
    """A row for each batch: complete, failed with its model, and complete once it is repeated."""
    metrics, stop = f"{tmp_path}/metrics", [True]
    failing = replace(processed.LISTS, name="int_failing", build=lambda df: 1 / 0 if stop else processed.LISTS.build(df))

    def run():
        query = stream_files(
            store, root, *LIST, LIST_SCHEMA, f"{tmp_path}/checkpoint", [processed.LISTS, failing], metrics=metrics, quarantine=f"{tmp_path}/aside"
        )
        query.awaitTermination()

    def noted():
        return sorted(tuple(r) for r in read_metrics(spark, metrics).select("batch", "files", "rows", "broken", "status", "failed_model").collect())

    land(spark, root, [("a", "x", 1), ("b", "y", 2)])
    with pytest.raises(Exception, match="division by zero"):
        run()
    assert noted() == [(0, 2, 2, 0, "failed", "int_failing")]
    stop.clear()
    run()
    assert noted() == [(0, 2, 2, 0, "complete", None)]
    land(spark, root, [("c", "z", 3)], "2.0")
    run()
    assert noted() == [(0, 2, 2, 0, "complete", None), (1, 1, 1, 0, "complete", None)]


def test_a_delivery_of_many_files_is_one_batch(spark, tmp_path):
    """Repeated rows are dropped, whatever number of files a delivery has; late ones are, by the delivery before."""
    from millrace.streaming import Unique, append_unique

    day = lambda n: f"2024-01-{n:02d} 00:00:00"
    deliveries = ([(k, day(20 + k % 3)) for k in range(12)], [(3, day(20)), (20, day(1)), (21, day(23))])
    for rows in deliveries:
        df = spark.createDataFrame(rows, "k long, at string").selectExpr("k", "cast(at as timestamp) at")
        df.repartition(6).write.mode("append").parquet(f"{tmp_path}/raw")
        unique = Unique(["k"], "at", "14 days")
        append_unique(spark, f"{tmp_path}/raw", "k long, at timestamp", unique, f"{tmp_path}/out", f"{tmp_path}/checkpoint", None).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [*range(12), 21]
    assert spark.read.json(f"{tmp_path}/checkpoint/sources/0").where("batchId is not null").select("batchId").distinct().count() == 2
