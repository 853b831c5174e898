import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import inputs
from millrace.functions import date_label, json_text, json_texts, natural_key, partition_date, to_bigint, to_boolean, to_money
from millrace.functions.payload import json_texts, payload, split_malformed


def one(spark, column, **values):
    schema = ", ".join(f"{n} string" for n in values) or "x string"
    df = spark.createDataFrame([tuple(values.values()) or ("",)], schema)
    return df.select(column.alias("r")).first()["r"]


def by_natural_order(spark, paths):
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    return [r["path"] for r in df.orderBy(natural_key(F.col("path")), "path").collect()]


def test_natural_order(spark):
    assert by_natural_order(spark, ["part_10", "part_9", "part_9-x", "part_100"]) == ["part_9", "part_9-x", "part_10", "part_100"]
    assert by_natural_order(spark, ["10/z", "9/z", "a/1"]) == ["9/z", "10/z", "a/1"]
    # beyond the range of any integer type
    big = ["p" + "9" * 30, "p1" + "0" * 30, "p0" + "9" * 30]
    assert by_natural_order(spark, big)[-1] == big[1]


def test_natural_order_agrees_with_python(spark):
    import random
    import re

    rng = random.Random(7)
    paths = {"".join(rng.choice("ab/_-0123456789") for _ in range(rng.randint(1, 9))) for _ in range(400)}

    def key(s):
        return [int(c) if c.isdigit() else c for c in re.split(r"(\d+)", s)], s

    assert by_natural_order(spark, sorted(paths)) == sorted(paths, key=key)


@pytest.mark.parametrize(
    "path,date,label",
    [
        ("s/year=2024/month=06/day=15/a.parquet", dt.date(2024, 6, 15), "2024-06-15"),
        ("s/year=2024/month=6/day=5/a.parquet", dt.date(2024, 6, 5), "2024-06-05"),
        ("s/plain/a.parquet", None, "a.parquet"),
        ("s/year=2024/month=13/day=05/a.parquet", None, "2024-13-05"),
    ],
)
def test_path_dates(spark, path, date, label):
    assert one(spark, partition_date(F.col("p")), p=path) == date
    assert one(spark, date_label(F.col("p")), p=path) == label


JSON = '{"a":{"b":{"c":7,"d":null}},"list":[1, "x"],"flag":true,"obj":{"k": 1},"money":"12.345"}'


@pytest.mark.parametrize(
    "path,text", [("a.b.c", "7"), ("a.b.d", None), ("a.x.y", None), ("flag", "true"), ("obj", '{"k":1}'), ("list", '[1,"x"]')]
)
def test_json_paths(spark, path, text):
    assert one(spark, json_text(F.col("j"), path), j=JSON) == text
    assert one(spark, json_texts(F.col("j"), [path])[path], j=JSON) == text


def test_json_paths_of_broken_text(spark):
    assert one(spark, json_text(F.col("j"), "a"), j="oops") is None
    assert one(spark, json_texts(F.col("j"), ["a.b"])["a.b"], j="oops") is None
    assert one(spark, json_texts(F.col("j"), ["a.b"])["a.b"], j='{"a":5}') is None


def test_json_paths_of_nested_columns(spark):
    df = spark.createDataFrame([((5, "x"),)], "customer struct<id:long,name:string>")
    assert df.select(json_text(payload(df, "customer"), "id").alias("r")).first()["r"] == "5"


def test_whole_and_part_of_an_object_cannot_be_mixed():
    with pytest.raises(ValueError):
        json_texts(None, ["a", "a.b"])


@pytest.mark.parametrize("text,number", [("12.7", 13), ("12", 12), ("-0.5", -1), ("9007199254740993", 9007199254740993), (None, None)])
def test_bigint_rounds(spark, text, number):
    assert one(spark, to_bigint(F.col("t")), t=text) == number


def test_strict_json_fails_only_on_broken_text(spark):
    for text in ('{"b":1}', "5", "[]", None, '{"a":null}'):
        assert one(spark, json_texts(F.col("j"), ["a", "c.d"], strict=True)["a"], j=text) is None
    for text in ("oops", "", '{"a": '):
        with pytest.raises(Exception, match="malformed JSON"):
            one(spark, json_texts(F.col("j"), ["a", "c.d"], strict=True)["a"], j=text)


def test_money_and_boolean(spark):
    assert one(spark, to_money(F.col("t")), t="1.005") == Decimal("1.01")
    assert one(spark, to_boolean(F.col("t")), t="true") is True
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, to_money(F.col("t")), t="abc")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        one(spark, to_money(F.col("t")), t="123456789.00")


def test_malformed_json(spark):
    df = spark.createDataFrame([("{}",), ("oops",), (None,), ('{"a": 1}',)], "j string")
    good, bad = split_malformed(df, ["j"])
    assert sorted(r["j"] or "" for r in good.collect()) == ["", '{"a": 1}', "{}"]
    assert [r["j"] for r in bad.collect()] == ["oops"]
    for text in ("oops", '{"a":"1"} junk', '{"a":"1"}{"b":"2"}', '{"a":"1"} 7', '["a"] x', '{"a":"1"}, {"b":1}', '{"a":"1"}] x', '{"a":"1"}} x'):
        bad = spark.createDataFrame([(text,)], "j string")
        with pytest.raises(Exception, match="malformed JSON"):
            bad.select(json_texts(F.col("j"), ["a", "b"], strict=True)["b"]).collect()
    for text in ('{"a":"} x"}', ' {"a":"1"} \n', "{}", '{"b":{"c":1} , "a":"} {"}', "[]", None):
        good = spark.createDataFrame([(text,)], "j string")
        good.select(json_texts(F.col("j"), ["a", "b"], strict=True)["a"]).collect()
    whole = spark.createDataFrame([('{"b": {"c": [1, "x"]}}',)], "j string")
    assert whole.select(json_texts(F.col("j"), ["a", "b"])["b"].alias("b")).first()["b"] == '{"c":[1,"x"]}'


def test_small_files_are_spread_before_they_get_payloads(spark, tmp_path):
    spark.range(3).selectExpr(
        "id AS c_custkey", "concat('Customer#', id) AS c_name", "id AS c_nationkey", "1.0D AS c_acctbal", "'m' AS c_mktsegment"
    ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(3).selectExpr("id AS n_nationkey", "'n' AS n_name", "id AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(3).selectExpr("id AS r_regionkey", "'r' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    for stream in (inputs.customers, inputs.profiles, inputs.lists):
        plan = stream(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Generate explode") < plan.index("REPARTITION_BY_COL")
        assert "BroadcastHashJoin" not in plan or "BuildRight" in plan and "BuildLeft" not in plan


def test_tasks_read_few_bytes_of_given_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "READ_BYTES", "20k")
    spark.range(20_000).coalesce(1).write.option("parquet.block.size", 16_000).parquet(f"{tmp_path}/orders.parquet")
    try:
        assert inputs.table(spark, str(tmp_path), "orders").rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
