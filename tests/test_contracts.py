import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.contracts import (
    StreamContract,
    fields_from_json_schema,
    fields_of,
    infer_fields,
    infer_nested,
    json_schema,
    nested_struct,
)
from millrace.sources.known import CONTRACTS

TEXT = json.dumps(
    {
        "stream": "orders",
        "connector": "dlt",
        "schedule": "0 * * * *",
        "sync_mode": "incremental",
        "destination_sync_mode": "merge",
        "primary_key": [["id"]],
        "cursor_field": ["write_date"],
        "initial_value": "2020-01-01",
        "selected": False,
        "fields": {
            "id": {"type": "integer"},
            "amount": {"type": ["null", "number"]},
            "write_date": {"type": "string", "format": "date-time"},
            "tags": {"type": "array", "items": {"type": "string"}},
            "lines": {"type": "array", "items": {"sku": {"type": "string"}, "type": {"type": "string"}}},
            "customer": {"type": "object", "properties": {"id": {"type": "integer"}, "extra": {"type": "object"}}},
            "odd": {"type": "unknown"},
        },
    }
)


def test_contract_file():
    contract = StreamContract.from_json("odoo", TEXT)
    assert (contract.primary_key, contract.cursor_field, contract.initial_value) == (("id",), "write_date", "2020-01-01")
    assert (contract.version, contract.selected, contract.destination_sync_mode) == ("_dlt_load_id", False, "merge")
    nested = contract.nested_schema().simpleString()
    assert nested == (
        "struct<id:bigint,amount:double,write_date:string,tags:array<string>,"
        "lines:array<struct<sku:string,type:string>>,customer:struct<id:bigint,extra:string>,odd:string>"
    )
    landed = contract.landing_schema().simpleString()
    assert landed == (
        "struct<id:bigint,amount:double,write_date:timestamp_ntz,tags:string,lines:array<string>,customer:string,"
        "odd:string,_dlt_load_id:string,_dlt_id:string,year:int,month:int,day:int>"
    )


def test_items_with_properties():
    fields = {"a": {"type": "array", "items": {"type": "object", "properties": {"x": {"type": "boolean"}}}}}
    assert nested_struct(fields).simpleString() == "struct<a:array<struct<x:boolean>>>"


def test_projection_and_parsing(spark):
    contract = StreamContract.from_json("odoo", TEXT)
    df = spark.createDataFrame([(1, 2.0, "x")], "id long, amount double, other string")
    assert contract.project(df).columns == ["id", "amount"]
    raw = spark.createDataFrame([(7, '{"id":1,"customer":{"id":5},"lines":[{"sku":"s"}]}')], "n int, record string")
    row = contract.parse(raw, "record").first()
    assert (row["n"], row["id"], row["customer"]["id"], row["lines"][0]["sku"], row["amount"]) == (7, 1, 5, "s", None)


def test_built_in_contracts():
    assert len(CONTRACTS) == 12
    for contract in CONTRACTS.values():
        assert "id" in contract.fields
        assert isinstance(contract.landing_schema(), T.StructType)
        assert all(f.nullable for f in contract.nested_schema().fields)


RECORDS = [
    '{"n":1,"mixed":1,"price":2,"at":"2024-01-01T10:00:00Z","note":"2024","o":{"k":1},"a":[1],"b":true,"nothing":null}',
    '{"n":2,"mixed":"x","price":2.5,"at":"2024-01-02 10:00:00","note":"free text","nothing":null}',
    '{"n":3,"at":null,"late":5}',
]


@pytest.fixture()
def sample(spark):
    return spark.createDataFrame(list(enumerate(RECORDS)), "pos int, record string")


def found(df):
    return {r["field"]: (r["type"], r["format"], r["present"]) for r in df.collect()}


def test_inference_widens(sample):
    assert found(infer_fields(sample, "record")) == {
        "n": ("integer", None, 3),
        "mixed": ("string", None, 2),
        "price": ("number", None, 2),
        "at": ("string", "date-time", 3),
        "note": ("string", None, 2),
        "o": ("object", None, 1),
        "a": ("array", None, 1),
        "b": ("boolean", None, 1),
        "nothing": ("string", None, 2),
        "late": ("integer", None, 1),
    }


def test_inference_by_the_first_record(sample):
    fields = found(infer_fields(sample, "record", first_only=F.col("pos")))
    assert fields["mixed"] == ("integer", None, 2)
    assert fields["price"] == ("integer", None, 2)
    assert fields["at"] == ("string", "date-time", 3)


def test_nested_inference_and_schemas_both_ways(spark):
    records = [
        '{"id":1,"o":{"a":"2024-01-02T03:04:05Z","b":[1,2.5]},"l":[{"x":true},{"x":null,"y":"t"}]}',
        '{"id":2,"o":{"a":"2024-01-02T03:04:05Z","c":{}},"l":[]}',
    ]
    df = spark.createDataFrame([(r,) for r in records], "record string")
    found = {(r.field, r.type, r.format) for r in infer_nested(df, "record").collect()}
    assert found == {
        ("id", "integer", None), ("o", "object", None), ("o.a", "string", "date-time"), ("o.b", "array", None), ("o.b[]", "number", None),
        ("o.c", "object", None), ("l", "array", None), ("l[]", "object", None), ("l[].x", "boolean", None), ("l[].y", "string", None),
    }
    fields = fields_of(list(found))
    assert fields["o"]["properties"]["b"]["items"] == {"type": "number"} and fields["l"]["items"]["properties"]["x"] == {"type": "boolean"}
    schema = json_schema(fields)
    assert schema["properties"]["o"]["properties"]["a"] == {"type": ["null", "string"], "format": "date-time"}
    assert fields_from_json_schema(schema) == fields
    rows = StreamContract("s", "t", fields).parse(df, "record")
    assert [r.id for r in rows.collect()] == [1, 2]


def test_nested_inference_reads_the_records_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def kinds(records):
        df = spark.createDataFrame([(r,) for r in records], "record string").mapInArrow(counted, "record string")
        return {(r.field, r.type, r.present) for r in infer_nested(df, "record").collect()}

    found = kinds(['{"a":{"b":[{"c":1},null,[]]},"e":null}', '{"a":{"b":{}}}', None])
    assert found == {
        ("a", "object", 2), ("a.b", "string", 2), ("a.b[]", "string", 3), ("a.b[].c", "integer", 1), ("e", "string", 1),
    }
    assert read.value == 3
    deep = '{"k":' * 11 + "[[7]]" + "}" * 11
    names = [".".join(["k"] * n) for n in range(1, 12)]
    assert {f for f, _, _ in kinds([deep])} == {*names, names[-1] + "[]", names[-1] + "[][]"}


def test_records_that_are_no_objects_are_an_error(spark):
    for bad in ("oops", "[1]", '{"a":1,"a":2}'):
        df = spark.createDataFrame([('{"a":1}',), (bad,)], "record string")
        with pytest.raises(Exception, match="no JSON object"):
            infer_fields(df, "record").collect()
