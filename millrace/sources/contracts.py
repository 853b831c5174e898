"""Stream contracts: which fields a stream carries, their types, keys and sync modes."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import work_dir

#: Levels below the first that nested inference looks at in its first pass.
DEPTH = 4
SCALARS = {
    "integer": T.LongType(),
    "number": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
}


def plain_type(declared: Any) -> str:
    """The type of a field definition; of a union such as ["null", T] the first real one."""
    if isinstance(declared, list):
        real = [t for t in declared if t != "null"]
        return real[0] if real else "string"
    return declared or "string"


def _is_fields(items: Any) -> bool:
    return isinstance(items, Mapping) and bool(items) and all(isinstance(v, Mapping) for v in items.values())


def nested_type(definition: Mapping[str, Any]) -> T.DataType:
    """Nullable Spark type of a field definition, objects and arrays unfolded."""
    kind = plain_type(definition.get("type"))
    if kind == "object":
        properties = definition.get("properties")
        return nested_struct(properties) if properties else T.StringType()
    if kind == "array":
        items = definition.get("items")
        if isinstance(items, Mapping) and plain_type(items.get("type")) == "object" and _is_fields(items.get("properties")):
            return T.ArrayType(nested_struct(items["properties"]))
        if _is_fields(items):
            return T.ArrayType(nested_struct(items))
        return T.ArrayType(nested_type(items) if isinstance(items, Mapping) else T.StringType())
    return SCALARS.get(kind, T.StringType())


def nested_struct(fields: Mapping[str, Mapping[str, Any]]) -> T.StructType:
    return T.StructType([T.StructField(name, nested_type(d)) for name, d in fields.items()])


@dataclass(frozen=True)
class StreamContract:
    source: str
    stream: str
    fields: Mapping[str, Mapping[str, Any]]
    primary_key: Sequence[str] = ("id",)
    cursor_field: str | None = None
    sync_mode: str = "incremental"
    destination_sync_mode: str = "append"
    initial_value: str | None = None
    selected: bool = True
    #: Columns the loader adds; the first one orders the versions of a record.
    metadata: Sequence[str] = ("_airbyte_extracted_at",)
    options: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_json(cls, source: str, text: str) -> StreamContract:
        """Read the contract format of the stream folders (one JSON file per stream)."""
        raw = json.loads(text)
        key = [part[-1] if isinstance(part, list) else part for part in raw.get("primary_key") or ["id"]]
        cursor = raw.get("cursor_field") or [None]
        extracted = raw.get("connector") == "dlt"
        return cls(
            source=source,
            stream=raw["stream"],
            fields=raw.get("fields", {}),
            primary_key=tuple(key),
            cursor_field=cursor[-1] if isinstance(cursor, list) else cursor,
            sync_mode=raw.get("sync_mode", "incremental"),
            destination_sync_mode=raw.get("destination_sync_mode", "append"),
            initial_value=raw.get("initial_value"),
            selected=raw.get("selected", True),
            metadata=("_dlt_load_id", "_dlt_id") if extracted else ("_airbyte_extracted_at",),
            options={k: raw[k] for k in ("connector", "schedule", "backfill") if k in raw},
        )

    @property
    def version(self) -> str:
        return self.metadata[0]

    def nested_schema(self) -> T.StructType:
        """Schema of a whole record as JSON, for ``from_json``."""
        return nested_struct(self.fields)

    def landing_schema(self) -> T.StructType:
        """Schema of landing files: objects and arrays of scalars as JSON text, arrays of
        objects as arrays of JSON text, then the loader's and the partition columns."""
        columns = [T.StructField(name, self._landed_type(d)) for name, d in self.fields.items()]
        for name in self.metadata:
            kind = T.TimestampNTZType() if name.endswith("_at") else T.StringType()
            columns.append(T.StructField(name, kind))
        columns += [T.StructField(name, T.IntegerType()) for name in ("year", "month", "day")]
        return T.StructType(columns)

    @staticmethod
    def _landed_type(definition: Mapping[str, Any]) -> T.DataType:
        kind = plain_type(definition.get("type"))
        if kind == "array":
            element = nested_type(definition).elementType
            return T.ArrayType(T.StringType()) if isinstance(element, T.StructType) else T.StringType()
        if kind == "string" and definition.get("format") == "date-time" and not definition.get("as_text"):
            return T.TimestampNTZType()
        return SCALARS.get(kind, T.StringType())

    def project(self, df: DataFrame) -> DataFrame:
        """Only the contract's fields, those that are there."""
        return df.select(*[name for name in self.fields if name in df.columns])

    def parse(self, df: DataFrame, column: str) -> DataFrame:
        """JSON records to typed columns of the contract, NULL where a field is missing."""
        record = F.from_json(F.col(column), self.nested_schema()).alias("_record")
        others = [c for c in df.columns if c != column]
        return df.select(*others, record).select(*others, "_record.*")


def _variant_kind(kind: Column) -> Column:
    """Contract type for a variant's schema text."""
    return (
        F.when(kind.isin("BIGINT"), "integer")
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "number")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .otherwise("string")
    )


def _looks_like_time(text: Column) -> Column:
    return (F.length(text) >= 19) & text.rlike("[T ]") & F.try_to_timestamp(text).isNotNull()


def _entries(df: DataFrame, column: str, position: Column) -> DataFrame:
    """``pos, field, value``: the fields of JSON records. A record that is no JSON object, or names a
    field twice, fails the job; take such records out before (``split_malformed``)."""
    record = F.try_variant_get(F.try_parse_json(F.col(column)), "$", "map<string,variant>")
    message = F.concat(F.lit("no JSON object: "), F.substring(column, 1, 80))
    checked = F.when(F.col(column).isNotNull() & record.isNull(), F.raise_error(message)).otherwise(record)
    return df.select(position.alias("pos"), F.explode(checked).alias("field", "value"))


def _described(rows: DataFrame, first_only: bool) -> DataFrame:
    """``field, type, format, present`` of ``pos, field, value`` rows, one row a field."""
    schema = F.schema_of_variant(F.col("value"))
    text = F.when(schema == "STRING", F.try_variant_get("value", "$", "string"))
    typed = rows.select(
        "field",
        "pos",
        schema.alias("schema"),
        _variant_kind(schema).alias("kind"),
        F.coalesce(_looks_like_time(text), F.lit(False)).alias("time"),
    )
    if first_only:
        chosen = F.min_by(F.struct("kind", "time"), "pos")
        found = typed.groupBy("field").agg(chosen.alias("c"), F.count(F.lit(1)).alias("present"))
        kind, time = F.col("c.kind"), F.col("c.time")
    else:
        real = F.when(F.col("schema") != "VOID", F.col("kind"))
        found = typed.groupBy("field").agg(
            F.collect_set(real).alias("kinds"),  # at most one entry per contract type
            F.bool_and(F.when(F.col("schema") != "VOID", F.col("time"))).alias("all_time"),
            F.count(F.lit(1)).alias("present"),
        )
        numeric = F.forall("kinds", lambda k: k.isin("integer", "number"))
        kind = (
            F.when(F.size("kinds") == 1, F.element_at("kinds", 1))
            .when((F.size("kinds") > 1) & numeric, "number")
            .otherwise("string")
        )
        time = F.coalesce(F.col("all_time"), F.lit(False))
    return found.select(
        "field",
        kind.alias("type"),
        F.when((kind == "string") & time, "date-time").alias("format"),
        "present",
    )


def infer_fields(df: DataFrame, column: str, first_only: Column | None = None) -> DataFrame:
    """Field definitions found in JSON records: ``field, type, format, present``.

    Types are widened over all records: integer and number give number, any other mixture
    gives string; a field that is always null is a string. With ``first_only`` (an order of
    the records) the first record that holds a field decides alone, null meaning string.
    A record that is no JSON object fails the job.
    """
    position = first_only if first_only is not None else F.lit(0)
    return _described(_entries(df, column, position), first_only is not None)


def infer_nested(df: DataFrame, column: str) -> DataFrame:
    """The same for all depths: ``a.b`` is property b of the objects in a, ``a[]`` an item of the
    arrays in a. ``present`` counts occurrences. All levels are found in one pass over the records; if some
    go deeper than it looks, in another one that looks twice as deep."""
    depth = DEPTH
    while True:
        level, deeper = _entries(df, column, F.lit(0)).withColumn("last", F.lit(True)), Observation()
        for _ in range(depth):
            level = level.select("pos", F.inline(_with_parts()))
        seen = level.observe(deeper, F.bool_or(F.col("last") & (F.size(_parts()) > 0)).alias("any"))
        described, path = _described(seen, False), work_dir(df.sparkSession, "fields")
        described.write.parquet(path)
        if not deeper.get["any"]:
            return df.sparkSession.read.schema(described.schema).parquet(path)
        depth *= 2


def _parts() -> Column:
    """``field, value, last`` of the properties or items in a value; empty for any other."""
    field, none = F.col("field"), F.array().cast("array<struct<field:string,value:variant,last:boolean>>")

    def part(name: Column, value: Column) -> Column:
        return F.struct(name.alias("field"), value.alias("value"), F.lit(True).alias("last"))

    properties = F.map_entries(F.try_variant_get("value", "$", "map<string,variant>"))
    items = F.try_variant_get("value", "$", "array<variant>")
    named = F.transform(properties, lambda p: part(F.concat_ws(".", field, p["key"]), p["value"]))
    return F.coalesce(named, F.transform(items, lambda i: part(F.concat(field, F.lit("[]")), i)), none)


def _with_parts() -> Column:
    """A value and, if it is one of the deepest so far, what it holds, which then are the deepest."""
    itself = F.array(F.struct("field", "value", F.lit(False).alias("last")))
    return F.when(F.col("last"), F.concat(itself, _parts())).otherwise(itself)


def fields_of(rows: Sequence[tuple[str, str, str | None]]) -> dict[str, dict[str, Any]]:
    """Contract fields from ``(path, type, format)`` rows of :func:`infer_nested`."""
    fields: dict[str, dict[str, Any]] = {}
    for path, kind, form in sorted(rows, key=lambda r: len(r[0])):
        definition = {"type": kind} | ({"format": form} if form else {})
        parent, at = {"properties": fields}, path
        while True:
            name, found, rest = re.match(r"([^.\[]*)(\[\]|\.)?(.*)", at, re.S).groups()
            if name:
                if not found:
                    parent.setdefault("properties", {})[name] = definition
                    break
                parent = parent["properties"][name]
            if found == "[]":
                if not rest:
                    parent["items"] = definition
                    break
                parent = parent["items"]
            at = rest
    return fields


def _property(definition: Mapping[str, Any]) -> dict[str, Any]:
    out = {"type": ["null", plain_type(definition.get("type")) or "string"]}
    if definition.get("format"):
        out["format"] = definition["format"]
    if definition.get("properties"):
        out["properties"] = {name: _property(d) for name, d in definition["properties"].items()}
    items = definition.get("items")
    if _is_fields(items):  # fields of the items, without a type of their own
        out["items"] = {"type": ["null", "object"], "properties": {name: _property(d) for name, d in items.items()}}
    elif isinstance(items, Mapping):
        out["items"] = _property(items)
    return out


def json_schema(fields: Mapping[str, Mapping[str, Any]]) -> dict[str, Any]:
    """Contract fields as a JSON schema in which everything may be null."""
    return {"type": "object", "properties": {name: _property(d) for name, d in fields.items()}}


def fields_from_json_schema(schema: Mapping[str, Any]) -> dict[str, dict[str, Any]]:
    """Contract fields of a JSON schema's properties."""

    def definition(found: Mapping[str, Any]) -> dict[str, Any]:
        out: dict[str, Any] = {"type": plain_type(found.get("type")) or "string"}
        if found.get("format"):
            out["format"] = found["format"]
        if found.get("properties"):
            out["properties"] = {name: definition(d) for name, d in found["properties"].items()}
        if isinstance(found.get("items"), Mapping):
            out["items"] = definition(found["items"])
        return out

    return {name: definition(d) for name, d in schema.get("properties", {}).items()}
