"""JSON payload columns: text by path, exact casts, detection of malformed text."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


def payload(df: DataFrame, name: str) -> Column:
    """The column as JSON text; nested columns are serialised, text is taken as it is."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name)
    return F.to_json(F.col(name))


def json_text(json: Column, path: str) -> Column:
    """Text at a dotted path; objects come back as compact JSON, JSON null as NULL."""
    return F.get_json_object(json, "$." + path)


def _text_schema(paths: Sequence[str]) -> T.StructType:
    heads: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        heads.setdefault(head, []).append(rest)
    fields = []
    for head, rests in heads.items():
        nested = [r for r in rests if r]
        if nested and len(nested) != len(rests):
            raise ValueError(f"'{head}' is asked for both as a whole and by field")
        fields.append(T.StructField(head, _text_schema(nested) if nested else T.StringType()))
    return T.StructType(fields)


def json_texts(json: Column, paths: Sequence[str], strict: bool = False) -> dict[str, Column]:
    """Text at many paths of one payload, parsed once for all of them; objects as compact JSON.

    ``strict`` fails the job on text that is no JSON. Text is parsed a second time for that only
    where nothing was found, or where something follows the object.

    The explicit mode (the default one) keeps the optimizer from narrowing the schema for
    each path by itself, which would turn one shared parse into one per path.
    """
    schema = _text_schema(paths)
    # In brackets the parser reads on behind the first value.
    listed = F.from_json(F.concat(F.lit("["), json, F.lit("]")), T.ArrayType(schema), {"mode": "PERMISSIVE"})
    parsed = F.get(listed, F.lit(0)) if strict else F.from_json(json, schema, {"mode": "PERMISSIVE"})

    def at(whole: Column, path: str) -> Column:
        for part in path.split("."):
            whole = whole.getField(part)
        return whole

    if strict:
        # The check goes with the whole parse, so no choice of columns prunes it away.
        nothing = functools.reduce(lambda a, b: a & b, [at(parsed, path).isNull() for path in paths])
        trailing = listed.isNull() | (F.size(listed) != 1) | ~F.endswith(F.rtrim(json), F.lit("}"))
        parsed = or_raise(json, parsed, nothing | trailing)
    return {path: at(parsed, path) for path in paths}


def or_raise(json: Column, value: Column, suspicious: Column | None = None) -> Column:
    """The value, or an error where there is none because the text is no JSON.

    The text is looked at again only where the result is suspicious (NULL by default).
    """
    if suspicious is None:
        suspicious = value.isNull()
    message = F.concat(F.lit("malformed JSON: "), F.substring(json, 1, 80))
    return F.when(suspicious & malformed(json), F.raise_error(message)).otherwise(value)


def to_money(column: Column) -> Column:
    return column.cast(MONEY)


def to_double(column: Column) -> Column:
    return column.cast("double")


def to_boolean(column: Column) -> Column:
    return column.cast("boolean")


def to_bigint(column: Column) -> Column:
    """Integer from text; a fraction is rounded half up ('12.7' gives 13) and not refused."""
    return F.round(column.cast("decimal(38,6)")).cast("bigint")


def malformed(json: Column) -> Column:
    """True where text is present but is no JSON.

    A parser stops behind the first value; inside brackets and inside an object whatever follows
    it is looked at too, and no text passes as a part of both.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), json, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), json, F.lit("}")))
    return json.isNotNull() & (listed.isNull() | named.isNull())


def any_malformed(columns: Sequence[str]) -> Column:
    """True where one of the columns holds text that is no JSON."""
    return functools.reduce(lambda a, b: a | b, [malformed(F.col(name)) for name in columns], F.lit(False))


def split_malformed(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows)."""
    bad = any_malformed(columns)
    return df.filter(~bad), df.filter(bad)
