"""Increments by high-water mark."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import work_dir


def as_text(column: Column, kind: T.DataType) -> Column:
    """A value as text that casts back to the same value in a session of any time zone."""
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return column.cast("string")


def high_water_mark(df: DataFrame, column: str) -> str | None:
    """Largest value of a column as text, None for an empty table. One row reaches the driver."""
    largest = as_text(F.max(column), df.schema[column].dataType)
    return df.agg(largest.alias("mark")).first()["mark"]


def newer_than(df: DataFrame, column: str, mark: str | None) -> Column:
    """Strictly above the mark; a missing mark admits nothing.

    The mark becomes a literal of the column's own type, so that the comparison reaches
    the Parquet scan.
    """
    if mark is None:
        return F.lit(False)
    return df[column] > F.lit(mark).cast(df.schema[column].dataType)


def newer_than_target(df: DataFrame, target: DataFrame, column: str) -> DataFrame:
    return df.filter(newer_than(df, column, high_water_mark(target, column)))


def value_range(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Aggregates ``low_<column>`` and ``high_<column>``, as text."""
    kinds = {c: df.schema[c].dataType for c in columns}
    low = [as_text(F.min(c), kind).alias(f"low_{c}") for c, kind in kinds.items()]
    return low + [as_text(F.max(c), kind).alias(f"high_{c}") for c, kind in kinds.items()]


def key_range(df: DataFrame, keys: Sequence[str]) -> dict[str, tuple[str, str]] | None:
    """Least and greatest value of each key as text; None if a key has no value at all."""
    row = df.agg(*value_range(df, keys)).first()
    if any(row[f"low_{k}"] is None for k in keys):
        return None
    return {k: (row[f"low_{k}"], row[f"high_{k}"]) for k in keys}


def in_range(df: DataFrame, bounds: dict[str, tuple[str, str]] | None) -> Column:
    """Inside the range, by comparisons that Parquet statistics can answer; no range holds nothing."""
    inside = F.lit(bounds is not None)
    for key, (low, high) in (bounds or {}).items():
        kind = df.schema[key].dataType
        inside = inside & F.col(key).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    return inside


def within(df: DataFrame, bounds: dict[str, tuple[str, str]] | None) -> DataFrame:
    return df.filter(in_range(df, bounds))


def changed_keys(sides: Sequence[tuple[DataFrame, str, str]], key: str, mark: str | None) -> DataFrame:
    """Different keys of rows above the mark in any side (rows, their key, their version), written
    as a table with the column ``key``. Only keys and versions are read, and the mark reaches the scans."""
    found = functools.reduce(
        DataFrame.unionByName,
        [df.filter(newer_than(df, version, mark)).select(F.col(name).alias(key)) for df, name, version in sides],
    ).distinct()
    path = work_dir(found.sparkSession, "changed")
    found.write.parquet(path)
    return found.sparkSession.read.schema(found.schema).parquet(path)


def of_keys(df: DataFrame, key: str, changed: DataFrame) -> DataFrame:
    """Rows whose key is in a one-column table; NULL is a key like others. The table is small against
    ``df`` or it is not: adaptive execution broadcasts it by its measured size or joins by shuffle, and
    a dedupe by the same key that follows needs no further one."""
    (other,) = changed.columns
    return df.join(changed, df[key].eqNullSafe(changed[other]), "left_semi")


def changed_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_version: str,
    right_version: str,
    mark: str | None,
    stored: bool = False,
) -> DataFrame:
    """``left`` left-joined to ``right``, only rows where either side is above the mark.

    Same rows as filtering the full join by ``left_version > mark OR right_version > mark``,
    for a key that is unique on both sides. That filter would sit above an outer join of
    the two whole tables; here the changed keys are found first and written, and each input is
    read a second time for the rows of those keys only. For ``stored`` inputs the keys' range
    lets the scans skip all row groups outside it. The right side's columns must not clash with
    the left's, apart from the key.
    """
    left_new = newer_than(left, left_version, mark)
    keys = left.filter(left_new).select(key).unionByName(right.filter(newer_than(right, right_version, mark)).select(key))
    path = work_dir(left.sparkSession, "changed")
    keys.distinct().write.parquet(path)
    changed = left.sparkSession.read.schema(T.StructType([left.schema[key]])).parquet(path)
    if stored:
        bounds = key_range(changed, [key])
        right = within(right, bounds)
        left = left.filter(F.col(key).isNull() | in_range(left, bounds))
    # a row without a key is of nobody else's: it counts only if it is new itself
    found = left.join(changed, left[key].eqNullSafe(changed[key]), "left_semi")
    found = found.filter(F.col(key).isNotNull() | newer_than(found, left_version, mark))
    return found.join(right.join(changed, key, "left_semi"), key, "left")
