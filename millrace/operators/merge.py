"""Keyed replacement of rows, as plain DataFrame algebra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

def key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys; the partial aggregation shrinks a hot key before it is shuffled."""
    return df.select(*keys).distinct()


def replaced_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows that an upsert of the batch would remove: those with one of its keys. NULL keys
    match nothing. A side that turns out small is broadcast, and a hot key of plain scans split, by
    adaptive execution."""
    return target.join(key_set(batch, keys), list(keys), "left_semi")
