"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns with the path of the file a landing row came from, and its position in there.
SOURCE_FILE = "_source_file"
SOURCE_ROW = "_source_row"


def row_hash(df: DataFrame) -> Column:
    """Hash over all columns that can be hashed."""
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*[F.col(f"`{name}`") for name in hashable])


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    version: str | Sequence[str],
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key: the one with the highest version, NULL versions last.

    Equal versions are settled by file path and position in the file, last one first, so a
    rerun gives the same row. Rows without a position are settled by a hash of the whole
    row, which needs all columns. ``row_number() = 1`` lets Spark limit each map task to one
    row per key before the shuffle, which keeps a hot key small.
    """
    versions = [version] if isinstance(version, str) else list(version)
    order = [F.col(v).desc_nulls_last() for v in versions]
    if tiebreak is None:
        tiebreak = [F.col(c).desc() for c in (SOURCE_FILE, SOURCE_ROW) if c in df.columns]
        if SOURCE_ROW not in df.columns:
            tiebreak.append(row_hash(df))
    window = Window.partitionBy(*keys).orderBy(*order, *tiebreak)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
