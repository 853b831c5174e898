"""Columns over file paths: natural order and the date in a hive-style path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the layout of dated folders.
DATED_FOLDER = r"year=(\d+)/month=(\d+)/day=(\d+)"


def natural_key(text: Column) -> Column:
    """Sort key under which runs of digits compare as numbers (``part_9`` before ``part_10``).

    An array of alternating text and number parts, numbers zero-padded; text always
    comes first, so a leading number is preceded by an empty part.
    """
    parts = F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1))
    padded = F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), _padded(p)).otherwise(p))
    return F.when(text.rlike(r"^\d"), F.concat(F.array(F.lit("")), padded)).otherwise(padded)


def _padded(digits: Column) -> Column:
    bare = F.regexp_replace(digits, r"^0+(?=\d)", "")
    # the length in front keeps numbers of any size in order
    return F.concat(F.lpad(F.length(bare).cast("string"), 6, "0"), F.lit(":"), bare)


def partition_date(path: Column) -> Column:
    """Date named by the dated folders of a path, NULL if there is none."""
    year, month, day = (F.regexp_extract(path, DATED_FOLDER, i) for i in (1, 2, 3))
    text = F.concat_ws("-", year, _two_digits(month), _two_digits(day))
    return F.when(path.rlike(DATED_FOLDER), text.try_cast("date"))


def date_label(path: Column) -> Column:
    """``YYYY-MM-DD`` of a dated path, else the file name."""
    year, month, day = (F.regexp_extract(path, DATED_FOLDER, i) for i in (1, 2, 3))
    padded = F.concat_ws("-", year, _two_digits(month), _two_digits(day))
    return F.when(path.rlike(DATED_FOLDER), padded).otherwise(F.element_at(F.split(path, "/"), -1))


def _two_digits(text: Column) -> Column:
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)
