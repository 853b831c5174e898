from millrace.functions.paths import date_label, natural_key, partition_date
from millrace.functions.payload import (
    json_text,
    json_texts,
    malformed,
    to_bigint,
    to_boolean,
    to_double,
    to_money,
)

__all__ = [
    "date_label",
    "json_text",
    "json_texts",
    "malformed",
    "natural_key",
    "partition_date",
    "to_bigint",
    "to_boolean",
    "to_double",
    "to_money",
]
