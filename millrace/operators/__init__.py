from millrace.operators.dedupe import latest_per_key
from millrace.operators.flatten import explode_text_array, flatten_order_items
from millrace.operators.increment import (
    changed_left_join,
    high_water_mark,
    newer_than,
    newer_than_target,
)
from millrace.operators.merge import replaced_rows

__all__ = [
    "changed_left_join",
    "explode_text_array",
    "flatten_order_items",
    "high_water_mark",
    "latest_per_key",
    "newer_than",
    "newer_than_target",
    "replaced_rows",
]
