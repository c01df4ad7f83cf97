"""DataFrame-to-DataFrame operators, usable on tables and on streams alike."""

from millrace.operators.dimension import (
    broadcast_within,
    duplicate_keys,
    join_dimension,
    label_codes,
    unique_keys,
)
from millrace.operators.nested import explode_arrays, flatten
from millrace.operators.parsing import parse_json
from millrace.operators.rows import count_rows, drop_missing, observe_rows

__all__ = [
    "broadcast_within",
    "count_rows",
    "drop_missing",
    "duplicate_keys",
    "explode_arrays",
    "flatten",
    "join_dimension",
    "label_codes",
    "observe_rows",
    "parse_json",
    "unique_keys",
]
