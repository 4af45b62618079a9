"""Column expressions (all JVM-side built-ins, no Python per row)."""

from flatgate.functions.predicates import any_null, is_blank, not_null_failure, parse_columns
from flatgate.functions.text import merge_values, route_label, run_stamp

__all__ = [
    "any_null",
    "is_blank",
    "not_null_failure",
    "parse_columns",
    "merge_values",
    "route_label",
    "run_stamp",
]
