"""Row predicates used by the null flag, the blank filter and the rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    MapType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Types whose text form is never empty or all spaces: only NULL can fail.
_NEVER_BLANK = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)

from flatgate.operators.flatten import col_of, quote


def parse_columns(spec: str | Sequence[str]) -> list[str]:
    """``"a, b"`` or ``["a", "b"]`` -> ``["a", "b"]``; names are trimmed
    and an empty list is refused (an empty OR-fold has no meaning)."""
    items = spec.split(",") if isinstance(spec, str) else list(spec)
    cols = [c.strip() for c in items if c is not None and c.strip()]
    if not cols:
        raise ValueError(f"no column names in {spec!r}")
    return cols


def any_null(columns: Iterable[str]) -> Column:
    """True when ANY listed column IS NULL. Blank text is not null here.
    Never NULL itself. (Built as SQL text: one driver->JVM call however
    many columns.)"""
    cols = list(columns)
    if not cols:
        raise ValueError("any_null needs at least one column")
    return F.expr(" OR ".join(f"{quote(c)} IS NULL" for c in cols))


def is_blank(c: str | Column) -> Column:
    """NULL, or text that is empty after stripping whitespace (Unicode
    spaces, tabs and newlines included)."""
    c = col_of(c) if isinstance(c, str) else c
    return c.isNull() | c.cast("string").rlike(r"(?U)^\s*$")


def _failure_sql(name: str, dt: DataType | None) -> str:
    q = quote(name)
    if isinstance(dt, (ArrayType, MapType)):
        return f"({q} IS NULL OR size({q}) = 0)"
    if isinstance(dt, (StructType, BinaryType) + _NEVER_BLANK):
        # TRIM(text) = '' can never hold for these (NaN reads 'NaN'): skip
        # the cast to text, which would cost more than the whole test
        return f"({q} IS NULL)"
    text = q if isinstance(dt, StringType) else f"CAST({q} AS STRING)"
    # TRIM removes the space character only: a lone tab passes
    return f"({q} IS NULL OR trim({text}) = '')"


def not_null_failure_sql(columns: Iterable[str], types: dict[str, DataType] | None = None) -> str:
    """SQL text of ``not_null_failure``."""
    types = types or {}
    cols = list(columns)
    if not cols:
        raise ValueError("not_null_failure needs at least one column")
    return " OR ".join(_failure_sql(c, types.get(c)) for c in cols)


def not_null_failure(columns: Iterable[str], types: dict[str, DataType] | None = None) -> Column:
    """P5: the not-null rule's failure test, ``c IS NULL OR TRIM(c) = ''``
    OR-ed over the columns. Non-text columns are compared through their text
    form; arrays and maps fail when null or empty."""
    return F.expr(not_null_failure_sql(columns, types))
