"""Column-set operators: merge matching columns, keep a whitelist, keep the
first row per key."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from flatgate.functions.text import merge_values
from flatgate.operators.flatten import col_of, quote


def refuse_column(df: DataFrame, out: str) -> None:
    """An output column must not replace a column of the data."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the data has a column {out!r}: name another output column")


def _orderable(dt: DataType) -> bool:
    if isinstance(dt, ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return not isinstance(dt, (MapType, VariantType))


def tie_break_sql(df: DataFrame) -> str:
    """A number that decides between rows of equal order, the same one in
    every run (rows that differ in maps only may still tie)."""
    names = [quote(f.name) for f in df.schema.fields if _orderable(f.dataType)]
    return f"xxhash64({', '.join(names)})" if names else "0L"


def merge_columns(df: DataFrame, pattern: str, out: str, sep: str = ",") -> DataFrame:
    """``out`` = values of the columns whose names fully match ``pattern``
    (in the frame's column order), joined by ``sep``, nulls skipped."""
    refuse_column(df, out)
    rx = re.compile(pattern)
    matched = [c for c in df.columns if rx.fullmatch(c)]
    return df.withColumn(out, merge_values(matched, sep))


def merge_array_field(df: DataFrame, array_col: str, field: str | None, out: str, sep: str = ",") -> DataFrame:
    """F7 on the nested form: join one field of every element of an array
    (nulls skipped). Same result as positional flatten + ``merge_columns``
    with a pattern admitting every index, without materialising one column
    per position."""
    refuse_column(df, out)
    arr = col_of(array_col)
    vals = F.transform(arr, lambda x: (x if field is None else x.getField(field)).cast("string"))
    return df.withColumn(out, F.coalesce(F.array_join(vals, sep), F.lit("")))


def keep_known(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """F8: project the whitelisted columns that exist, in the frame's own
    order; absent names are ignored."""
    wanted = set(names)
    return df.select(*[col_of(c) for c in df.columns if c in wanted])


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """one row per key, the one first by ``order_by``: a NULL order
    value comes before all others (as in an ascending sort), and rows of
    equal order are decided by a hash of the row. NULL keys group together.

    Written as an aggregation with ``min_by`` rather than a window: the
    aggregate is combined map-side, so a key holding a third of all rows
    (exact copies) still shrinks to one candidate per task before the
    shuffle, where a window would sort the whole group in one task.

    A row-valued ``min_by`` buffer is variable-length, so Spark aggregates
    by sorting; a 64-bit hash of the keys is put first in the grouping so
    those sorts are decided on an 8-byte prefix instead of comparing long
    texts. The keys stay in the grouping, so hash collisions cannot merge
    different keys.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*[col_of(k) for k in keys]).distinct()
    order = [c if isinstance(c, Column) else F.expr(quote(c)) for c in order_by]
    # a struct is never NULL, so a row whose order values are is not passed over
    ord_key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.expr(tie_break_sql(df)).alias("tie"))
    # SQL text for the wide parts (one driver->JVM call, however many columns)
    key_list = ", ".join(quote(k) for k in keys)
    row = F.expr("struct(" + ", ".join(quote(c) for c in rest) + ")")
    picked = df.groupBy(F.expr(f"xxhash64({key_list})").alias("__fg_h"), *[F.expr(quote(k)) for k in keys]).agg(
        F.min_by(row, ord_key).alias("__fg_row")
    )
    return picked.selectExpr(*[f"{quote(c)}" if c in keys else f"__fg_row.{quote(c)} AS {quote(c)}" for c in df.columns])


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int = 100) -> DataFrame:
    """K6: the first ``n`` rows in a stated order (top-k, no full sort:
    Spark plans ``TakeOrderedAndProject``)."""
    return df.orderBy(*order_by).limit(n)
