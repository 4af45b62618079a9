"""Pipeline D: documents -> numbered columns -> merged fingerprint ->
whitelisted columns -> first row per key.

The single-machine tool this replaces loaded a JSON list into one process;
here every step is a DataFrame operator: a projection per document (no
shuffle) and one map-side-combined aggregation for the keep-first step.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame

from flatgate.operators.columns import dedup_keep_first, keep_known, merge_columns
from flatgate.operators.flatten import flatten_positional


def positional_report(
    df: DataFrame,
    merge_pattern: str,
    merge_out: str,
    keep: Iterable[str],
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    exclude: Iterable[str] = (),
    max_items: int | None = None,
    sep: str = "_",
) -> DataFrame:
    flat = flatten_positional(df, max_items=max_items, exclude=exclude, sep=sep)
    merged = merge_columns(flat, merge_pattern, merge_out)
    kept = keep_known(merged, list(keep) + [merge_out])
    return dedup_keep_first(kept, keys, order_by)
