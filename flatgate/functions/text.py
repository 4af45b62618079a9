"""Text expressions: routing labels, run stamps, merged values, HTML."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from flatgate.operators.flatten import col_of, quote

# The routing labels of the arrival handler, in priority order.
DEFAULT_ROUTE_LABELS = ("BalanceSheet", "Invoices")

# Fixed value: run stamp format (year month day hour minute second, no separators).
RUN_STAMP_FORMAT = "yyyyMMddHHmmss"
# Fixed value: time format printed at the foot of the HTML report.
REPORT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def route_label(c: str | Column, labels: Sequence[str] = DEFAULT_ROUTE_LABELS) -> Column:
    """First label contained in the name (case-insensitive) wins, else
    the name itself."""
    c = col_of(c) if isinstance(c, str) else c
    low = F.lower(c)
    out = None
    for label in labels:
        cond = low.contains(label.lower())
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return c if out is None else out.otherwise(c)


def run_stamp(ts: str | Column) -> Column:
    """``yyyyMMddHHmmss`` text of a timestamp."""
    ts = col_of(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, RUN_STAMP_FORMAT)


def merge_values(cols: Iterable[str | Column], sep: str = ",") -> Column:
    """F7 core: values joined by ``sep``; nulls are skipped (never the text
    ``None``)."""
    cols = list(cols)
    if not cols:
        return F.lit("")
    if all(isinstance(c, str) for c in cols):
        # SQL text: one driver->JVM call however many columns match
        sep_sql = sep.replace("\\", "\\\\").replace("'", "\\'")
        return F.expr(f"concat_ws('{sep_sql}', " + ", ".join(f"CAST({quote(c)} AS STRING)" for c in cols) + ")")
    return F.concat_ws(sep, *[(col_of(c) if isinstance(c, str) else c).cast("string") for c in cols])


def html_escape_sql(expr: str) -> str:
    """SQL text escaping ``& < > " '`` in the text of ``expr``."""
    out = f"CAST({expr} AS STRING)"
    for raw, esc in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = f"replace({out}, '{raw.replace(chr(39), chr(39) * 2)}', '{esc}')"
    return out
