"""Rule results as a report table and as one HTML page per dq_id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatgate.functions.text import REPORT_TIME_FORMAT, html_escape_sql
from flatgate.operators.flatten import quote

# Report column headers, in order.
REPORT_HEADERS = (
    "Spark Application Id",
    "DQ ID",
    "Rule ID",
    "Rule Name",
    "Rule type",
    "Description",
    "Columns/Query",
    "Pass Count",
    "Fail Count",
    "Total Count",
)
# Header row colours of the failed and passed tables.
FAILED_COLOUR = "#FF6347"
PASSED_COLOUR = "#33FFBD"
# The page's texts, in page order.
PAGE_OPEN = "<html><body><P>Team,<br/><br/>Data Quality check finished successfully for <b>DQ ID = "
DQ_ID_CLOSE = "</b>"
WITH_FAILURES = ", with failures. "
WITHOUT_FAILURES = ". "
INTRO_CLOSE = "Check details in below table of metrics.</P>"
FAILED_TITLE = "Failed DQ details"
PASSED_TITLE = "Succeeded DQ details"
EXECUTED_ON = "<br/><br/>Executed on "
PAGE_CLOSE = ",<br/>Thanks</body></html><br/>"

REPORT_COLUMNS = (
    "app_id",
    "dq_id",
    "rule_id",
    "rule_name",
    "rule_type",
    "description",
    "columns_or_query",
    "pass_count",
    "fail_count",
    "total_count",
)


def report_table(results: DataFrame) -> DataFrame:
    """The report's columns, failed rules first, then by rule id (the
    result table has one row per rule, so this sort is tiny)."""
    return results.select(*REPORT_COLUMNS, "status").orderBy(F.col("status") != "fail", "dq_id", "rule_id")


def _table(title: str, colour: str, rows: F.Column) -> F.Column:
    header = " ".join(f"<th>{h}</th>" for h in REPORT_HEADERS)
    return F.concat(
        F.lit(
            f'<h3 style="font-family:arial">{title}</h3>'
            f'<table border="3" style="width:100%"><tr style="text-align:left;background-color:{colour}">{header}</tr>'
        ),
        rows,
        F.lit("</table>"),
    )


def report_html(results: DataFrame, executed_at: F.Column | None = None) -> DataFrame:
    """``(dq_id, html)``: opening line (", with failures" iff any rule
    failed), the red failed table, the green passed table (each omitted
    when empty), closing line with the run time. Values are HTML-escaped.

    The aggregation groups the *result* rows (one per rule), never data
    rows, so each group is as small as the rule set.
    """
    executed_at = executed_at if executed_at is not None else F.current_timestamp()
    # one SQL expression for the whole row (one driver->JVM call)
    cells = ", ".join(f"concat('<td>', coalesce({html_escape_sql(quote(c))}, ''), '</td>')" for c in REPORT_COLUMNS)
    row_html = F.expr(f"concat('<tr>', concat_ws(' ', {cells}), '</tr>')")
    per_rule = results.select(
        "dq_id", "rule_id", "status", row_html.alias("row_html")
    )
    grouped = per_rule.groupBy("dq_id").agg(
        F.array_sort(F.collect_list(F.struct("rule_id", "status", "row_html"))).alias("rows")
    )

    def joined(status: str) -> F.Column:
        return F.array_join(
            F.transform(F.filter("rows", lambda r: r["status"] == status), lambda r: r["row_html"]), " "
        )

    n_failed = F.size(F.filter("rows", lambda r: r["status"] == "fail"))
    n_passed = F.size(F.filter("rows", lambda r: r["status"] == "pass"))
    opening = F.concat(
        F.lit(PAGE_OPEN),
        F.coalesce(F.col("dq_id").cast("string"), F.lit("")),
        F.lit(DQ_ID_CLOSE),
        F.when(n_failed > 0, F.lit(WITH_FAILURES)).otherwise(F.lit(WITHOUT_FAILURES)),
        F.lit(INTRO_CLOSE),
    )
    closing = F.concat(F.lit(EXECUTED_ON), F.date_format(executed_at, REPORT_TIME_FORMAT), F.lit(PAGE_CLOSE))
    html = F.concat(
        opening,
        F.when(n_failed > 0, _table(FAILED_TITLE, FAILED_COLOUR, joined("fail"))).otherwise(F.lit("")),
        F.when(n_passed > 0, _table(PASSED_TITLE, PASSED_COLOUR, joined("pass"))).otherwise(F.lit("")),
        closing,
    )
    return grouped.select("dq_id", html.alias("html"))
