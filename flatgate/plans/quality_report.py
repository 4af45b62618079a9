"""Pipeline C: rules -> result table -> HTML report.

Rules run over the rows an ingest run already wrote (columnar parquet, so
each rule reads only its own columns) instead of re-reading and
re-flattening the JSON source once per rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from flatgate.operators.quality import FLAG
from flatgate.operators.report import report_html
from flatgate.operators.rules import NO_ACCESS, Access, Rule, run_rules
from flatgate.plans.ingest import JOB_COL
from flatgate.sinks.files import write_report


def quality_report(data: DataFrame, rules: Sequence[Rule], report_dir: str | None = None,
                   app_id: str | None = None, access: Access = NO_ACCESS) -> DataFrame:
    """Run every rule (fused), optionally write one HTML page per dq_id,
    return the result table. Query rules read the data and what ``access``
    declares."""
    results = run_rules(data, rules, app_id, access=access)
    if report_dir:
        write_report(report_html(results), report_dir)
    return results


def ingested_rows(spark: SparkSession, out_root: str, job_id: str | None = None) -> DataFrame:
    """All rows (good and quarantined) one ingest job wrote -- or, with no
    ``job_id``, every job and stream batch under ``out_root`` -- without the
    bookkeeping columns.

    Rules run inside a stream's ``foreachBatch`` only see that batch; a
    unique rule across batches is this read plus ``run_rules``.
    """
    rows = f"{out_root.rstrip('/')}/rows"
    if job_id is None:
        return spark.read.parquet(rows).drop(FLAG, JOB_COL)
    return spark.read.option("basePath", rows).parquet(f"{rows}/{JOB_COL}={job_id}").drop(FLAG, JOB_COL)
