"""Job entry: ``python -m flatgate`` (cluster: ``spark-submit --py-files flatgate.zip flatgate/__main__.py``).

    python -m flatgate --source <dir> --rules <rules.json> --out <root>
        [--job-id ID] [--ledger <path>] [--report <dir>] [--columns a,b]
        [--schema <folder>] [--multi-line] [--prefix] [--profile cluster|local]
        [--rule-path <path> ...]

Reads the JSON, flattens it, flags rows whose null-check columns are NULL
(default: the columns of the rule file's not-null rules), writes good rows
and quarantine (under the rule file's ``dq_file_path``, if it names one), runs every rule over the written rows, writes the HTML
report and the ledger, and prints one JSON line with the run's counts. The SQL
of query rules may read the data and files at or below ``--rule-path``. With
``--schema`` the JSON is read once: the schema comes from that folder, or is
inferred and stored there by the first job.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.errors import AnalysisException

from flatgate.functions.predicates import parse_columns
from flatgate.operators.rules import NOT_NULL, Access
from flatgate.plans.ingest import new_job_id, validate_and_process
from flatgate.session import get_session
from flatgate.sources.json import infer_schema, load_schema, store_schema
from flatgate.sources.rules import load_rules, read_rules


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="flatgate", description=__doc__.splitlines()[0])
    p.add_argument("--source", required=True)
    p.add_argument("--rules", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--job-id")
    p.add_argument("--ledger")
    p.add_argument("--report")
    p.add_argument("--columns", help="null-check columns; default: columns of the not-null rules")
    p.add_argument("--schema", help="folder of the stored schema; inferred and written there if absent")
    p.add_argument("--multi-line", action="store_true", help="each file is one JSON document")
    p.add_argument("--prefix", action="store_true", help="parent_child column names")
    p.add_argument("--rule-path", action="append", default=[], help="files that query rules may read besides the data")
    p.add_argument("--profile", default="cluster", choices=["cluster", "local"])
    a = p.parse_args(argv)

    spark = get_session(a.profile, "flatgate-job")
    rules = load_rules(spark, a.rules)
    folders = {r["dq_file_path"] for r in read_rules(spark, a.rules).collect()} - {None}
    if len(folders) > 1:
        p.error(f"the rule file names several dq_file_path: {sorted(folders)}")
    schema = None
    if a.schema:
        try:
            schema = load_schema(spark, a.schema)
        except AnalysisException:  # no such folder yet
            schema = infer_schema(spark, a.source, a.multi_line)
            store_schema(spark, schema, a.schema)
    if a.columns:
        columns = parse_columns(a.columns)
    else:
        columns = list(dict.fromkeys(c for r in rules if r.rule_type == NOT_NULL for c in r.columns))
    if not columns:
        p.error("no null-check columns: pass --columns or add a not-null rule")
    res = validate_and_process(
        spark, a.source, columns, a.out, job_id=a.job_id or new_job_id(), multi_line=a.multi_line,
        prefix=a.prefix, ledger_path=a.ledger, rules=rules, report_dir=a.report, schema=schema,
        quarantine_root=next(iter(folders), None), access=Access(paths=tuple(a.rule_path)),
    )
    failed = res.rule_results.filter("status = 'fail'").count() if res.rule_results is not None else 0
    print(json.dumps({"job_id": res.job_id, "total": res.total, "loaded": res.loaded, "errors": res.errors,
                      "rules_failed": failed}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
