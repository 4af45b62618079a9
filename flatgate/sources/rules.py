"""Rule files as a table.

Two shapes are accepted: the nested rule set ``{dq_id, rules: [{rule_id,
name, description, rule_type, columns: [...], query}]}`` and the flat line
``{columns: "a,b", dq_file_path: ...}`` (one not-null rule per line).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from flatgate.operators.rules import NOT_NULL, Rule, local_table, rules_from_dicts

RULES_SCHEMA = (
    "dq_id int, rule_id int, name string, description string, rule_type string, columns array<string>, "
    "query string, dq_file_path string"
)


def rules_table(raw: DataFrame) -> DataFrame:
    """S3: one row per rule with the ``RULES_SCHEMA`` columns."""
    cols = set(raw.columns)
    if "rules" in cols:
        exploded = raw.select(
            (F.col("dq_id").cast("int") if "dq_id" in cols else F.lit(None).cast("int")).alias("dq_id"),
            (F.col("dq_file_path") if "dq_file_path" in cols else F.lit(None).cast("string")).alias("dq_file_path"),
            F.explode_outer("rules").alias("r"),
        )
        elem = raw.schema["rules"].dataType.elementType
        fields = set(elem.fieldNames())

        def get(name: str, cast: str):
            return F.col(f"r.{name}").cast(cast) if name in fields else F.lit(None).cast(cast)

        if "columns" not in fields:
            columns = F.lit(None).cast("array<string>")
        elif isinstance(elem["columns"].dataType, StringType):  # "a, b" written as text
            columns = F.filter(F.transform(F.split(get("columns", "string"), ","), lambda c: F.trim(c)), lambda c: c != "")
        else:
            # one-argument lambdas only: transform reads the arity, and
            # F.trim's optional second parameter would receive the index
            columns = F.transform(get("columns", "array<string>"), lambda c: F.trim(c))
        return exploded.select(
            "dq_id",
            get("rule_id", "int").alias("rule_id"),
            get("name", "string").alias("name"),
            get("description", "string").alias("description"),
            F.lower(F.trim(get("rule_type", "string"))).alias("rule_type"),
            columns.alias("columns"),
            get("query", "string").alias("query"),
            "dq_file_path",
        )
    # flat shape: comma-separated columns, one not-null rule per line
    def opt(name: str, cast: str = "string"):
        return F.col(name).cast(cast) if name in cols else F.lit(None).cast(cast)

    return raw.select(
        opt("dq_id", "int").alias("dq_id"),
        F.coalesce(opt("rule_id", "int"), F.lit(1)).alias("rule_id"),
        F.coalesce(opt("name"), F.lit("NOT NULL fields")).alias("name"),
        opt("description").alias("description"),
        F.coalesce(F.lower(F.trim(opt("rule_type"))), F.lit(NOT_NULL)).alias("rule_type"),
        F.filter(F.transform(F.split(opt("columns"), ","), lambda c: F.trim(c)), lambda c: c != "").alias("columns"),
        opt("query").alias("query"),
        opt("dq_file_path").alias("dq_file_path"),
    )


def _documents(text: str, path: str) -> list[dict]:
    """JSON values of a rule file: one document (or an array of them) over
    the whole file, or one per line."""
    try:
        found = json.loads(text)
        found = found if isinstance(found, list) else [found]
    except json.JSONDecodeError:
        try:
            found = [json.loads(line) for line in text.splitlines() if line.strip()]
        except json.JSONDecodeError as e:
            raise ValueError(f"{path}: neither one JSON document nor one per line: {e}") from e
    if not all(isinstance(d, dict) for d in found):
        raise ValueError(f"{path}: a rule document must be an object")
    return found


def _names(columns) -> list[str] | None:
    """Column names from a list or from comma-separated text."""
    if columns is None:
        return None
    names = columns.split(",") if isinstance(columns, str) else columns
    return [n.strip() for n in names if n.strip()]


def _rule_row(d: dict, parent: dict, number: int) -> tuple:
    text = lambda k: None if d.get(k) is None else str(d[k])
    flat = d is parent
    dq_id = parent.get("dq_id") if d.get("dq_id") is None else d["dq_id"]
    rule_id = d.get("rule_id", number if flat else None)
    kind = text("rule_type") or (NOT_NULL if flat else None)
    return (
        None if dq_id is None else int(dq_id), None if rule_id is None else int(rule_id),
        text("name") or ("NOT NULL fields" if flat else None), text("description"),
        None if kind is None else kind.strip().lower(), _names(d.get("columns")), text("query"), parent.get("dq_file_path"),
    )


def read_rules(spark: SparkSession, path: str, job_id: str | None = None) -> DataFrame:
    """Read rule files (either shape; one document per file or one per line)
    into the rules table, stamped with the run's ``job_id`` when given.
    Every line counts; flat lines without an id are numbered from 1 through
    the file. Rule files are configuration: their text passes the driver."""
    rows = []
    for f in spark.read.text(path, wholetext=True).select("value", "_metadata.file_path").orderBy("file_path").collect():
        for number, doc in enumerate(_documents(f["value"], f["file_path"]), 1):
            rules = doc["rules"] or [] if "rules" in doc else [doc]
            rows += [_rule_row(r, doc, number) for r in rules]
    table = local_table(spark, rows, RULES_SCHEMA)
    return table if job_id is None else table.withColumn("job_id", F.lit(job_id))


def load_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Rule objects for ``run_rules``. Rule sets are configuration (a few
    rows), so collecting them is fine; no data row is collected."""
    rows = [{k: v for k, v in r.asDict().items() if k != "job_id"} for r in read_rules(spark, path).collect()]
    return rules_from_dicts(rows)
