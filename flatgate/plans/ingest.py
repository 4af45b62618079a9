"""Pipeline A: arriving JSON -> flat, null-checked rows -> good and
quarantine outputs -> ledger.

One pass over the source: the flagged rows are written once as parquet,
partitioned by ``job_id`` and the flag, with the counters riding on that
write (``observe``). The quarantine CSV is then read from the ``true``
partition only (partition pruning; bad rows are normally a small share).
The original read and flattened the source four times (three counts and a
CSV write) after funnelling it through one task.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flatgate.functions.predicates import parse_columns
from flatgate.operators.commits import CommitLog, committed
from flatgate.operators.flatten import col_of, flatten
from flatgate.operators.ledger import COMPLETED, Ledger
from flatgate.operators.quality import FLAG, null_flag, observe_metrics
from flatgate.sinks.files import write_csv, write_good
from flatgate.sources.json import corrupt_column

JOB_COL = "job_id"


@dataclass(frozen=True)
class IngestResult:
    job_id: str
    total: int
    loaded: int
    errors: int
    rows_path: str
    quarantine_path: str
    rule_results: DataFrame | None = None


def new_job_id(prefix: str = "job") -> str:
    """``<prefix>_<yyyyMMddHHmmss>_<8 hex digits>`` (UTC): jobs that start
    in one second still own different folders."""
    return f"{prefix}_{_dt.datetime.now(_dt.timezone.utc).strftime('%Y%m%d%H%M%S')}_{uuid.uuid4().hex[:8]}"


def keep_clear(df: DataFrame) -> DataFrame:
    """Data columns named like the bookkeeping columns (``job_id`` and the
    flag) move to ``<name>_data``: folder names must not replace them."""
    taken = {c.lower() for c in df.columns}
    renamed = {}
    for c in df.columns:
        if c.lower() in (JOB_COL, FLAG):
            new = f"{c}_data"
            while new.lower() in taken:
                new += "_"
            renamed[c] = new
            taken.add(new.lower())
    return df.withColumnsRenamed(renamed) if renamed else df


def flag_frame(df: DataFrame, columns: str | Iterable[str], prefix: bool = False) -> DataFrame:
    """Flatten, then add the null flag. A record that did not parse is
    flagged too, and its text stays with it."""
    flat = keep_clear(flatten(df, prefix=prefix))
    flagged = null_flag(flat, parse_columns(columns))
    if mark := corrupt_column(flat):
        flagged = flagged.withColumn(FLAG, F.col(FLAG) | col_of(mark).isNotNull())
    return flagged


def ingest_frame(df: DataFrame, columns: str | Iterable[str], out_root: str, job_id: str,
                 prefix: bool = False, ledger: Ledger | None = None, source_path: str = "",
                 description: str = "PAYMENT", max_records_per_file: int | None = None,
                 quarantine_root: str | None = None) -> IngestResult:
    """Run pipeline A over an already-read nested frame. Quarantined rows go
    under ``quarantine_root`` (default: ``out_root``).

    With a ``CommitLog`` as ledger the finish event publishes rows,
    quarantine and counts together (see ``committed_rows``), and a job that
    is published already is not run again."""
    out_root = out_root.rstrip("/")
    rows_path = f"{out_root}/rows"
    quarantine_path = f"{(quarantine_root or out_root).rstrip('/')}/quarantine"
    q_location = f"{quarantine_path}/{JOB_COL}={job_id}/"
    if ledger is not None:
        if done := ledger.completed(job_id):
            return IngestResult(job_id, done["total_record_count"], done["load_record_count"], done["error_record_count"],
                                rows_path, quarantine_path)
        ledger.start(job_id, description, None, source_path, q_location)
    try:
        flagged = flag_frame(df, columns, prefix)
        observed, obs = observe_metrics(flagged, FLAG)
        # Each job owns rows/job_id=<id>/ and quarantine/job_id=<id>/, and
        # both are overwritten whole (static mode): a retried job replaces
        # everything of its failed attempt, even a flag partition the retry
        # no longer produces. Reading rows/ discovers job_id and the flag.
        write_good(observed, f"{rows_path}/{JOB_COL}={job_id}", partition_by=[FLAG],
                   max_records_per_file=max_records_per_file, overwrite_mode="static")
        m = obs.get
        total = int(m.get("total_record_count", 0))
        errors = int(m.get("error_record_count", 0))
        if total == 0:
            # a partitioned write of no rows leaves no file: keep one empty,
            # schema-carrying file so the job's rows stay readable
            flagged.limit(0).drop(FLAG).write.mode("overwrite").parquet(
                f"{rows_path}/{JOB_COL}={job_id}/{FLAG}=false"
            )
        spark = df.sparkSession
        # the written schema is known: no footer-reading job to rediscover it
        written = StructType(flagged.schema.fields + [StructField(JOB_COL, StringType(), True)])
        bad = bad_rows(spark, out_root, job_id, schema=written)
        write_csv(bad, f"{quarantine_path}/{JOB_COL}={job_id}", mode="overwrite", overwrite_mode="static")
        if ledger is not None:
            ledger.finish(job_id, total, total - errors, errors, q_location, COMPLETED)
        return IngestResult(job_id, total, total - errors, errors, rows_path, quarantine_path)
    except Exception:
        if ledger is not None:
            ledger.fail(job_id)
        raise


def _rows(spark: SparkSession, out_root: str, job_id: str | None, flag: bool, schema=None) -> DataFrame:
    rows = f"{out_root.rstrip('/')}/rows"
    reader = spark.read if schema is None else spark.read.schema(schema)
    if job_id is not None:
        # list only this job's folder; basePath keeps job_id as a column
        reader = reader.option("basePath", rows)
        rows = f"{rows}/{JOB_COL}={job_id}"
    # partition values come back as text; the cast stays a partition filter
    df = reader.parquet(rows).withColumn(FLAG, F.col(FLAG).cast("boolean"))
    return df.filter(F.col(FLAG) == F.lit(flag))


def good_rows(spark: SparkSession, out_root: str, job_id: str | None = None, schema=None) -> DataFrame:
    """Good rows of a run (flag dropped), read from the flag=false partition.
    They all parsed, so the text of broken records is dropped as well."""
    return _parsed(_rows(spark, out_root, job_id, False, schema)).drop(JOB_COL)


def _parsed(good: DataFrame) -> DataFrame:
    """Rows that all parsed, without flag and text of broken records."""
    mark = corrupt_column(good)
    return good.drop(FLAG, *([mark] if mark else []))


def bad_rows(spark: SparkSession, out_root: str, job_id: str | None = None, schema=None) -> DataFrame:
    """Quarantined rows of a run, flag kept."""
    return _rows(spark, out_root, job_id, True, schema).drop(JOB_COL)


def committed_rows(spark: SparkSession, out_root: str, log: CommitLog, flag: bool = False, schema=None) -> DataFrame:
    """Good rows (``flag=True``: quarantined ones) of the jobs that ``log``
    has published. Folders of failed and unfinished jobs are pruned."""
    df = _rows(spark, out_root, None, flag, schema)
    df = committed(df.withColumn(JOB_COL, F.col(JOB_COL).cast("string")), log).drop(JOB_COL)
    return df if flag else _parsed(df)


def validate_and_process(spark: SparkSession, source_path: str, columns: str | Iterable[str], out_root: str,
                         job_id: str | None = None, schema=None, multi_line: bool = False, prefix: bool = False,
                         ledger_path: str | None = None, description: str = "PAYMENT",
                         rules=None, report_dir: str | None = None,
                         quarantine_root: str | None = None, access=None) -> IngestResult:
    """Pipeline A end to end from JSON files (records that do not parse are
    quarantined with their text); with ``rules`` (a list of
    ``Rule``) pipeline C follows over the rows just written (no second read
    of the JSON), and one HTML page per dq_id goes to ``report_dir``;
    ``access`` declares what query rules may read besides those rows."""
    from dataclasses import replace

    from flatgate.operators.rules import NO_ACCESS
    from flatgate.plans.quality_report import ingested_rows, quality_report
    from flatgate.sources.json import infer_schema, read_json_docs, read_json_lines

    if schema is None:
        schema = infer_schema(spark, source_path, multi_line)
    reader = read_json_docs if multi_line else read_json_lines
    df = reader(spark, source_path, schema=schema, with_source=True, keep_corrupt=True)
    ledger = Ledger(spark, ledger_path) if ledger_path else None
    res = ingest_frame(df, columns, out_root, job_id or new_job_id(), prefix=prefix, ledger=ledger,
                       source_path=source_path, description=description, quarantine_root=quarantine_root)
    if rules:
        results = quality_report(ingested_rows(spark, out_root, res.job_id), rules, report_dir, access=access or NO_ACCESS)
        res = replace(res, rule_results=results)
    return res
