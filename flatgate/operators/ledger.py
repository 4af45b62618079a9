"""Run ledger: an append-only table of run events and its current view.

The original keeps one row per job and updates it in place. Here every
change is a new row (``seq`` orders them) and the current state of a job is
computed per column: the latest non-null value wins, so fields the finish
event does not carry (start time, description, source) survive from the
start event.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from flatgate.operators.columns import tie_break_sql
from flatgate.operators.flatten import col_of, quote
from flatgate.operators.rules import local_table

# Run states and the ledger's columns.
STARTED = "STARTED"
COMPLETED = "COMPLETED"
FAILED = "FAILED"

LEDGER_SCHEMA = (
    "seq bigint, job_id string, job_description string, total_record_count bigint, load_record_count bigint, "
    "error_record_count bigint, job_start_time timestamp, job_end_time timestamp, source_path string, "
    "dq_file_path string, status string"
)
LEDGER_COLUMNS = [c.strip().split(" ")[0] for c in LEDGER_SCHEMA.split(",")]


def ledger_current(events: DataFrame, key: str = "job_id", order: str = "seq") -> DataFrame:
    """One row per key; every column takes its latest non-null value.

    ``max_by`` is a partial aggregate, so a key with very many events is
    combined map-side."""
    others = [c for c in events.columns if c not in (key, order)]
    return events.groupBy(col_of(key)).agg(
        F.max(col_of(order)).alias(order),
        *[F.max_by(col_of(c), F.when(col_of(c).isNotNull(), col_of(order))).alias(c) for c in others],
    ).select(*[col_of(c) for c in events.columns])


def latest_per_key(df: DataFrame, key: str | list[str], order: str | list[str]) -> DataFrame:
    """The whole latest row per key (by ``order``), as a partial aggregate.
    A NULL order value is older than all others; rows of equal order are
    decided by a hash of the row."""
    orders = [order] if isinstance(order, str) else list(order)
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    row = "struct(" + ", ".join(quote(c) for c in rest) + ")"
    picked = df.groupBy(*[col_of(k) for k in keys]).agg(
        F.expr(f"max_by({row}, struct({', '.join(map(quote, orders))}, {tie_break_sql(df)})) AS __fg_row"))
    return picked.selectExpr(*[quote(k) for k in keys], *[f"__fg_row.{quote(c)} AS {quote(c)}" for c in rest])


class Ledger:
    """Append-only parquet ledger at ``path`` (shared storage)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _append(self, **fields) -> None:
        row = {c: None for c in LEDGER_COLUMNS}
        row.update(fields)
        row["seq"] = time.time_ns()
        local_table(self.spark, [tuple(row[c] for c in LEDGER_COLUMNS)], LEDGER_SCHEMA).coalesce(1).write.mode(
            "append"
        ).parquet(self.path)

    @staticmethod
    def _instant(at: _dt.datetime | None) -> _dt.datetime:
        """An instant, whatever the driver's zone; a time without a zone is
        UTC."""
        at = at or _dt.datetime.now(_dt.timezone.utc)
        return at if at.tzinfo else at.replace(tzinfo=_dt.timezone.utc)

    def start(self, job_id: str, description: str, total: int | None, source_path: str, dq_file_path: str,
              at: _dt.datetime | None = None) -> None:
        """STARTED row; load and error counts start at 0. ``total`` is
        None where the count comes with the run itself: the finish event
        fills it in."""
        at = self._instant(at)
        self._append(job_id=job_id, job_description=description, total_record_count=total, load_record_count=0,
                     error_record_count=0, job_start_time=at, job_end_time=at, source_path=source_path,
                     dq_file_path=dq_file_path, status=STARTED)

    def finish(self, job_id: str, total: int, loaded: int, errors: int, dq_file_path: str,
               status: str = COMPLETED, at: _dt.datetime | None = None) -> None:
        """Counts, end time, quarantine path and status of a job."""
        at = self._instant(at)
        self._append(job_id=job_id, total_record_count=total, load_record_count=loaded, error_record_count=errors,
                     job_end_time=at, dq_file_path=dq_file_path, status=status)

    def fail(self, job_id: str, at: _dt.datetime | None = None) -> None:
        at = self._instant(at)
        self._append(job_id=job_id, job_end_time=at, status=FAILED)

    def completed(self, job_id: str) -> Row | None:
        """A plain ledger publishes nothing: a repeated job runs again."""
        return None

    def events(self) -> DataFrame:
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def current(self) -> DataFrame:
        return ledger_current(self.events())
