"""flatgate: nested JSON to trustworthy flat tables on Spark.

Read JSON (batch or file stream), flatten structs and arrays into clash-free
columns, flag and quarantine rows that fail null checks, run declarative
not-null / unique / SQL-query rules in as few passes as possible, write good
rows, quarantined rows and an audit report, and keep a ledger of every run.
Everything is a DataFrame / Spark SQL / Structured Streaming plan.
"""

from flatgate.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
