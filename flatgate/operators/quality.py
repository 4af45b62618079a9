"""Row-level quality: null flag, good/bad split, run metrics, stamps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flatgate.functions.predicates import any_null, is_blank, parse_columns
from flatgate.operators.columns import refuse_column

FLAG = "null_check_result"


def null_flag(df: DataFrame, columns: str | Iterable[str], out: str = FLAG) -> DataFrame:
    """Boolean ``out`` column, true when any listed column is NULL. The
    data must not have a column of that name."""
    refuse_column(df, out)
    return df.withColumn(out, any_null(parse_columns(columns)))


def split_good_bad(df: DataFrame, columns: str | Iterable[str], flag: str = FLAG) -> tuple[DataFrame, DataFrame]:
    """(good, bad). Bad rows keep the flag column (it is part of the
    quarantine schema), good rows drop it. Both are filters over the same
    flagged plan; write them from one pass with ``plans.ingest``."""
    flagged = null_flag(df, columns, flag)
    bad = flagged.filter(F.col(flag))
    good = flagged.filter(~F.col(flag)).drop(flag)
    return good, bad


def blank_filter(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL or whitespace only."""
    return df.filter(is_blank(column))


def stamp(df: DataFrame, **literals) -> DataFrame:
    """Add constant columns, e.g. ``stamp(df, job_id='j1')``."""
    return df.withColumns({k: F.lit(v) for k, v in literals.items()})


def run_metrics(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Total, loaded (good) and error (bad) counts in one aggregation."""
    bad = any_null(parse_columns(columns))
    return df.agg(
        F.count(F.lit(1)).alias("total_record_count"),
        F.count_if(~bad).alias("load_record_count"),
        F.count_if(bad).alias("error_record_count"),
    )


def observe_metrics(df: DataFrame, flag: str = FLAG, name: str | None = None) -> tuple[DataFrame, Observation]:
    """J1 riding on another action: attach total / error counters to a
    flagged frame; read them from the Observation after the write."""
    obs = Observation(name) if name else Observation()
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("total_record_count"),
        F.count_if(F.col(flag)).alias("error_record_count"),
    )
    return observed, obs
