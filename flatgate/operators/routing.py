"""Routing of arriving files by name: label, counts per label, target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatgate.functions.text import DEFAULT_ROUTE_LABELS, route_label, run_stamp
from flatgate.operators.flatten import col_of

# Broadcast only maps whose size is checked here (they are config, not data).
MAX_BROADCAST_MAP = 100_000


def with_route(df: DataFrame, name_col: str, labels: Sequence[str] = DEFAULT_ROUTE_LABELS, out: str = "route") -> DataFrame:
    """R1 as a column."""
    return df.withColumn(out, route_label(name_col, labels))


def route_counts(df: DataFrame, name_col: str, labels: Sequence[str] = DEFAULT_ROUTE_LABELS,
                 stamp: F.Column | str | None = None) -> DataFrame:
    """R2: names and rows per route label, and the job name
    ``<label>_<yyyyMMddHHmmss>``."""
    stamp_col = run_stamp(F.current_timestamp()) if stamp is None else (
        F.lit(stamp) if isinstance(stamp, str) else stamp)
    return (
        df.select(route_label(name_col, labels).alias("route"), col_of(name_col).alias("__fg_name"))
        .groupBy("route")
        .agg(F.count_distinct("__fg_name").alias("names"), F.count(F.lit(1)).alias("rows"))
        .withColumn("job_name", F.concat_ws("_", F.col("route"), stamp_col))
    )


def route_target(df: DataFrame, route_col: str, targets: Mapping[str, str], out: str = "target_table") -> DataFrame:
    """Logical name -> target table. Unmapped routes get NULL. The map
    is broadcast when its size is within the checked bound; a larger one
    is left to an ordinary (shuffle) join."""
    spark = df.sparkSession
    m = spark.createDataFrame(list(targets.items()), f"__fg_route string, {out} string")
    side = F.broadcast(m) if len(targets) <= MAX_BROADCAST_MAP else m
    return df.join(side, col_of(route_col) == F.col("__fg_route"), "left").drop("__fg_route")
