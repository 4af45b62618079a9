"""Free SQL over a frame, with the frame visible as ``temp`` (the query
rule's calling convention)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def sql_on(df: DataFrame, sql: str, name: str = "temp") -> DataFrame:
    """Run ``sql`` where ``name`` is ``df``. A unique view backs it, bound
    by a CTE, so concurrent calls never see each other's data."""
    spark = df.sparkSession
    view = f"__fg_view_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    out = spark.sql(f"WITH {name} AS (SELECT * FROM {view})\nSELECT * FROM (\n{sql.strip().rstrip(';')}\n) q")
    spark.catalog.dropTempView(view)
    return out
