"""File sinks: quarantine CSV, flat CSV, good rows as parquet, HTML report.

No ``repartition(1)``/``coalesce(1)`` by default: every task writes its own
file; ``max_records_per_file`` bounds file size instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from flatgate.operators.flatten import col_of

# CSV options that survive embedded quotes and newlines on a round trip. NULL
# is written as a marker of its own, so it stays apart from empty text.
CSV_NULL = "\\N"
CSV_WRITE = {
    "header": "true",
    "escape": '"',
    "nullValue": CSV_NULL,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_READ = {"header": "true", "escape": '"', "multiLine": "true", "nullValue": CSV_NULL}


def csv_safe(df: DataFrame) -> DataFrame:
    """CSV holds no arrays, structs or maps: turn those into JSON text."""
    out = []
    for f in df.schema.fields:
        c = col_of(f.name)
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = (),
              max_records_per_file: int | None = None, overwrite_mode: str | None = None) -> None:
    w = csv_safe(df).write.mode(mode).options(**CSV_WRITE)
    if overwrite_mode:
        w = w.option("partitionOverwriteMode", overwrite_mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.csv(path)


def write_quarantine(bad: DataFrame, path: str, partition_by: Sequence[str] = ("job_id",)) -> None:
    """K1: bad rows (flag column kept) as CSV with header, one folder per
    job. Dynamic partition overwrite replaces only the folders this write
    touches, so a retried job replaces its own rows and nobody else's."""
    parts = [p for p in partition_by if p in bad.columns]
    write_csv(bad, path, mode="overwrite", partition_by=parts, overwrite_mode="dynamic")


def write_flat_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """K2: flattened rows as CSV with header. ``mode='append'`` repeats rows
    when a job is repeated; give each job its own folder and ``overwrite``
    to make it safe to retry."""
    write_csv(df, path, mode=mode)


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read.options(**CSV_READ)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def write_good(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
               max_records_per_file: int | None = None, overwrite_mode: str = "dynamic") -> None:
    """K4: snappy parquet; with ``partition_by`` and dynamic partition
    overwrite only the partitions present in ``df`` are replaced
    (``overwrite_mode='static'`` replaces everything under ``path``)."""
    w = df.write.mode(mode).option("compression", "snappy")
    if overwrite_mode:
        w = w.option("partitionOverwriteMode", overwrite_mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """K5: one HTML text file per dq_id (``dq_id=<n>/part-*.txt``). Pages of
    the rule sets in ``report`` are replaced, others in the folder stay."""
    report.select("dq_id", "html").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "lineSep", "\n").partitionBy("dq_id").text(path)
