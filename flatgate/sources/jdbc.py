"""JDBC source and sink (Spark's built-in JDBC data source).

Connection options always come from the caller; nothing is hard-coded.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_query(spark: SparkSession, url: str, query: str, properties: Mapping[str, str] | None = None,
                    fetchsize: int = 10_000, partition_column: str | None = None, lower_bound=None,
                    upper_bound=None, num_partitions: int | None = None) -> DataFrame:
    """Rows of a SELECT. With ``partition_column`` and bounds the read
    is split into ``num_partitions`` parallel range queries (a ``query``
    cannot be split, so the statement is wrapped as ``dbtable``)."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (
            reader.option("dbtable", f"({query}) q")
            .option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions or 8)
        )
    else:
        reader = reader.option("query", query)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               mode: str = "append", batchsize: int = 10_000, num_partitions: int | None = None) -> None:
    """K3: append rows to a table; ``num_partitions`` caps the number of
    concurrent connections (Spark coalesces to it)."""
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option(
        "batchsize", batchsize
    )
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
