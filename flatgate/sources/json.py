"""JSON sources: JSON lines, whole-file documents, corrupt records, schemas.

Infer a schema once (one pass over every record), store it as JSON, and pass
it to every later read and to streams: a read with a supplied schema
skips the inference pass and never changes shape between runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"
# Metadata of the column with the text of records that did not parse. The
# name alone cannot tell it from a field of the data.
_MARK = {"flatgate.corrupt": True}


def _free(name: str, columns: Iterable[str]) -> str:
    """``name``, or with a number behind it where a column has that name."""
    taken = {c.lower() for c in columns}
    free, n = name, 1
    while free.lower() in taken:
        n += 1
        free = f"{name}_{n}"
    return free


def corrupt_column(df: DataFrame) -> str | None:
    """Name of the column that carries the text of records that did not
    parse, if ``df`` (or what it was made of) was read with one."""
    return next((f.name for f in df.schema.fields if f.metadata.get("flatgate.corrupt")), None)


def _read(spark: SparkSession, path, schema, multi_line: bool, mode: str, corrupt_col: str,
          with_source: bool, keep_corrupt: bool, options: dict) -> DataFrame:
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema  # DDL text -> StructType
    if schema is None and keep_corrupt:
        schema = infer_schema(spark, path, multi_line, **options)
    if schema is not None and keep_corrupt:
        # a data field of that name keeps it; the mark moves
        corrupt_col = _free(corrupt_col, schema.fieldNames())
        schema = StructType([*schema.fields, StructField(corrupt_col, StringType(), True, _MARK)])
    elif schema is not None:
        corrupt_col = _free(corrupt_col, schema.fieldNames())  # so that the parser leaves the data's own alone
    reader = spark.read.option("multiLine", multi_line).option("mode", mode).option(
        "columnNameOfCorruptRecord", corrupt_col
    )
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    if with_source:
        # carried as a column at read time: _metadata is not visible through
        # a temp view and input_file_name() is lost after a shuffle
        df = df.withColumn(source_column(df.columns), F.col("_metadata.file_path"))
    return df


def source_column(columns) -> str:
    """Name of the column that carries a row's file: ``source_file``, or
    with a number behind it where the data has a field of that name."""
    return _free(SOURCE_FILE, columns)


def read_json_lines(spark: SparkSession, path, schema: StructType | str | None = None, mode: str = "PERMISSIVE",
                    corrupt_col: str = CORRUPT, with_source: bool = False, keep_corrupt: bool = False,
                    **options) -> DataFrame:
    """One JSON record per line (splittable; files are read in parallel
    blocks). Malformed lines become rows with null fields (PERMISSIVE), and
    their text lands in ``corrupt_col`` when ``keep_corrupt`` (with a number
    behind the name where the data has such a field: ``corrupt_column``
    tells)."""
    return _read(spark, path, schema, False, mode, corrupt_col, with_source, keep_corrupt, options)


def read_json_docs(spark: SparkSession, path, schema: StructType | str | None = None, mode: str = "PERMISSIVE",
                   corrupt_col: str = CORRUPT, with_source: bool = False, keep_corrupt: bool = False,
                   **options) -> DataFrame:
    """Each file is one JSON document (or an array of documents, one row
    each). A file is one task, so keep files bounded in size."""
    return _read(spark, path, schema, True, mode, corrupt_col, with_source, keep_corrupt, options)


def corrupt_rows(df: DataFrame, corrupt_col: str | None = None) -> DataFrame:
    """Records that failed to parse, whole (data fields are null). The
    column is found by its mark unless it is named. A frame that was read
    without one cannot tell them, so it is refused: read with
    ``keep_corrupt=True``.

    Spark refuses a raw-file plan that needs only the corrupt column (the
    parser would have nothing to parse), so keep at least one data column
    next to it in any later projection."""
    corrupt_col = corrupt_col or corrupt_column(df)
    if corrupt_col is None or corrupt_col not in df.columns:
        raise ValueError("no column of broken records: read the records with keep_corrupt=True")
    return df.filter(F.col(corrupt_col).isNotNull())


def infer_schema(spark: SparkSession, path, multi_line: bool = False, **options) -> StructType:
    """One inference pass over every record: a field that only a few records
    have is part of the schema. Broken records add nothing to it."""
    mark = f"__fg_corrupt_{uuid.uuid4().hex}"
    reader = spark.read.option("multiLine", multi_line).options(**options).option("columnNameOfCorruptRecord", mark)
    return StructType([f for f in reader.json(path).schema.fields if f.name != mark])


def schema_from_json(text: str) -> StructType:
    import json

    return StructType.fromJson(json.loads(text))


def store_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    """Write the schema as one JSON text row, through Spark, so it lands on
    the same (shared) storage as the data."""
    spark.createDataFrame([(schema.json(),)], "value string").write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> StructType:
    return schema_from_json(spark.read.text(path).first()["value"])
