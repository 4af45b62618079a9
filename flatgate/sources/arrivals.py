"""What has arrived, from the file listing alone: no row is read.

Names, sizes and times come from Spark's own listing of a folder (listed by
many tasks where there are many folders). Files without content are in the
listing but in no scan, so a file that arrived empty is told from one that
did not arrive.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatgate.operators.rules import local_table

# ``file:/x`` and ``file:///x`` are one place, spelled by the scan and the listing
_ROOT = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):/+")
PRESENT, EMPTY, MISSING, UNEXPECTED = "present", "empty", "missing", "unexpected"


def arrived_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, length, modified)`` of every data file at or below ``path``
    (names that match ``glob``); length 0 and no time for an empty one. The
    scan's schema holds path, length and time only, so no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    # the listing that Spark keeps on the driver anyway; it also has the empty files
    listed = local_table(spark, [(_ROOT.sub(r"\1:/", unquote(f)),) for f in files.inputFiles()], "listed string")
    seen = files.select(F.regexp_replace("path", _ROOT.pattern, "$1:/").alias("path"), "length", F.col("modificationTime").alias("modified"))
    return listed.join(seen, F.col("listed") == F.col("path"), "left").select(
        F.col("listed").alias("path"), F.coalesce("length", F.lit(0).cast("long")).alias("length"), "modified")


def arrivals_audit(spark: SparkSession, path: str, expected: Iterable[str] | DataFrame, level: int = 1,
                   glob: str | None = None) -> DataFrame:
    """``(file_name, status, n_files, n_empty, bytes, last_modified)`` per
    expected or arrived name, D7 without reading rows.

    ``level`` picks the path element from the end (1: the file, 2: its
    folder). Status is ``present``, ``empty`` (no file of that name has
    content), ``missing``, or ``unexpected`` for a name that arrived and is
    not expected. ``expected`` is a short list or a frame with a column
    ``file_name``."""
    if not isinstance(expected, DataFrame):
        expected = local_table(spark, [(n,) for n in dict.fromkeys(expected)], "file_name string")
    expected = expected.select(F.col("file_name").alias("e_name")).distinct()
    name = F.try_element_at(F.split("path", "/"), F.lit(-level))
    names = arrived_files(spark, path, glob).groupBy(name.alias("a_name")).agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("length") == 0).alias("n_empty"), F.sum("length").alias("bytes"),
        F.max("modified").alias("last_modified"))
    status = (F.when(F.col("a_name").isNull(), F.lit(MISSING)).when(F.col("e_name").isNull(), F.lit(UNEXPECTED))
              .when(F.col("bytes") == 0, F.lit(EMPTY)).otherwise(F.lit(PRESENT)))
    zero = F.lit(0).cast("long")
    return expected.join(names, F.col("e_name") == F.col("a_name"), "full").select(
        F.coalesce("e_name", "a_name").alias("file_name"), status.alias("status"),
        *[F.coalesce(c, zero).alias(c) for c in ("n_files", "n_empty", "bytes")], "last_modified")
