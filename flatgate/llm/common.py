"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatgate.session import remove_scratch, scratch_dir

# A word is a run of anything but space, tab, LF, VT, FF and CR; bytes.split()
# cuts at exactly these six.
WORD_CUT = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (a null id: of
    the empty text), the deterministic fold of a row."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared scratch folder and read it back: later
    passes read columns from there instead of repeating the work, and a
    lost executor loses none of it."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


# Deletes scratch tables that no later step reads.
forget = remove_scratch


def free_name(columns: list[str], base: str) -> str:
    """``base``, lengthened until no column has the name."""
    taken = {c.lower() for c in columns}
    while base in taken:
        base += "_"
    return base


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow column, one at a time; a null
    is empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_runs(raw: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text as lists of bounded size: the text is cut at
    white space after every ``size`` bytes, so a very long text never
    stands as one list."""
    at, n = 0, len(raw)
    while at < n:
        end = n
        if n - at > size and (m := _BLANK.search(raw, at + size)):
            end = m.start()
        yield raw[at:end].split()
        at = end
