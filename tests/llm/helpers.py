"""Small frames and brute-force versions for the tests of this folder."""

import re
import zlib

from pyspark.sql import types as T

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}

# Names that the operators use inside, as extra columns of the input.
EXTRA = ["fp", "fingerprint", "score", "evidence", "id", "g", "t", "host", "path", "simhash", "tree", "n", "chunk", "piece", "length",
         "__k_id", "__k_fp", "__k_n", "a.b", "keeper_id"]

LONG = " ".join(f"word{i % 977} thing{i % 89}" for i in range(60_000))

# doc_id, text, lang, source: nulls in every column, blank and very long
# texts, ties, repeated rows, one id with two texts
EDGE = [
    (1, "The cat sat on the mat and the dog sat on the rug.", "en", "a"),
    (2, "The cat sat on the mat and the dog sat on the rug.", "en", "a"),
    (2, "The cat sat on the mat and the dog sat on the rug.", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \t\n\x0b\f\r ", "fr", None),
    (None, "a null id with some words in it", None, None),
    (None, None, None, None),
    (6, LONG, "de", "b"),
    (7, "one", "de", "b"),
    (7, "another text under the same id\nof two lines\nof two lines", "de", "c"),
    (8, "Ünïcode 日本語 😀 ▁ <|endoftext|> x  y\n\n z#%$", "es", "c"),
    (9, "spam spam spam spam spam spam spam spam", "es", "c"),
]

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in EXTRA]])

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


def frame(spark, rows=None):
    rows = EDGE if rows is None else rows
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *["x"] * len(EXTRA)) for r in rows], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), LABELS)


def remainder(doc_id, modulus):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def words(text):
    return WORD.findall(text or "")


def canon(rows):
    return sorted((tuple(r) for r in rows), key=repr)
