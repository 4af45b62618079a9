"""Exact duplicates: rows grouped by a 128-bit content hash, with the texts of
every group compared byte by byte.

The grouping itself works on hashes and ids: a row of some fifty bytes per
document, written once to the shared folder. The comparison of bytes is a
pass of its own over the texts, in which copies collapse inside each task
before anything is shuffled: where one hash stands for several texts, those
texts are numbered apart and the rows grouped by hash and number. No group is
collected; a text that a third of the rows share is one row per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatgate.llm.common import WORD_CUT, store

ContentHash = Callable[[Column], Column]


def one_spaced(text: Column) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WORD_CUT, " ")


def hash128(text: Column) -> Column:
    """The first 128 bits of the text's SHA-256."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def content_groups(rows: DataFrame, text_col: str, content_hash: ContentHash = hash128) -> DataFrame:
    """``rows`` without their text, with columns ``content`` (the hash) and
    ``variant``: two rows agree in both exactly if their texts are equal.

    The result is a written table. ``variant`` is 0 wherever a hash stands
    for one text; the texts of a hash that stands for several are numbered,
    and only those rows are joined to their text by its bytes.
    """
    spark = rows.sparkSession
    hashed = rows.withColumn("content", content_hash(F.col(text_col)))
    keyed, _ = store(hashed.drop(text_col), "content")
    # grouping by hash and text compares bytes; copies meet in the task first
    texts = hashed.select("content", text_col).distinct()
    several = texts.groupBy("content").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("content")
    several, _ = store(several, "collisions")
    if several.isEmpty():
        return keyed.withColumn("variant", F.lit(0).cast("long"))
    numbered, _ = store(texts.join(several, "content").withColumn("variant", F.monotonically_increasing_id() + 1), "variants")
    apart, _ = store(hashed.join(numbered, ["content", text_col]).drop(text_col), "apart")
    alone = keyed.join(several, "content", "left_anti").withColumn("variant", F.lit(0).cast("long"))
    return store(alone.unionByName(apart), "content")[0]


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     content_hash: ContentHash = hash128) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of every row of
    ``docs``, dropped ones too.

    Texts are equal when identical after each run of white space became one
    space (null is empty, and empty differs from blank). Of equal texts the
    row of the smallest id stays; a null id counts as the largest, and of
    rows that repeat that id exactly one stays. Other columns are ignored;
    an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), one_spaced(F.col(text_col)).alias("t"))
    # the place tells repeated rows apart; it is fixed once the table is written
    rows = rows.withColumns({"sha": F.unhex(F.sha2("t", 256)), "place": F.monotonically_increasing_id()})
    keyed = content_groups(rows, "t", content_hash)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")).alias("first")
    groups = keyed.groupBy(F.col("content").alias("g_content"), F.col("variant").alias("g_variant")).agg(
        first, F.count(F.lit(1)).alias("group_size"))
    both = keyed.join(groups, (F.col("content") == F.col("g_content")) & (F.col("variant") == F.col("g_variant")))
    return both.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("place") == F.col("first.place")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def keep_smallest(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Ids that stay, one row per distinct text (see ``exact_duplicates``)."""
    return exact_duplicates(docs, id_col, text_col).filter("kept").select("doc_id")
