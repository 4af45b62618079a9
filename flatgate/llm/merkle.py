"""Document fingerprints: Merkle trees, in DataFrame expressions only.

A text is cut into paragraphs (a line with the line feeds that end it). A
paragraph's hash is the SHA-256 of its text, a section's that of the hashes of
``SECTION`` paragraphs, and the root that of all sections' hashes. Nothing of
the text is left out, so equal roots mean equal texts. Two trees are compared
from the root down: sections that differ locate an edit. Below the
paragraphs, blocks of ``BLOCK_CHARS`` code points (a short paragraph's are
smaller) have 64-bit hashes, the leaves: the share that two texts have in
common measures their likeness.

``document_fingerprints`` also fingerprints each text as edited with the
head of the document of the next larger id. The next ids come from a range
partitioning of the ids alone; texts are shuffled once, by id, and only the
heads and leaf hashes that a neighbour needs travel, once as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flatgate.llm.common import store

BLOCK_CHARS = 32
SHORT_PARAGRAPH, SHORT_BLOCK = 40, 8
SECTION = 8
_PARAGRAPHS = r"[^\n]*\n+|[^\n]+"


def _blocks(paragraph: Column) -> Column:
    size = F.when(F.length(paragraph) <= SHORT_PARAGRAPH, F.lit(rf"(?s).{{1,{SHORT_BLOCK}}}")).otherwise(F.lit(rf"(?s).{{1,{BLOCK_CHARS}}}"))
    return F.regexp_extract_all(paragraph, size, F.lit(0))


def _with_tree(rows: DataFrame, text: str, tree: str) -> DataFrame:
    """``rows`` with the tree of column ``text``: struct (root, sections,
    leaves)."""
    columns = rows.columns
    rows = rows.withColumn("__texts", F.regexp_extract_all(F.col(text), F.lit(_PARAGRAPHS), F.lit(0)))
    rows = rows.withColumn("__paragraphs", F.transform("__texts", lambda p: F.sha2(p, 256)))
    last = F.greatest(F.size("__paragraphs") - 1, F.lit(0))
    sections = F.transform(F.sequence(F.lit(0), last, F.lit(SECTION)),
                           lambda i: F.sha2(F.array_join(F.slice("__paragraphs", i + 1, SECTION), ""), 256))
    rows = rows.withColumn("__sections", sections)
    leaves = F.flatten(F.transform("__texts", lambda p: F.transform(_blocks(p), lambda b: F.xxhash64(b))))
    root = F.sha2(F.concat_ws(".", "__sections"), 256)
    return rows.select(*columns, F.struct(root.alias("root"), F.col("__sections").alias("sections"), leaves.alias("leaves")).alias(tree))


def fingerprint(tree: Column) -> Column:
    """The tree's upper levels as text: the root, then the sections."""
    return F.concat(tree["root"], F.lit(":"), F.array_join(tree["sections"], "."))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the share of distinct leaves in common, of
    the tree that has more (below 1: different texts with the same leaves
    count as one leaf short)."""
    most = F.greatest(F.size(F.array_distinct(a["leaves"])), F.size(F.array_distinct(b["leaves"])), F.lit(1))
    shared = F.size(F.array_intersect(a["leaves"], b["leaves"]))
    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(F.least(shared / most, most / (most + 1)))


def differing_sections(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the sections in which two trees differ."""
    pairs = F.zip_with(a["sections"], b["sections"], lambda x, y: ~x.eqNullSafe(y))
    return F.filter(F.transform(pairs, lambda differs, i: F.when(differs, i)), lambda i: i.isNotNull())


def merkle_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, fingerprint, tree)`` of every row of ``docs``; a
    null text is empty. No shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = _with_tree(rows.withColumn("n_chars", F.length("t").cast("long")), "t", "tree")
    return rows.select("doc_id", "n_chars", fingerprint(F.col("tree")).alias("fingerprint"), "tree")


def neighbours(sizes: DataFrame) -> DataFrame:
    """``(doc_id, next_id, prev_id, prev_chars)`` of every distinct id of
    ``sizes`` (doc_id, n_chars): the next larger id (after the last one the
    first) and the one before with its longest text's length. A null id
    comes before all others.

    Ids are range-partitioned and written; a window runs in each range. The
    ranges' ends close the gaps between them: a row per range with the id
    after its last and the one before its first, broadcast (there are no more
    ranges than shuffle partitions)."""
    ids = sizes.groupBy("doc_id").agg(F.max("n_chars").alias("n_chars"))
    parts, _ = store(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ids")
    ends = parts.groupBy("part").agg(
        F.min_by(F.struct("doc_id", "n_chars"), F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first"),
        F.max_by(F.struct("doc_id", "n_chars"), F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("last"))
    ring = ends.agg(F.array_sort(F.collect_list(F.struct("part", "first", "last"))).alias("ring"))
    gaps = ring.select(F.posexplode("ring").alias("i", "end"), "ring").selectExpr(
        "end.part AS g_part", "ring[(i + 1) % size(ring)].first AS after", "ring[(i + size(ring) - 1) % size(ring)].last AS before")
    w = W.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first())
    me = F.struct("doc_id", "n_chars")
    rows = parts.select("part", "doc_id", F.lead(me).over(w).alias("next"), F.lag(me).over(w).alias("prev"))
    rows = rows.join(F.broadcast(gaps), F.col("part") == F.col("g_part"))
    rows = rows.select("doc_id", F.coalesce("next", "after").alias("next"), F.coalesce("prev", "before").alias("prev"))
    return rows.select("doc_id", F.col("next.doc_id").alias("next_id"), F.col("prev.doc_id").alias("prev_id"),
                       F.col("prev.n_chars").alias("prev_chars"))


def _id_keys(id_col: str, name: str) -> list[Column]:
    """A nullable id as two columns without nulls, so that groups and joins
    on it share one partitioning."""
    return [F.coalesce(id_col, F.lit(0)).alias(name), F.col(id_col).isNull().alias(f"no_{name}")]


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, edited_sections, edited_section_numbers)`` of
    every row of ``docs``.

    A text's edited form has its last quarter (rounded down) replaced by as
    many first code points of the next document, or all that it has. Null
    texts are empty. Rows that share an id share the next document; where
    the next id has several rows, the one of the smallest text hash stands
    for it. A single document is its own next one; an empty table gives an
    empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    near = neighbours(rows.select("doc_id", F.length("t").alias("n_chars")))
    near = near.select(*_id_keys("doc_id", "n"), "prev_id", "prev_chars")
    # both sides of the second join read the same columns, so the texts' exchange is one
    rows = rows.select("t", *_id_keys("doc_id", "key"))
    placed = rows.join(near, (F.col("key") == F.col("n")) & (F.col("no_key") == F.col("no_n"))).drop("n", "no_n")
    placed = _with_tree(placed, "t", "tree")
    heads = placed.select(*_id_keys("prev_id", "p"), F.struct(
        F.xxhash64("t").alias("h"), F.expr("left(t, int(prev_chars div 4))").alias("head"), F.col("tree.root").alias("root"),
        F.col("tree.leaves").alias("leaves")).alias("next"))
    heads = heads.groupBy("p", "no_p").agg(F.min("next").alias("next"))
    both = placed.join(heads, (F.col("key") == F.col("p")) & (F.col("no_key") == F.col("no_p")))
    both = both.withColumns({"doc_id": F.when(~F.col("no_key"), F.col("key")), "n_chars": F.length("t").cast("long")})
    both = both.withColumn("edited", F.expr("concat(left(t, int(n_chars - n_chars div 4)), left(next.head, int(n_chars div 4)))"))
    both = _with_tree(both.select("doc_id", "n_chars", "tree", "next", "edited"), "edited", "edited_tree")
    a, b = F.col("tree"), F.col("edited_tree")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(a).alias("fingerprint"),
        fingerprint(b).alias("edited_fingerprint"), likeness(a, b).alias("near_edited"),
        likeness(a, F.col("next")).alias("near_next"), F.size(differing_sections(a, b)).alias("edited_sections"),
        differing_sections(a, b).alias("edited_section_numbers"))
