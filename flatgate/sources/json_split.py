"""Whole-file JSON documents, each file read by many tasks.

Spark's own reader gives a whole-file document to one task. Here the text
source cuts files at ``}``, which it can do from any byte range; no escape
sequence of a string reaches over such a cut, so what a range needs to know
of the text before it is two things: whether it begins inside a string, and
how deep. A first pass maps both possible beginnings of every range to its
end; composed over the ranges of a file, these give each one's true
beginning. A second pass cuts the ranges into elements, and the two ends of
elements that lie over the bound of ranges are joined. Parsing stays
``from_json``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flatgate.sources.json import _MARK, CORRUPT, _free, source_column

_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_STEP = {ord("["): 1, ord("{"): 1, ord("]"): -1, ord("}"): -1, ord(","): 0, ord('"'): 0}
_MARKS = np.zeros(256, bool)
_MARKS[list(_STEP)] = True
_STEPS = np.array([_STEP.get(b, 0) for b in range(256)])


def _scan(data: bytes, quoted: bool, depth: int) -> tuple[np.ndarray, bool, int]:
    """Places of the marks between the elements of a top array (its
    brackets, and commas at its depth) in a part that begins at ``depth``,
    inside a string or not; and the same two at its end."""
    codes = np.frombuffer(_ESCAPE.sub(b"__", data) if b"\\" in data else data, np.uint8)
    at = np.flatnonzero(_MARKS[codes])
    kind = codes[at]
    quote = kind == ord('"')
    inside = (np.cumsum(quote) + quoted) % 2 == 1
    quoted = bool(inside[-1]) if len(at) else quoted
    plain = ~inside & ~quote
    at, kind = at[plain], kind[plain]
    level = depth + np.cumsum(_STEPS[kind])
    bounds = (level == 1) & ((kind == ord(",")) | (kind == ord("["))) | (level == 0) & (kind == ord("]"))
    return at[bounds], quoted, int(level[-1]) if len(at) else depth


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], int, bytes]]:
    """Consecutive parts ``((file, start), file size, bytes)``; a range may
    come in several."""
    for batch in batches:
        text, files, starts, sizes = batch.columns
        if not len(text):
            continue
        # the places and not the keys of every part become Python objects
        file, start = files.dictionary_encode().indices.to_numpy(), starts.to_numpy()
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        for at, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(text)], strict=True):
            yield (files[at].as_py(), starts[at].as_py()), sizes[at].as_py(), b"}".join([*text.slice(at, end - at).to_pylist(), b""])


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per range: its size, first character that is no blank, and
    where it ends if it begins outside or inside a string."""
    key, row = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(("file", "start", "size", "n", "top", "q0", "d0", "q1", "d1"), (*key, *row), strict=True))], _SUMMARY)

    for now, size, data in _ranges(batches):
        if now != key:
            if key is not None:
                yield out()
            key, row = now, [size, 0, None, False, 0, True, 0]
        row[1] += len(data)
        if row[2] is None:
            row[2] = data.lstrip(b" \t\r\n\xef\xbb\xbf")[:1].decode("ascii", "replace") or None
        for q in (3, 5):
            _, row[q], row[q + 1] = _scan(data, row[q], row[q + 1])
    if key is not None:
        yield out()


_SUMMARY = pa.schema([("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("n", pa.int64()), ("top", pa.string()),
                      ("q0", pa.bool_()), ("d0", pa.int64()), ("q1", pa.bool_()), ("d1", pa.int64())])
_PIECE = pa.schema([("file", pa.string()), ("start", pa.int64()), ("n", pa.int64()), ("head", pa.bool_()), ("tail", pa.bool_()), ("text", pa.string())])


def _beginnings(rows) -> dict[tuple[str, int], tuple[bool, int, bool, bool]]:
    """Of every range: inside a string or not, depth, whether it is the
    first of its file, and whether the last cut of the file was its end
    rather than a ``}``."""
    files = defaultdict(list)
    for r in rows:
        files[r.file].append(r)
    out = {}
    for file, ranges in files.items():
        ranges.sort(key=lambda r: r.start)
        top = next((r.top for r in ranges if r.top), None)
        quoted, depth = False, 0 if top == "[" else 1  # a single document counts as the element of an array
        open_end = sum(r.n for r in ranges) > ranges[0].size
        for r in ranges:
            out[file, r.start] = quoted, depth, r is ranges[0], open_end and r is ranges[-1]
            quoted, depth = (r.q1, depth + r.d1) if quoted else (r.q0, depth + r.d0)
    return out


def split_json_docs(spark: SparkSession, path) -> DataFrame:
    """``(source_file, text)``: a row per document of whole-file JSON, in
    files that hold an array of documents or one, of any size. The text is
    as it stands in the file. Blank elements (an empty array, a comma behind
    the last document) give no row; all other text does, so that what does
    not parse is seen by the reader.

    The work is three scans (beginnings, documents, ends that lie over a
    bound); files must not change between them. The driver
    holds two numbers for each range of a file, as it holds the ranges
    themselves to plan the scan. A document has to fit in a row, and so does
    the text between two ``}``.
    """
    chunks = spark.read.option("lineSep", "}").text(path).select(
        F.col("value").cast("binary"), "_metadata.file_path", "_metadata.file_block_start", "_metadata.file_size")
    summary = "file string, start long, size long, n long, top string, q0 boolean, d0 long, q1 boolean, d1 long"
    begin = spark.sparkContext.broadcast(_beginnings(chunks.mapInArrow(_summaries, summary).collect()))

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, rest, n = None, None, [], 0

        def rows(texts: list[bytes], tail: bool) -> pa.RecordBatch:
            nonlocal n
            first = n == 0 and not state[2]
            k = len(texts)
            places = np.arange(n, n + k)
            n += k
            columns = [pa.repeat(key[0], k), pa.repeat(key[1], k), places, first & (places == 0), pa.repeat(tail, k),
                       [t.decode("utf-8", "replace") for t in texts]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c.cast(t)
                                               for c, t in zip(columns, _PIECE.types, strict=True)], schema=_PIECE)

        def last() -> pa.RecordBatch:
            text = b"".join(rest)
            return rows([text[:-1] if state[3] else text], True)

        for now, _, data in _ranges(batches):
            if now != key:
                if key is not None:
                    yield last()
                if now not in begin.value:
                    raise ValueError(f"the ranges of {now[0]} are others than at the first scan")
                key, state, rest, n = now, begin.value[now], [], 0
                quoted, depth = state[:2]
            bounds, quoted, depth = _scan(data, quoted, depth)
            if len(bounds):
                cuts = [0, *(bounds + 1).tolist()]
                texts = [data[a:z - 1] for a, z in zip(cuts, cuts[1:], strict=False)]
                texts[0] = b"".join([*rest, texts[0]])
                yield rows(texts, False)
                rest = [data[cuts[-1]:]]
            else:
                rest.append(data)
        if key is not None:
            yield last()

    found = chunks.mapInArrow(pieces, "file string, start long, n long, head boolean, tail boolean, text string")
    # an element over the bound of ranges: a tail, whole ranges, a head
    over = F.col("head") | F.col("tail")
    begun = F.sum(F.when(F.col("head"), 0).otherwise(1)).over(Window.partitionBy("file").orderBy("start", "n"))
    parts = F.array_sort(F.collect_list(F.struct("start", "n", "text")))
    joined = found.filter(over).withColumn("element", begun).groupBy("file", "element").agg(
        F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"))
    whole = found.filter(~over).select("file", "text").unionByName(joined.select("file", "text"))
    return whole.filter(F.col("text").rlike("[^ \\t\\r\\n\\uFEFF]")).select(F.col("file").alias("source_file"), "text")


def read_json_docs_split(spark: SparkSession, path, schema: StructType | str, mode: str = "PERMISSIVE", corrupt_col: str = CORRUPT,
                         with_source: bool = False, keep_corrupt: bool = False, **options) -> DataFrame:
    """S2 for files of any size: the rows of ``read_json_docs``, with each
    file read by as many tasks as it has ranges. The schema must be given.

    A document that does not parse is one row of its own (null fields, its
    text in ``corrupt_col`` when ``keep_corrupt``), where Spark's whole-file
    reader gives up the file it stands in.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    corrupt_col = _free(corrupt_col, schema.fieldNames())
    read = StructType([*schema.fields, StructField(corrupt_col, StringType(), True, _MARK)]) if keep_corrupt else schema
    parsed = F.from_json("text", read, {"mode": mode, "columnNameOfCorruptRecord": corrupt_col, **options})
    source = source_column(read.fieldNames())
    # a generator, so that later projections do not parse once per column
    docs = split_json_docs(spark, path).select(F.col("source_file").alias(source), F.inline(F.array(parsed)))
    if keep_corrupt:
        docs = docs.withMetadata(corrupt_col, _MARK)
    return docs.select(*[F.col("`" + name.replace("`", "``") + "`") for name in [*read.fieldNames(), *([source] if with_source else [])]])
