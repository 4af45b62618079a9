"""Pipeline B: JSON documents -> flat CSV; and JSON writers used by it.

Spark writes JSON *lines*. A whole-file document reader needs one JSON
value per file, so ``write_json_docs`` joins the records of each Arrow batch
into JSON array documents of bounded size (no record leaves its partition).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatgate.operators.flatten import flatten
from flatgate.sinks.files import write_csv, write_flat_csv
from flatgate.sources.json import read_json_docs


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_json_docs(df: DataFrame, path: str, max_bytes: int = 64 << 20, mode: str = "overwrite") -> None:
    """One JSON array per output file, of about ``max_bytes`` at most (a
    larger record is a document of its own)."""
    lines = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("j"))

    def to_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = batch.column(0)
            document = np.cumsum(pc.binary_length(records).to_numpy(zero_copy_only=False)) // max_bytes
            cuts = [0, *(np.flatnonzero(np.diff(document)) + 1), len(records)]
            docs = ["[\n" + ",\n".join(records.slice(a, z - a).to_pylist()) + "\n]" for a, z in zip(cuts, cuts[1:], strict=False) if z > a]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.string())], names=["doc"])

    docs = lines.mapInArrow(to_docs, "doc string")
    # each text row becomes its own file so every file is one JSON value
    docs.write.mode(mode).option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def json_docs_to_csv(spark: SparkSession, source: str, out: str, schema=None, job_id: str | None = None) -> DataFrame:
    """Pipeline B: read documents, prefixed flatten, append as CSV. With a
    ``job_id`` the job owns ``<out>/job_id=<id>`` and overwrites it, so it
    can be repeated after a failure without doubling rows."""
    flat = flatten(read_json_docs(spark, source, schema=schema), prefix=True)
    if job_id is None:
        write_flat_csv(flat, out)
    else:
        write_csv(flat, f"{out.rstrip('/')}/job_id={job_id}", mode="overwrite", overwrite_mode="static")
    return flat
