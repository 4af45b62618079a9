"""Uniqueness across arrivals: D2 over everything a stream has delivered.

A rule that runs inside ``foreachBatch`` sees one batch. Here the count of
each key is streaming state, in a RocksDB store whose size is bound by the
executors' disks, and the checkpoint says which arrivals it holds. All
unique rules share one stateful aggregation, combined map-side, so a key
that a third of the rows share is one update per task. Every batch writes
the keys that repeat, and the running total, to a folder of its own that a
replayed batch overwrites; the result table is counted from those folders.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flatgate.operators.flatten import quote
from flatgate.operators.rules import RESULT_SCHEMA, UNIQUE, Rule, local_table
from flatgate.session import application_id

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOTAL = -1  # group of all rows


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """The store's setting while a query starts (it keeps what it started
    with)."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def _key_sets(rules: Sequence[Rule]) -> list[tuple[str, ...]]:
    """Distinct key lists of ``rules``, in order."""
    for r in rules:
        if r.rule_type != UNIQUE:
            raise ValueError(f"rule {r.rule_id}: only unique rules run across batches")
    return list(dict.fromkeys(tuple(sorted(set(r.columns))) for r in rules))


def keyed_rows(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, list[str]]:
    """A row per key list (``__fg_gid`` its number, the other lists' columns
    null) and one for the total, of every row of ``df``."""
    sets = _key_sets(rules)
    keys = list(dict.fromkeys(k for ks in sets for k in ks))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = [k for k in keys if k not in types]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    names = [f"__fg_k{i}" for i in range(len(keys))]

    def group(gid: int, of: tuple[str, ...]) -> str:
        fields = [f"'{n}', {quote(k) if k in of else f'CAST(NULL AS {types[k]})'}" for n, k in zip(names, keys, strict=True)]
        return f"named_struct('__fg_gid', {gid}, {', '.join(fields)})"

    groups = ", ".join([group(TOTAL, ()), *(group(i, ks) for i, ks in enumerate(sets))])
    return df.selectExpr(f"inline(array({groups}))"), names


def stream_unique_rules(stream: DataFrame, rules: Sequence[Rule], out: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    """Count the keys of every unique rule over all arrivals of ``stream``.

    ``out`` gets ``batch=<n>`` folders; keep it with its ``checkpoint`` (the
    keys' counts live there). A run that finds nothing new adds nothing. The
    number of state partitions is the session's number of shuffle partitions
    when the checkpoint is first used."""
    rows, names = keyed_rows(stream, rules)
    counted = rows.groupBy("__fg_gid", *names).agg(F.count(F.lit(1)).alias("__fg_n"))

    def write(batch: DataFrame, batch_id: int) -> None:
        repeated = batch.filter((F.col("__fg_n") > 1) | (F.col("__fg_gid") == TOTAL))
        repeated.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    w = counted.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    with _rocksdb(stream.sparkSession):
        return w.start()


def repeated_keys(spark: SparkSession, out: str) -> DataFrame:
    """``(__fg_gid, keys..., __fg_n)`` of the keys seen more than once, each
    with its latest count, and the total's row."""
    rows = spark.read.parquet(out).drop("batch")
    keys = [c for c in rows.columns if c != "__fg_n"]
    return rows.groupBy(*keys).agg(F.max("__fg_n").alias("__fg_n"))


def unique_results(spark: SparkSession, out: str, rules: Sequence[Rule], app_id: str | None = None) -> DataFrame:
    """The rules' result table (as of ``run_rules``) over all arrivals so
    far; before the first one every rule passes over no rows."""
    sets = _key_sets(rules)
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    counts: dict[int, int] = {}
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        per_list = repeated_keys(spark, out).groupBy("__fg_gid").agg(F.count(F.lit(1)).alias("keys"), F.max("__fg_n").alias("n"))
        counts = {r["__fg_gid"]: r["n"] if r["__fg_gid"] == TOTAL else r["keys"] for r in per_list.collect()}  # one row per key list
    total = int(counts.get(TOTAL, 0))
    rows = []
    for r in rules:
        fails = int(counts.get(sets.index(tuple(sorted(set(r.columns)))), 0))
        rows.append((app_id or application_id(spark), r.dq_id, r.rule_id, r.name, r.rule_type, r.description, r.target,
                     "fail" if fails else "pass", total - fails, fails, total, total >= fails))
    return local_table(spark, rows, RESULT_SCHEMA)
