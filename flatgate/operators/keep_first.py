"""Keep-first across jobs: F9 over everything that has arrived so far.

The rows that stay live in a store cut into buckets by a hash of their key.
An arrival is reduced by itself, then merged with the buckets that its keys
fall into and with no others; the merged buckets are written beside the old
ones and published by one manifest file that says which version each bucket
has. A reader sees the store before an arrival or after it; a job that dies
in between leaves files that no manifest names, and may simply run again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatgate.operators.columns import dedup_keep_first
from flatgate.operators.commits import CommitLog
from flatgate.operators.flatten import quote
from flatgate.session import remove_scratch, scratch_dir

BUCKET = "__fg_bucket"


class KeepFirstStore(CommitLog):
    """Kept rows at ``path``: one per key, the first by ``order_by`` (see
    ``columns.dedup_keep_first``, whose rules on ties and nulls hold).

    ``buckets`` is fixed by the first arrival; choose it so that a bucket is
    a few hundred MB when the store is full."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order_by: Sequence[str], buckets: int = 256):
        super().__init__(spark, path)
        self.keys, self.order_by, self.buckets = list(keys), list(order_by), buckets

    def manifest(self) -> dict:
        """Version, last arrival, the rows' schema, and each bucket's folder."""
        versions, _ = self._listed()
        if not versions:
            return {"version": 0, "arrival": None, "schema": None, "count": self.buckets, "buckets": {}}
        return json.loads(self._read(f"{versions[-1]:012d}.json"))

    def _bucketed(self, df: DataFrame, count: int) -> DataFrame:
        return df.withColumn(BUCKET, F.expr(f"pmod(xxhash64({', '.join(map(quote, self.keys))}), {count})"))

    def _rows_of(self, manifest: dict, only: Sequence[int] | None = None) -> DataFrame | None:
        folders = [f for b, f in manifest["buckets"].items() if only is None or int(b) in set(only)]
        if not folders:
            return None
        return self.spark.read.schema(manifest["schema"]).parquet(*[f"{self.path}/{f}" for f in folders])

    def rows(self) -> DataFrame:
        """The rows kept so far."""
        manifest = self.manifest()
        if manifest["schema"] is None:
            raise ValueError("nothing has arrived yet")
        found = self._rows_of(manifest)
        return found if found is not None else self.spark.createDataFrame([], manifest["schema"])

    def add(self, df: DataFrame, arrival: str) -> int:
        """Merge an arrival; returns the store's version. The arrival that
        was merged last is not merged again. Two jobs at one time: the one
        that publishes second starts again from the other's result."""
        spark = self.spark
        scratch = scratch_dir(spark, "arrival")
        first = self.manifest()
        new = dedup_keep_first(df, self.keys, self.order_by)
        ddl = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in new.schema.fields)
        if first["schema"] not in (None, ddl):
            raise ValueError(f"the arrival's columns are not the store's: {ddl} / {first['schema']}")
        self._bucketed(new, first["count"]).write.parquet(scratch)
        arrived = spark.read.parquet(scratch)
        touched = [r[0] for r in arrived.select(BUCKET).distinct().collect()]  # at most as many as buckets
        try:
            while True:
                manifest = self.manifest()
                if manifest["arrival"] == arrival:
                    return manifest["version"]
                version = manifest["version"] + 1
                folder = f"rows-{version:012d}-{uuid.uuid4().hex[:8]}"
                old = self._rows_of(manifest, touched)
                merged = arrived.drop(BUCKET) if old is None else dedup_keep_first(
                    arrived.drop(BUCKET).unionByName(old), self.keys, self.order_by)
                self._bucketed(merged, manifest["count"]).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
                buckets = {**manifest["buckets"], **{str(b): f"{folder}/{BUCKET}={b}" for b in touched}}
                text = json.dumps({"version": version, "arrival": arrival, "schema": ddl, "count": manifest["count"], "buckets": buckets})
                if self._publish(f"{version:012d}.json", text):
                    self._clean(version)
                    return version
                self._files.delete(self._at(folder), True)
        finally:
            remove_scratch(spark, scratch)

    def _clean(self, version: int) -> None:
        """Delete what neither this version nor the one before it reads."""
        versions, _ = self._listed()
        live = [json.loads(self._read(f"{v:012d}.json"))["buckets"].values() for v in versions if v >= version - 1]
        used = {f for folders in live for f in folders}
        for v in versions:
            if v < version - 1:
                gone = set(json.loads(self._read(f"{v:012d}.json"))["buckets"].values()) - used
                for folder in gone:
                    self._files.delete(self._at(folder), True)
                self._files.delete(self._at(f"{v:012d}.json"), False)
