"""Benchmark of the headline operators.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query runs ``$BENCH_REPEATS`` times (default 5) after one warm-up; the
median is reported. Setup (nested orders written once as JSON lines and as
parquet into the shared scratch folder) is not timed.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from flatgate.operators import rules as R  # noqa: E402
from flatgate.operators.columns import dedup_keep_first  # noqa: E402
from flatgate.operators.flatten import flatten, flatten_positional, leaf_paths  # noqa: E402
from flatgate.plans import fixtures as FX  # noqa: E402
from flatgate.plans.ingest import ingest_frame  # noqa: E402
from flatgate.plans.queries import _no_lines_sql, _orders_rules, _rule_access  # noqa: E402
from flatgate.session import get_session, scratch_dir  # noqa: E402
from flatgate.sources.json import infer_schema, read_json_lines  # noqa: E402
from flatgate.streaming.files import stream_files, stream_ingest  # noqa: E402


# local[4], sf0.1; NOT the reference's -- it publishes none), keyed by the
# bench query they correspond to.
BASELINE_SEED_MEDIAN_SEC = {
    "rules_not_null_fused": 2.23,  # 11 not-null rules + total, one fused agg
    "rule_unique_lineitem": 0.93,  # unique (l_orderkey, l_linenumber)
    "json_infer": 0.42,  # schema inference, 150,000 nested orders
    "json_flatten_noop": 0.86,  # JSON scan + flatten, schema supplied
    "parquet_flatten_noop": 0.45,  # parquet scan + flatten
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    os.environ["FLATGATE_MASTER"] = f"local[{cpus}]"
    spark = get_session("local", "flatgate-bench", **{"spark.sql.shuffle.partitions": cpus})
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    # --- setup (untimed): nested orders as JSON lines and parquet ---------
    nested = FX.orders_nested(spark, sf_dir)
    json_path = scratch_dir(spark, "bench-json")
    parquet_path = scratch_dir(spark, "bench-parquet")
    # several files each, so a scan has a task for every core
    files = max(8, int(cpus))
    nested.repartition(files).write.json(json_path)
    nested.repartition(files).write.parquet(parquet_path)
    schema = spark.read.parquet(parquet_path).schema

    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    li_rules = [R.Rule(i + 1, f"nn {c}", R.NOT_NULL, columns=(c,)) for i, c in enumerate(lineitem.columns)]
    orders_nulls = FX.orders_nulls(spark, sf_dir)
    noop = lambda df: df.write.format("noop").mode("overwrite").save()

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def stream():
        s = stream_files(spark, sf_dir, spark.read.parquet(f"{sf_dir}/orders.parquet").schema, "parquet",
                         pathGlobFilter="orders.parquet").select(
            "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("st"))
        stream_ingest(s, ["st"], scratch_dir(spark, "bench-stream"), scratch_dir(spark, "bench-ckpt")).awaitTermination()

    def ingest():
        ingest_frame(read_json_lines(spark, json_path, schema=schema), ["st"], scratch_dir(spark, "bench-ingest"),
                     "job_bench")

    queries = {
        # 11 not-null rules + total: one keyless aggregation (one scan)
        "rules_not_null_fused": lambda: R.run_rules(lineitem, li_rules).collect(),
        # unique rule on (l_orderkey, l_linenumber)
        "rule_unique_lineitem": lambda: R.rule_unique(lineitem, ["l_orderkey", "l_linenumber"]).collect(),
        # 7 rules of all three types over orders (not-null scan, unique scan and query job side by side)
        "rules_report_mixed": lambda: R.run_rules(orders_nulls, _orders_rules(sf_dir), access=_rule_access(sf_dir)).collect(),
        "rule_query_orders": lambda: R.query_rule_count(spark.read.parquet(f"{sf_dir}/orders.parquet"), _no_lines_sql(sf_dir), _rule_access(sf_dir)),
        # schema inference over the nested JSON lines
        "json_infer": lambda: infer_schema(spark, json_path),
        # JSON scan + prefixed flatten, schema supplied, noop sink
        "json_flatten_noop": lambda: noop(flatten(read_json_lines(spark, json_path, schema=schema), prefix=True)),
        # parquet scan + prefixed flatten, noop sink
        "parquet_flatten_noop": lambda: noop(flatten(spark.read.parquet(parquet_path), prefix=True)),
        # the flagship pipeline: JSON -> flatten -> flag -> parquet + quarantine CSV
        "ingest_json_orders": ingest,
        # dedup of documents by text (hash aggregate, map-side combined)
        "dedup_documents": lambda: noop(dedup_keep_first(documents, ["text"], ["doc_id"])),
        # schemaless JSON leaves of events.props (one schema pass + levels)
        "leaf_paths_events": lambda: noop(leaf_paths(events, "event_id", "props")),
        # arrays to numbered columns (width from one pass)
        "flatten_positional_embeddings": lambda: noop(flatten_positional(embeddings)),
        # file-source stream, pipeline A per micro-batch (fresh checkpoint)
        "stream_ingest_orders": stream,
    }

    spark.range(1000).agg(F.sum("id")).collect()  # JVM warm-up
    timings = {}
    for name, fn in queries.items():
        fn()  # warm-up run per query (plans, codegen, file listing caches)
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 4)

    print(json.dumps({
        "metric": "flatgate_headline_total_median",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": int(cpus),
        "repeats": repeats,
        "baseline_seed": BASELINE_SEED_MEDIAN_SEC,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
