"""Plan-shape checks for the scale properties the README claims."""

import os
import re

import pytest
from pyspark.sql import functions as F

from flatgate.operators.columns import dedup_keep_first
from flatgate.operators.flatten import flatten
from flatgate.operators.quality import null_flag
from flatgate.operators.rules import missing_keys
from flatgate.plans import fixtures as FX
from flatgate.plans import queries as Q

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")


def plan(df, capsys) -> str:
    df.explain("formatted")
    return capsys.readouterr().out


def exchanges(p: str) -> int:
    """Shuffle nodes, counted from the formatted plan's node headers."""
    return len(re.findall(r"^\(\d+\) Exchange", p, flags=re.M))


@pytest.fixture(scope="module")
def nested_parquet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nested") / "orders")
    FX.orders_nested(spark, SF).write.parquet(path)
    return path


def test_flatten_is_narrow_and_prunes_nested_fields(spark, nested_parquet, capsys):
    df = flatten(spark.read.parquet(nested_parquet), prefix=True).select("o_orderkey", "items_l_quantity")
    p = plan(df, capsys)
    assert "Exchange" not in p
    assert "items:array<struct<l_quantity:double>>" in p  # only the used leaf is read
    assert "cust" not in p.split("ReadSchema:")[1].splitlines()[0]


def test_null_flag_and_flatten_stay_in_codegen(spark, nested_parquet, capsys):
    df = null_flag(flatten(spark.read.parquet(nested_parquet)), ["st"])
    p = plan(df, capsys)
    assert "Exchange" not in p
    assert "Generate [codegen id" in p


def test_keep_first_is_combined_map_side(spark, capsys):
    df = dedup_keep_first(spark.read.parquet(f"{SF}/documents.parquet"), ["text"], ["doc_id"])
    p = plan(df, capsys)
    assert "partial_min_by" in p
    assert exchanges(p) == 1


def test_anti_join_build_side_is_distinct(spark, capsys):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey")
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = plan(missing_keys(o, "o_orderkey", li, "l_orderkey"), capsys)
    assert "LeftAnti" in p
    assert "HashAggregate" in p  # seen keys made distinct before the join


def test_not_null_rules_are_one_global_aggregate(spark, capsys):
    from flatgate.functions.predicates import not_null_failure_sql

    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    types = {f.name: f.dataType for f in li.schema.fields}
    df = li.agg(*[F.expr(f"count_if({not_null_failure_sql([c], types)})") for c in li.columns])
    p = plan(df, capsys)
    assert exchanges(p) == 1 and "SinglePartition" in p
    assert "CAST(l_quantity" not in p  # numeric columns are never cast to text


def test_ingest_write_plan_has_no_shuffle(spark, nested_parquet, capsys):
    from flatgate.operators.quality import observe_metrics
    from flatgate.plans.ingest import flag_frame

    observed, _obs = observe_metrics(flag_frame(spark.read.parquet(nested_parquet), ["st"]))
    p = plan(observed, capsys)
    assert exchanges(p) == 0
    assert "CollectMetrics" in p


def test_unique_rules_share_one_scan(spark, capsys):
    from flatgate.operators import rules as R

    o = spark.read.parquet(f"{SF}/orders.parquet")
    frame, ids = R.unique_plan(o, [("o_orderkey",), ("o_custkey",)])
    assert len(ids) == 2
    p = plan(frame, capsys)
    assert "o_orderstatus" not in p and "count_if" not in p.split("Exchange")[0]  # the shuffle carries keys and counts only
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, flags=re.M)) == 1
    assert len(re.findall(r"^\(\d+\) Expand", p, flags=re.M)) == 1


def test_order_documents_are_built_once(spark, capsys):
    docs = Q._orders_json(spark, SF)
    assert exchanges(plan(docs, capsys)) == 0 and docs.count() == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_arrivals_grow_in_number_not_in_size(spark, monkeypatch):
    folders = {}
    real = Q.scratch_dir
    monkeypatch.setattr(Q, "scratch_dir", lambda s, name: folders.setdefault(name, real(s, name)))
    monkeypatch.setattr(Q, "ARRIVAL_ROWS", 10_000)
    totals = Q.q_stream_json_ledger(spark, SF).first()
    rows = sum(spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("orders", "lineitem"))
    sizes = [r["count"] for r in spark.read.text(folders["arrivals"]).groupBy("_metadata.file_name").count().collect()]
    assert len(sizes) == -(-rows // 10_000) > 4 and max(sizes) < 2 * min(sizes)
    assert totals.total_record_count > 0
