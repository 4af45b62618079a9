"""Column operators (F7-F9, K6), separators and write modes."""

import os

from pyspark.sql import functions as F

from flatgate.operators import rules as R
from flatgate.operators.columns import dedup_keep_first, keep_known, merge_array_field, merge_columns, preview
from flatgate.operators.flatten import flatten, flatten_positional
from flatgate.sinks.files import write_flat_csv, write_good, read_csv


def test_merge_columns_skips_nulls_and_keeps_frame_order(spark):
    df = spark.createDataFrame([("a", None, "c", "x"), (None, None, None, "y")],
                               "apps_0_slug string, apps_1_slug string, apps_10_slug string, other string")
    out = merge_columns(df, r"apps_\d+_slug", "finger")
    assert [r.finger for r in out.orderBy("other").collect()] == ["a,c", ""]
    # a single-digit pattern admits indices 0-9 only
    out9 = merge_columns(df, r"apps_\d_slug", "finger")
    assert out9.orderBy("other").first().finger == "a"


def test_merge_array_field_matches_positional_merge(spark):
    df = spark.sql("SELECT 1 AS id, array(named_struct('slug', 'a'), named_struct('slug', NULL), "
                   "named_struct('slug', 'c')) AS apps")
    a = merge_array_field(df, "apps", "slug", "finger").first().finger
    b = merge_columns(flatten_positional(df), r"apps_\d+_slug", "finger").first().finger
    assert a == b == "a,c"


def test_keep_known_and_preview(spark):
    df = spark.range(500).select("id", (F.col("id") * 2).alias("b"), F.lit(1).alias("c"))
    assert keep_known(df, ["c", "id", "missing"]).columns == ["id", "c"]
    top = preview(df, [F.col("id").desc()], 3).collect()
    assert [r.id for r in top] == [499, 498, 497]


def test_dedup_keep_first_null_keys_and_order(spark):
    df = spark.createDataFrame([(3, "x", "late"), (1, "x", "early"), (2, None, "n1"), (5, None, "n2"), (4, "y", "y")],
                               "id int, k string, v string")
    got = sorted(tuple(r) for r in dedup_keep_first(df, ["k"], ["id"]).collect())
    assert got == [(1, "x", "early"), (2, None, "n1"), (4, "y", "y")]


def test_multi_character_separator_leaves_no_residue(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1)) AS a, array(named_struct('d', 2)) AS xs")
    assert sorted(flatten(df, prefix=True, sep="__").columns) == ["a__b__c", "xs__d"]
    assert sorted(flatten_positional(df, sep="::").columns) == ["a::b::c", "xs::0::d"]


def test_write_good_dynamic_overwrite_keeps_other_partitions(spark, tmp):
    path = os.path.join(tmp, "good")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    write_good(df, path, partition_by=["p"])
    write_good(spark.createDataFrame([(9, "a")], "v int, p string"), path, partition_by=["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(2, "b"), (9, "a")]


def test_write_flat_csv_appends(spark, tmp):
    path = os.path.join(tmp, "flat")
    df = spark.createDataFrame([(1, "a")], "v int, s string")
    write_flat_csv(df, path)
    write_flat_csv(df, path)
    assert read_csv(spark, path, schema="v int, s string").count() == 2


def test_run_rules_concurrent_query_rules(spark):
    df = spark.range(100)
    rules = [R.Rule(i, f"q{i}", R.QUERY, query=f"SELECT * FROM temp WHERE id < {i * 10}") for i in range(1, 6)]
    rules.append(R.Rule(9, "ids", R.UNIQUE, columns=("id",)))
    res = {r.rule_id: r.fail_count for r in R.run_rules(df, rules, max_concurrent_jobs=4).collect()}
    assert res == {1: 10, 2: 20, 3: 30, 4: 40, 5: 50, 9: 0}
