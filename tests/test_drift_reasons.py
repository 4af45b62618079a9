"""Schema drift by arrival; the rules that each row fails."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatgate.operators import rules as R
from flatgate.operators.drift import schema_drift, stored_paths
from flatgate.operators.reasons import quarantine_reasons, row_reasons, with_identity


def drift(spark, schema, *docs):
    df = spark.createDataFrame([(a, d) for a, d in docs], "arrival string, doc string")
    got = schema_drift(df, "doc", "arrival", spark.createDataFrame([], schema).schema).collect()
    return {(r.arrival, r.path): (r.status, r.stored_type, r.observed_type, r.n_values) for r in got}


@pytest.mark.parametrize("stored, value, status, seen", [
    ("bigint", "1", "same", "BIGINT"), ("bigint", "null", "same", "VOID"), ("bigint", "1.5", "widened", "DECIMAL"), ("bigint", "1e0", "widened", "DOUBLE"),
    ("double", "1", "same", "BIGINT"), ("double", "1.5", "same", "DECIMAL"), ("decimal(9,2)", "1e0", "widened", "DOUBLE"),
    ("bigint", '"1"', "conflicting", "STRING"), ("string", "1", "same", "BIGINT"), ("string", "true", "same", "BOOLEAN"),
    ("string", '{"a": 1}', "conflicting", "OBJECT"), ("boolean", "1", "conflicting", "BIGINT"), ("struct<a: int>", '{"a": 1}', "same", "OBJECT"),
    ("struct<a: int>", "[1]", "conflicting", "ARRAY"), ("array<int>", '"x"', "conflicting", "STRING"), ("date", '"2024-01-01"', "same", "STRING")])
def test_status_of_one_value(spark, stored, value, status, seen):
    got = drift(spark, f"v {stored}", ("a", f'{{"v": {value}}}'))
    assert got["a", ".v"][0] == status and got["a", ".v"][2] == seen


def test_arrivals_are_apart_and_kinds_merge(spark):
    got = drift(spark, "v bigint, w string, l array<struct<x: bigint>>",
                ("a", '{"v": 1, "l": [{"x": 1}, {"x": 2.5}, {"y": {"": 0}}]}'), ("a", '{"v": "t"}'), ("b", '{"v": 1, "w": null, "l": []}'),
                ("b", "{"), ("b", "{{"), ("c", None), ("d", "[7]"), ("e", '{"a.b": {"c[0]": 1, "d\\\\e": 2}, "a": {"b": 3}}'), ("f", "{}"))
    assert got["a", ".v"] == ("conflicting", "BIGINT", "BIGINT|STRING", 2)
    assert got["a", ".l"] == ("same", "ARRAY", "ARRAY", 3) and got["a", ".l[]"] == ("same", "OBJECT", "OBJECT", 3)
    assert got["a", ".l[].x"] == ("widened", "BIGINT", "BIGINT|DECIMAL", 2)
    assert got["a", ".l[].y"][0] == "added" and got["a", ".l[].y."] == ("added", None, "BIGINT", 1)
    assert got["a", ".w"] == ("absent", "STRING", None, 0)
    assert got["b", None] == ("malformed", None, None, 2) and got["b", ".w"] == ("same", "STRING", "VOID", 1)
    assert got["b", ".l"][0] == "absent"  # an empty array says nothing
    assert got["d", "[]"] == ("added", None, "BIGINT", 1) and got["d", ".v"][0] == "absent"
    assert {p for a, p in got if a == "e" and got[a, p][0] == "added"} == {".a\\.b", ".a\\.b.c\\[0]", ".a\\.b.d\\\\e", ".a", ".a.b"}
    assert not [k for k in got if k[0] in ("c", "f")]


def test_documents_keyed_by_user_cost_the_driver_no_schema(spark):
    ids = spark.range(3000).select(F.lit(1).alias("arrival"), F.format_string('{"u%d": {"n": %d}}', "id", "id").alias("doc"))
    got = schema_drift(ids, "doc", "arrival", T.StructType([T.StructField("id", T.LongType())]), depth=2)
    assert got.groupBy("status").count().collect() and got.filter("status = 'added'").count() == 6000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_stored_maps_are_refused():
    with pytest.raises(ValueError, match="map"):
        stored_paths(T.StructType([T.StructField("m", T.MapType(T.StringType(), T.LongType()))]))


ROWS = [(1, "a", 1.0, "x"), (2, None, 2.0, "x"), (3, "  ", 3.0, "y"), (4, "b", 9.0, None), (4, "c", 1.0, None), (None, "d", 1.0, "z"), (None, "e", None, "w")]
RULES = [R.Rule(7, "v", R.NOT_NULL, columns=("v",)), R.Rule(7, "k", R.UNIQUE, columns=("k",)), R.Rule(9, "big", R.QUERY, query="SELECT k FROM temp WHERE n > 5"),
         R.Rule(10, "t", R.UNIQUE, columns=("t",)), R.Rule(11, "k, t", R.UNIQUE, columns=("t", "k")), R.Rule(12, "k again", R.UNIQUE, columns=("k",))]


def test_reasons_equal_a_check_row_by_row(spark, tmp):
    spark.createDataFrame(ROWS, "k int, v string, n double, t string").repartition(3).write.parquet(f"{tmp}/t")
    df = with_identity(spark.read.parquet(f"{tmp}/t"))
    got = {(r.k, r.v): [(x.rule_id, x.name) for x in r.failed_rules] for r in quarantine_reasons(df, RULES).collect()}
    want = {}
    for k, v, n, t in ROWS:
        fails = [(v or "").strip() == "", sum(r[0] == k for r in ROWS) > 1, n is not None and n > 5, sum(r[3] == t for r in ROWS) > 1,
                 sum((r[0], r[3]) == (k, t) for r in ROWS) > 1, sum(r[0] == k for r in ROWS) > 1]
        if any(fails):
            want[k, v] = [(r.rule_id, r.name) for r, f in zip(RULES, fails, strict=True) if f]
    assert got == want
    # counts of the rule engine agree with the rows
    counts = [r.fail_count for r in R.run_rules(df, RULES).collect()]
    assert counts[0] == sum((7, "v") in x for x in got.values()) and counts[2] == sum((9, "big") in x for x in got.values())
    assert row_reasons(df, RULES).count() == len(want) and row_reasons(df, []).count() == 0
    assert row_reasons(df.filter("false"), RULES).count() == 0


def test_identity_is_stable_and_foreign_sql_is_refused(spark, tmp):
    spark.range(40).write.parquet(f"{tmp}/t")
    a, b = (sorted(map(tuple, with_identity(spark.read.parquet(f"{tmp}/t")).repartition(n).collect())) for n in (2, 5))
    assert a == b and len({r[1:] for r in a}) == 40
    df = with_identity(spark.read.parquet(f"{tmp}/t"))
    with pytest.raises(ValueError, match="not a condition"):
        row_reasons(df, [R.Rule(1, "q", R.QUERY, query="SELECT count(*) FROM temp")])
    with pytest.raises(ValueError, match="identity"):
        with_identity(df)


def test_a_hot_key_is_one_row_of_the_joined_set(spark, tmp):
    spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id) AS k").write.parquet(f"{tmp}/t")
    df = with_identity(spark.read.parquet(f"{tmp}/t"))
    reasons = row_reasons(df, [R.Rule(1, "k", R.UNIQUE, columns=("k",))])
    assert reasons.count() == 1000
    plan = reasons._jdf.queryExecution().toString()
    assert "Window" not in plan and "partial_count" in plan
