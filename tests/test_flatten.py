"""Flatten family (F1-F6, F10) on the edge-case frames of FIXTURES.md."""

import json

from pyspark.sql import Row

from flatgate.operators.flatten import (
    complex_columns,
    explode_all,
    explode_estimate,
    flatten,
    flatten_positional,
    flatten_structs,
    leaf_paths,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_null_struct_null_and_empty_array(spark):
    df = spark.createDataFrame(
        [(1, None, [Row(v=1), Row(v=2)]), (2, Row(a=5), None), (3, Row(a=6), [])],
        "id int, s struct<a int>, xs array<struct<v int>>",
    )
    for prefix, cols in ((False, ["id", "a", "v"]), (True, ["id", "s_a", "xs_v"])):
        out = flatten(df, prefix=prefix)
        assert sorted(out.columns) == sorted(cols)
        got = rows(out.select(*cols))
        assert got == [(1, None, 1), (1, None, 2), (2, 5, None), (3, 6, None)]


def test_sibling_arrays_multiply(spark):
    df = spark.createDataFrame([(1, [1, 2], ["a", "b", "c"]), (2, [], None)], "id int, a array<int>, b array<string>")
    out = explode_all(df)
    assert out.count() == 7
    assert out.filter("id = 1").count() == 6
    assert rows(out.filter("id = 2")) == [(2, None, None)]
    assert explode_estimate(df) == 7
    assert flatten(df, prefix=True).count() == 7


def test_flatten_refuses_blow_up_when_asked(spark):
    df = spark.createDataFrame([(1, list(range(10)), list(range(10)))], "id int, a array<int>, b array<int>")
    assert flatten(df, max_rows=100).count() == 100
    try:
        flatten(df, max_rows=99)
    except ValueError as ex:
        assert "100 rows" in str(ex)
    else:
        raise AssertionError("expected the guard to refuse")


def test_name_clash_with_top_level(spark):
    df = spark.createDataFrame([(1, Row(id=2, v="x"))], "id int, s struct<id int, v string>")
    out = flatten(df)
    assert out.columns == ["id", "s_id", "v"]
    assert rows(out) == [(1, 2, "x")]


def test_child_named_as_parent_survives(spark):
    df = spark.createDataFrame([(1, Row(s=2, v="x"))], "id int, s struct<s int, v string>")
    out = flatten(df)
    assert out.columns == ["id", "s", "v"]
    assert rows(out) == [(1, 2, "x")]


def test_prefixed_clash(spark):
    df = spark.createDataFrame([(1, Row(b=2))], "a_b int, a struct<b int>")
    out = flatten(df, prefix=True)
    assert out.columns == ["a_b", "a_b_2"]
    assert rows(out) == [(1, 2)]


def test_clash_differing_in_case(spark):
    df = spark.createDataFrame([(1, Row(id=2))], "Id bigint, s struct<id bigint>")
    assert flatten(df).columns == ["Id", "s_id"]
    assert flatten(df, prefix=True).columns == ["Id", "s_id"]


def test_case_duplicates_inside_struct(spark):
    df = spark.sql("SELECT named_struct('k', 1, 'K', 2) AS s")
    out = flatten(df, prefix=True)
    assert [c.lower() for c in out.columns] == ["s_k", "s_k_2"]
    assert rows(out) == [(1, 2)]


def test_dotted_and_spaced_names(spark):
    df = spark.createDataFrame([(Row(c=1), Row(**{"e f": 2}))], "`a.b` struct<c int>, d struct<`e f` int>")
    out = flatten(df, prefix=True)
    assert out.columns == ["d_e f", "a.b_c"]  # stack order: last struct first
    assert rows(out.select("`a.b_c`", "`d_e f`")) == [(1, 2)]
    assert sorted(flatten(df).columns) == ["c", "e f"]


def test_struct_only_input_is_flattened(spark):
    df = spark.createDataFrame([(Row(t=Row(u=1)),)], "s struct<t struct<u int>>")
    assert flatten(df, prefix=True).columns == ["s_t_u"]
    assert flatten(df).columns == ["u"]


def test_array_in_array(spark):
    df = spark.createDataFrame([([[1, 2], [], None],)], "xs array<array<int>>")
    out = flatten(df, prefix=True)
    assert out.count() == 4
    assert sorted(r.xs for r in out.collect() if r.xs is not None) == [1, 2]
    assert explode_estimate(df) == 4


def test_map_kept(spark):
    df = spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    out = flatten(df, prefix=True)
    assert out.schema["m"].dataType.simpleString() == "map<string,int>"


def test_flatten_structs_order_is_stack_order(spark):
    df = spark.sql(
        "SELECT 1 AS r, named_struct('x', 1, 'p', named_struct('q', 2)) AS a, "
        "named_struct('y', 3) AS b, array(1) AS arr"
    )
    out = flatten_structs(df)
    # root leaves first, then the LAST struct's subtree, then the first's
    assert out.columns == ["r", "arr", "b_y", "a_x", "a_p_q"]


def test_complex_columns(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 1) AS s, array(1) AS xs, map('k', 1) AS m")
    assert [n for n, _ in complex_columns(df)] == ["s", "xs"]


def test_positional_flatten(spark):
    data = [
        {"ip": "1.1.1.1", "apps": [{"slug": "a"}, {"slug": "b"}], "meta": {"skip": 1, "keep": 2}, "empty": []},
        {"ip": "2.2.2.2", "apps": [{"slug": "c"}], "meta": {"skip": 3, "keep": 4}, "empty": []},
    ]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(d) for d in data]))
    out = flatten_positional(df, exclude=["skip"])
    assert sorted(out.columns) == sorted(["apps_0_slug", "apps_1_slug", "ip", "meta_keep"])
    got = {r.ip: (r.apps_0_slug, r.apps_1_slug, r.meta_keep) for r in out.collect()}
    assert got == {"1.1.1.1": ("a", "b", 2), "2.2.2.2": ("c", None, 4)}
    # a fixed width fixes the columns; positions past an array's end are null
    capped = flatten_positional(df, max_items=3, exclude=["skip"])
    assert "apps_2_slug" in capped.columns


def test_leaf_paths_deep_and_mixed(spark):
    docs = [
        (1, '{"a": {"b": [1, {"c": "x"}]}, "skip": 5, "n": null, "e": {}}'),
        (2, '{"a": 7}'),
        (3, "[1, [2]]"),
        (4, None),
    ]
    df = spark.createDataFrame(docs, "id int, j string")
    out = leaf_paths(df, "id", "j", exclude=["skip"])
    got = sorted((r.id, r.path, r.value) for r in out.collect())
    assert got == [
        (1, "a_b_0", "1"),
        (1, "a_b_1_c", "x"),
        (1, "n", None),
        (2, "a", "7"),
        (3, "0", "1"),
        (3, "1_0", "2"),
    ]


def test_leaf_paths_with_known_depth(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": 1}}'), (2, '{"a": {"b": 2}}')], "id int, j string")
    assert sorted(tuple(r) for r in leaf_paths(df, "id", "j", depth=2).collect()) == [(1, "a_b", "1"), (2, "a_b", "2")]
    try:
        leaf_paths(df, "id", "j", depth=1).collect()
    except Exception as ex:  # the guard fails the job
        assert "deeper than depth=1" in str(ex)
    else:
        raise AssertionError("a too-small depth must fail, not drop leaves")


def test_leaf_paths_depth_cap_raises(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": {"c": 1}}}'), (2, '{"a": 1}')], "id int, j string")
    try:
        leaf_paths(df, "id", "j", max_depth=1)
    except ValueError:
        pass
    else:
        raise AssertionError("expected a depth error, not silently dropped leaves")


def test_positional_unpivots_to_leaf_paths(spark):
    """F5 and F6 agree: every non-null positional cell is one leaf path."""
    docs = [
        {"id": 1, "apps": [{"slug": "a", "tags": ["x", "y"]}, {"slug": "b", "tags": []}], "m": {"k": 2}},
        {"id": 2, "apps": [{"slug": "c", "tags": ["z"]}], "m": {"k": None}},
    ]
    df = spark.read.schema("id int, apps array<struct<slug string, tags array<string>>>, m struct<k int>").json(
        spark.sparkContext.parallelize([json.dumps(d) for d in docs])
    )
    wide = flatten_positional(df).collect()
    from_wide = sorted(
        (r.id, c, str(v)) for r in wide for c, v in r.asDict().items() if v is not None and c != "id"
    )
    js = df.selectExpr("id", "to_json(struct(*)) AS j")
    long = sorted((r.id, r.path, r.value) for r in leaf_paths(js, "id", "j").collect() if r.path != "id")
    assert from_wide == long


def test_wide_document_plans_quickly(spark):
    """1,000 leaves: planning must stay seconds, not tens of seconds."""
    import time

    s1 = ", ".join(f"'f{i}', id + {i}" for i in range(600))
    s2 = ", ".join(f"'g{i}', id * {i}" for i in range(400))
    df = spark.range(10).selectExpr("id", f"named_struct({s1}) AS s", f"array(named_struct({s2}), named_struct({s2})) AS xs")
    t0 = time.perf_counter()
    out = flatten(df, prefix=True)
    assert time.perf_counter() - t0 < 15
    assert len(out.columns) == 1001 and out.count() == 20
