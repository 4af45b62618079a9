"""Paths and marks that no key and no field of the data can imitate."""

import json
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flatgate.operators.flatten import leaf_paths, leaf_steps
from flatgate.plans.ingest import bad_rows, flag_frame, good_rows, validate_and_process
from flatgate.sources.json import corrupt_column, corrupt_rows, infer_schema, read_json_docs, read_json_lines


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, doc string")


def steps_of(df):
    return [(r.id, None if r.steps is None else tuple(s.key if s.key is not None else s.pos for s in r.steps), r.value) for r in df.collect()]


def test_keys_that_spell_another_path(spark):
    df = docs(spark, '{"a": {"b": 1}, "a_b": 2}', '{"x": {"0": "k"}, "x_0": "j"}', '{"x": ["p"]}', '{"_corrupt_record": "mine"}', '{"broken": ',
              '{"": {"": 1}, "_": 2}', '7')
    assert sorted(steps_of(leaf_steps(df, "id", "doc")), key=repr) == sorted([
        (0, ("a", "b"), "1"), (0, ("a_b",), "2"), (1, ("x", "0"), "k"), (1, ("x_0",), "j"), (2, ("x", 0), "p"), (3, ("_corrupt_record",), "mine"),
        (4, None, '{"broken": '), (5, ("", ""), "1"), (5, ("_",), "2"), (6, (), "7")], key=repr)
    kinds = {(r.id, len(r.steps or [])): r.kind for r in leaf_steps(docs(spark, '{"a": null}', '["x"]', "{"), "id", "doc").collect()}
    assert kinds == {(0, 1): "VOID", (1, 1): "STRING", (2, 0): None}
    escaped = [(r.id, r.path) for r in leaf_paths(df, "id", "doc", escape=True).collect()]
    assert len(set(escaped)) == len(escaped)
    assert {(0, "a_b"), (0, "a\\_b"), (1, "x_0"), (1, "x\\_0"), (2, "x_[0]"), (3, "\\_corrupt\\_record"), (4, "_corrupt_record")} <= set(escaped)
    # the default spelling is unchanged
    assert sorted(r.path for r in leaf_paths(df.filter("id = 0"), "id", "doc").collect()) == ["a_b", "a_b"]


def leaves(value, at=()):
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in leaves(v, (*at, k))]
    if isinstance(value, list):
        return [x for i, v in enumerate(value) for x in leaves(v, (*at, i))]
    return [(at, value)]


KEYS = st.text(alphabet="a_0\\[].", max_size=3)
DOCS = st.recursive(st.integers(0, 9) | st.text(alphabet="ab", max_size=2), lambda x: st.lists(x, max_size=3) | st.dictionaries(KEYS, x, max_size=3), max_leaves=8)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(DOCS, min_size=1, max_size=8))
def test_steps_and_escaped_paths_are_those_of_the_document(spark, values):
    df = docs(spark, *map(json.dumps, values))
    want = [(i, at, str(v)) for i, value in enumerate(values) for at, v in leaves(value)]
    assert sorted(steps_of(leaf_steps(df, "id", "doc")), key=repr) == sorted(want, key=repr)
    paths = [(r.id, r.path) for r in leaf_paths(df, "id", "doc", escape=True).collect()]
    assert len(set(paths)) == len(paths) or any("" in at for _, at, _ in want)


LINES = '{"id": 1, "_corrupt_record": "mine"}\n{"id": 2, "_corrupt_record": \n{"id": 3}\n'


def test_a_field_called_like_the_mark_keeps_its_values(spark, tmp):
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/in/a.json", "w") as f:
        f.write(LINES)
    schema = infer_schema(spark, f"{tmp}/in")
    assert sorted(schema.fieldNames()) == ["_corrupt_record", "id"]
    for given_schema in (schema, "id bigint, _corrupt_record string", None):
        df = read_json_lines(spark, f"{tmp}/in", schema=given_schema, keep_corrupt=True)
        assert corrupt_column(df) == "_corrupt_record_2"
        assert sorted((r.id or 0, r._corrupt_record, r._corrupt_record_2) for r in df.collect()) == [
            (0, None, '{"id": 2, "_corrupt_record": '), (1, "mine", None), (3, None, None)]
        assert [r._corrupt_record_2 for r in corrupt_rows(df).collect()] == ['{"id": 2, "_corrupt_record": ']
    plain = read_json_lines(spark, f"{tmp}/in", schema="id bigint, _corrupt_record string")
    assert corrupt_column(plain) is None
    assert sorted((r.id or 0, r._corrupt_record) for r in plain.collect()) == [(0, None), (1, "mine"), (3, None)]
    with open(f"{tmp}/doc.json", "w") as f:
        f.write('[{"id": 1, "_corrupt_record": "mine"}]')
    whole = read_json_docs(spark, f"{tmp}/doc.json", schema="id bigint, _corrupt_record string", keep_corrupt=True)
    assert [tuple(r) for r in whole.collect()] == [(1, "mine", None)]


def test_ingest_keeps_the_field_and_quarantines_by_the_mark(spark, tmp):
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/in/a.json", "w") as f:
        f.write(LINES)
    res = validate_and_process(spark, f"{tmp}/in", ["id"], f"{tmp}/out", job_id="j")
    assert (res.total, res.errors) == (3, 1)
    good = good_rows(spark, f"{tmp}/out", "j")
    assert sorted((r.id, r._corrupt_record) for r in good.collect()) == [(1, "mine"), (3, None)] and "_corrupt_record_2" not in good.columns
    assert bad_rows(spark, f"{tmp}/out", "j").first()._corrupt_record_2 == '{"id": 2, "_corrupt_record": '
    # nothing is taken for a mark that is not one
    own = spark.createDataFrame([(1, "text")], "id int, _corrupt_record string")
    assert [r.null_check_result for r in flag_frame(own, ["id"]).collect()] == [False]


def rebuilt(value, inner=False):
    """What leaves can tell of a document: empty containers are gone, or
    null inside an array up to its last element that has a leaf."""
    if isinstance(value, dict):
        found = {k: x for k, v in value.items() if (x := rebuilt(v)) is not MISSING}
        return found or MISSING
    if isinstance(value, list):
        found = [rebuilt(v) for v in value]
        while found and found[-1] is MISSING:
            found.pop()
        return [None if x is MISSING else x for x in found] or MISSING
    return value


MISSING = object()
RICH = st.recursive(st.integers(-9, 9) | st.booleans() | st.none() | st.text(alphabet='a"\\é{}[]:, \n', max_size=4),
                    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(alphabet='a_0"\\.', max_size=3), x, max_size=3), max_leaves=10)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(RICH, min_size=1, max_size=6))
def test_documents_are_rebuilt_from_their_leaves(spark, values):
    from flatgate.operators.flatten import documents_from_leaves

    df = docs(spark, *map(json.dumps, values), '{"cut": ')
    got = {r.id: r.doc for r in documents_from_leaves(leaf_steps(df, "id", "doc"), "id").collect()}
    assert got.pop(len(values)) == '{"cut": '
    want = {i: x for i, v in enumerate(values) if (x := rebuilt(v)) is not MISSING}
    assert {i: json.loads(d) for i, d in got.items()} == want


def test_levels_group_within_a_document(spark):
    from flatgate.operators.flatten import documents_from_leaves

    df = docs(spark, '{"a": {"b": [{"c": 1}, {"d": [2, 3]}]}, "e": "x"}', "7", "[]")
    rebuilt_docs = documents_from_leaves(leaf_steps(df, "id", "doc"), "id")
    exchanges = [line for line in rebuilt_docs._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert 0 < len(exchanges) <= 5 and all("hashpartitioning(id#" in x and "up#" not in x for x in exchanges)
    assert sorted(map(tuple, rebuilt_docs.collect())) == [(0, '{"a":{"b":[{"c":1},{"d":[2,3]}]},"e":"x"}'), (1, "7")]
    assert documents_from_leaves(leaf_steps(docs(spark, "{}"), "id", "doc"), "id").collect() == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_rebuilt_in_one_shuffle(spark):
    from flatgate.operators.flatten import documents_from_leaves

    values = [{"a": {"b": [{"c": i}, [], {"d": [2, None, "x\u001f"]}]}, 'k"\u001f': [[], [i]], "n": i % 3} for i in range(40)]
    df = docs(spark, *map(json.dumps, values), "7", '{"cut": ')
    steps = leaf_steps(df, "id", "doc", depth=6)
    assert plan_of(steps).count("Generate variant_explode") == 6 and "Generate explode" not in plan_of(steps)
    folders = spark.sparkContext._jvm.java.io.File(spark.sparkContext.getCheckpointDir().replace("file:", "")).list
    before = list(folders())
    whole = documents_from_leaves(steps, "id")
    assert plan_of(whole).count("Exchange hashpartitioning") == 1 and list(folders()) == before
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # documents lie across batches
    try:
        got = {r.id: r.doc for r in whole.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert (got.pop(40), got.pop(41)) == ("7", '{"cut": ')
    assert {i: json.loads(d) for i, d in got.items()} == {i: rebuilt(v) for i, v in enumerate(values)}
    assert got[1] == '{"a":{"b":[{"c":1},null,{"d":[2,null,"x\\u001F"]}]},"k\\"\\u001F":[null,[1]],"n":1}'


def test_repeated_and_null_ids_are_one_document(spark):
    from flatgate.operators.flatten import documents_from_leaves

    rows = [(None, '{"a":[1,2],"b":3}'), (None, '{"a":{"k":1},"b":[7]}'), (None, "[5]"), (None, "6"), (None, '{"cut"'), (None, '{"cut"'),
            ("z", '{"q":{"n":2},"l":[{"i":1}]}'), ("z", '{"q":{"n":1},"l":[{"i":1}]}')]
    leaves = leaf_steps(spark.createDataFrame(rows, "id string, doc string"), "id", "doc")
    assert sorted((r.id or "", r.doc) for r in documents_from_leaves(leaves, "id").collect()) == [
        ("", "6"), ("", '{"a":{"k":1},"b":3,"b":[7]}'), ("", '{"cut"'), ("", '{"cut"'), ("z", '{"l":[{"i":1,"i":1}],"q":{"n":1,"n":2}}')]


def test_depths_of_a_batch():
    import pyarrow as pa

    from flatgate.operators.flatten import _json_depths

    texts = ["", "7", '{"a\\\\":"[[[","b\\"{":[[1]]}', "[" * 12 + "]" * 12, '"[é{"', "[[]", '{"a":[],"b":{"c":[0]}}']
    assert _json_depths(pa.array(texts)).tolist() == [0, 0, 3, 12, 0, 2, 3]
    assert _json_depths(pa.array(texts).slice(3)).tolist() == [12, 0, 2, 3]
