"""Arrival audit, keep-first across jobs, zipped flatten."""

import os
import random

import pytest

from flatgate.operators.columns import dedup_keep_first
from flatgate.operators.flatten import explode_all, flatten_zipped
from flatgate.operators.keep_first import KeepFirstStore
from flatgate.sources.arrivals import arrivals_audit, arrived_files


def touch(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_arrivals_from_the_listing(spark, tmp):
    for name, text in (("a/one.json", "{}"), ("b/one.json", ""), ("a/two.json", ""), ("with space & %41.json", "{}\n{}"), ("extra.json", "{}"),
                       ("_hidden.json", "{}"), ("notes.txt", "x")):
        touch(f"{tmp}/in/{name}", text)
    got = {r.file_name: (r.status, r.n_files, r.n_empty, r.bytes, r.last_modified is not None)
           for r in arrivals_audit(spark, f"{tmp}/in", ["one.json", "two.json", "with space & %41.json", "gone.json", "gone.json"], glob="*.json").collect()}
    assert got == {"one.json": ("present", 2, 1, 2, True), "two.json": ("empty", 1, 1, 0, False), "with space & %41.json": ("present", 1, 0, 5, True),
                   "gone.json": ("missing", 0, 0, 0, False), "extra.json": ("unexpected", 1, 0, 2, True)}
    by_folder = {r.file_name: r.status for r in arrivals_audit(spark, f"{tmp}/in", spark.createDataFrame([("a",), ("c",)], "file_name string"), level=2).collect()}
    assert by_folder["a"] == "present" and by_folder["b"] == "unexpected" and by_folder["c"] == "missing"


def test_no_content_is_read(spark, tmp):
    touch(f"{tmp}/in/a.json", "{}")
    plan = arrived_files(spark, f"{tmp}/in")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


ARRIVALS = [
    [(1, "a", 5), (2, "b", 5), (3, None, 5), (4, "a", 7)], [(5, "a", 1), (6, "c", 9)], [(7, None, 6), (8, "b", None), (9, "d", 2), (9, "d", 2)], []]


@pytest.mark.parametrize("buckets", [1, 5, 64])
def test_store_equals_keep_first_over_the_union(spark, tmp, buckets):
    schema, seen = "id int, k string, o int", []
    for i, batch in enumerate(ARRIVALS):
        store = KeepFirstStore(spark, f"{tmp}/store", ["k"], ["o", "id"], buckets)
        store.add(spark.createDataFrame(batch, schema), f"a{i}")
        store.add(spark.createDataFrame(batch, schema), f"a{i}")  # repeated: nothing happens
        seen += batch
        want = dedup_keep_first(spark.createDataFrame(seen, schema), ["k"], ["o", "id"]).collect()
        assert sorted(map(repr, store.rows().collect())) == sorted(map(repr, want))
    assert store.manifest()["version"] == 4
    with pytest.raises(ValueError, match="columns"):
        store.add(spark.createDataFrame([("1", "a", 1)], "id string, k string, o int"), "other")


def test_an_arrival_reads_and_writes_its_buckets_only(spark, tmp):
    store = KeepFirstStore(spark, f"{tmp}/store", ["k"], ["id"], buckets=32)
    store.add(spark.range(2000).selectExpr("id", "id % 500 AS k"), "first")
    before = store.manifest()["buckets"]
    store.add(spark.createDataFrame([(5000, 7), (1, 700)], "id long, k long"), "second")
    after = store.manifest()["buckets"]
    changed = {b for b in after if after[b] != before.get(b)}
    assert len(before) == 32 and 1 <= len(changed) <= 2
    read = store._rows_of(store.manifest(), [int(b) for b in changed]).inputFiles()
    assert all(any(after[b] in f for b in changed) for f in read)
    assert store.rows().count() == 501
    # superseded buckets go once no manifest of the last two names them
    store.add(spark.createDataFrame([(9000, 7)], "id long, k long"), "third")
    folders = {d for _, ds, _ in os.walk(f"{tmp}/store") for d in ds if d.startswith("__fg_bucket")}
    assert len(folders) == 32 and store.rows().count() == 501
    manifests = [n for n in os.listdir(f"{tmp}/store") if n.endswith(".json")]
    assert len(manifests) == 2


def test_a_job_that_dies_before_publishing_changes_nothing(spark, tmp, monkeypatch):
    store = KeepFirstStore(spark, f"{tmp}/store", ["k"], ["id"], buckets=4)
    store.add(spark.createDataFrame([(3, "x")], "id int, k string"), "first")
    monkeypatch.setattr(KeepFirstStore, "_publish", lambda self, *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        store.add(spark.createDataFrame([(1, "x"), (2, "y")], "id int, k string"), "second")
    monkeypatch.undo()
    assert [tuple(r) for r in store.rows().collect()] == [(3, "x")]
    store.add(spark.createDataFrame([(1, "x"), (2, "y")], "id int, k string"), "second")
    assert sorted(tuple(r) for r in store.rows().collect()) == [(1, "x"), (2, "y")]


def test_siblings_advance_together(spark):
    schema = "id int, a array<int>, s struct<b: array<string>, c: array<struct<d: int, e: array<int>>>>, m map<string, int>"
    rows = [(1, [1, 2, 3], (["x"], [(7, [70, 71]), (8, None)]), {"k": 1}), (2, None, None, None), (3, [], ([], []), {}), (4, [5], (None, [(9, [])]), None)]
    df = flatten_zipped(spark.createDataFrame(rows, schema))
    assert df.columns == ["id", "a", "m", "s_b", "s_c_d", "s_c_e"] or set(df.columns) == {"id", "a", "m", "s_b", "s_c_d", "s_c_e"}
    got = sorted(((r.id, r.a, r.s_b, r.s_c_d, r.s_c_e) for r in df.collect()), key=repr)
    assert got == sorted([(1, 1, "x", 7, 70), (1, 1, "x", 7, 71), (1, 2, None, 8, None), (1, 3, None, None, None), (2, None, None, None, None),
                          (3, None, None, None, None), (4, 5, None, 9, None)], key=repr)


def test_zipped_rows_are_the_longest_array_not_the_product(spark):
    r = random.Random(2)
    rows = [(i, [0] * r.randrange(6), [0] * r.randrange(6), [0] * r.randrange(6)) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, a array<int>, b array<int>, `a.b` array<int>")
    assert flatten_zipped(df).count() == sum(max(1, *map(len, row[1:])) for row in rows)
    assert explode_all(df).count() == sum(max(1, len(a)) * max(1, len(b)) * max(1, len(c)) for _, a, b, c in rows)
    plan = flatten_zipped(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Exchange" not in plan
