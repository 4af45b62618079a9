"""Nothing disappears without a word: broken documents, long arrays, rule
lines, equal rule ids, null orders, clashing names, concurrent jobs."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from flatgate.operators import rules as R
from flatgate.operators.columns import dedup_keep_first, merge_columns
from flatgate.operators.flatten import flatten_positional, leaf_paths
from flatgate.operators.ledger import Ledger, latest_per_key
from flatgate.operators.quality import null_flag
from flatgate.plans.ingest import bad_rows, good_rows, ingest_frame, new_job_id, validate_and_process
from flatgate.sinks.files import read_csv, write_csv, write_report
from flatgate.sources.json import corrupt_rows, infer_schema, read_json_lines
from flatgate.sources.rules import load_rules, read_rules


def lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(rows) + "\n")


def test_leaf_paths_marks_what_does_not_parse(spark):
    big = json.dumps({"s": "x" * (20 << 20)})
    docs = [(1, '{"a": 1}'), (2, '{"a": '), (3, '{"a": 1, "a": 2}'), (4, big), (5, None), (6, "null"), (7, "[[[[" * 50)]
    df = spark.createDataFrame(docs, "id int, j string")
    got = {(r.id, r.path): r.value for r in leaf_paths(df, "id", "j").collect()}
    assert got.pop((4, "_corrupt_record")) == big
    assert got == {(1, "a"): "1", (2, "_corrupt_record"): docs[1][1], (3, "_corrupt_record"): docs[2][1], (6, ""): None,
                   (7, "_corrupt_record"): docs[6][1]}
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        leaf_paths(df.filter("id < 3"), "id", "j", malformed="fail").collect()


def test_leaf_paths_of_legal_keys_and_any_depth(spark):
    deep = json.dumps({"a": 1})
    for _ in range(70):
        deep = '{"k": ' + deep + "}"
    docs = [(1, '{"x>y": {"b": 1}, "q\\"{[": [1, {"OBJECT<": {"z": 2}}], "back`tick": "a\\\\"}'), (2, '[1, {"a": [2, {"b": [3]}]}]')]
    got = sorted((r.id, r.path, r.value) for r in leaf_paths(spark.createDataFrame(docs, "id int, j string"), "id", "j").collect())
    assert got == sorted([(1, "x>y_b", "1"), (1, 'q"{[_0', "1"), (1, 'q"{[_1_OBJECT<_z', "2"), (1, "back`tick", "a\\"),
                          (2, "0", "1"), (2, "1_a_0", "2"), (2, "1_a_1_b_0", "3")])
    keys = spark.range(20_000).select("id", F.concat(F.lit('{"user_'), "id", F.lit('": {"n": '), "id", F.lit("}}")).alias("j"))
    assert leaf_paths(keys, "id", "j").filter("value = cast(id AS string)").count() == 20_000


def test_positional_never_truncates(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [4])], "id int, xs array<int>")
    with pytest.raises(Exception, match="more than max_items=2"):
        flatten_positional(df, max_items=2).collect()
    assert flatten_positional(df, max_items=3).columns == ["id", "xs_0", "xs_1", "xs_2"]
    with pytest.raises(ValueError, match="at least 1"):
        flatten_positional(df, max_items=0)
    with pytest.raises(ValueError, match="use leaf_paths"):
        flatten_positional(df, max_columns=3)


def test_rule_file_keeps_every_line(spark, tmp):
    path = f"{tmp}/flat.json"
    lines(path, ['{"columns": "a, b", "dq_file_path": "/q"}', "", '{"columns": "c"}', '{"rule_id": 9, "columns": ["d"]}'])
    got = read_rules(spark, path).collect()
    assert [(r.rule_id, r.columns, r.dq_file_path) for r in got] == [(1, ["a", "b"], "/q"), (2, ["c"], None), (9, ["d"], None)]
    lines(path, ['{"dq_id": 1, "rules": [{"rule_id": 1, "rule_type": "unique", "columns": "a"}]}',
                 '{"dq_id": 2, "rules": [{"rule_id": 1, "rule_type": "not null", "columns": "a"}]}'])
    assert [(r.dq_id, r.rule_id, r.rule_type) for r in load_rules(spark, path)] == [(1, 1, "unique"), (2, 1, "not null")]
    lines(path, ['{"columns": "a"}', "{broken"])
    with pytest.raises(ValueError, match="neither one JSON document"):
        read_rules(spark, path)


def test_rules_that_share_an_id(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    rules = [R.Rule(1, "k set", R.NOT_NULL, columns=("k",), dq_id=1), R.Rule(1, "v set", R.NOT_NULL, columns=("v",), dq_id=2),
             R.Rule(1, "k", R.UNIQUE, columns=("k",), dq_id=1), R.Rule(1, "kv", R.UNIQUE, columns=("k", "v"), dq_id=1),
             R.Rule(1, "vk", R.UNIQUE, columns=("v", "k"), dq_id=1), R.Rule(1, "q", R.QUERY, query="SELECT * FROM temp", dq_id=1)]
    got = [(r.rule_name, r.fail_count, r.total_count) for r in R.run_rules(df, rules).collect()]
    assert got == [("k set", 0, 3), ("v set", 1, 3), ("k", 1, 3), ("kv", 0, 3), ("vk", 0, 3), ("q", 3, 3)]
    assert R.run_rules(df, []).collect() == []
    none = [(r.fail_count, r.total_count) for r in R.run_rules(df.limit(0), rules).collect()]
    assert none == [(0, 0)] * 6


def test_result_table_needs_no_job(spark):
    rows = R.local_table(spark, [(1, "a", None)], "i int, s string, b boolean")
    assert "LocalTableScan" in rows._jdf.queryExecution().executedPlan().toString()


def test_every_record_shapes_the_schema(spark, tmp):
    lines(f"{tmp}/in/a.json", ['{"a": 1}'] * 500 + ['{"a": 1, "rare": 2}'])
    assert infer_schema(spark, f"{tmp}/in").fieldNames() == ["a", "rare"]


def test_corrupt_rows_needs_its_column(spark, tmp):
    lines(f"{tmp}/in/a.json", ['{"a": 1}', '{"a": '])
    with pytest.raises(ValueError, match="keep_corrupt"):
        corrupt_rows(read_json_lines(spark, f"{tmp}/in", schema="a int"))
    assert corrupt_rows(read_json_lines(spark, f"{tmp}/in", schema="a int", keep_corrupt=True)).first()[1] == '{"a": '


def test_keep_first_and_latest_with_null_orders(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, None, "c"), (3, 1, "d"), (3, 2, "e"), (4, None, "g"), (4, None, "f")],
                               "k int, o int, v string")
    first = {r.k: r.v for r in dedup_keep_first(df, ["k"], ["o"]).collect()}
    assert (first[1], first[2], first[3]) == ("a", "c", "d") and first[4] in "fg"
    latest = {r.k: r.v for r in latest_per_key(df, "k", "o").collect()}
    assert (latest[1], latest[2], latest[3]) == ("b", "c", "e") and latest[4] in "fg"
    again = {r.k: r.v for r in dedup_keep_first(df.repartition(5), ["k"], ["o"]).collect()}
    assert again == first  # ties are decided alike in any order


def test_data_columns_are_not_replaced(spark, tmp):
    df = spark.createDataFrame([(1, "x")], "id int, null_check_result string")
    with pytest.raises(ValueError, match="has a column"):
        null_flag(df, "id")
    with pytest.raises(ValueError, match="has a column"):
        merge_columns(df, "id", "ID")
    lines(f"{tmp}/in/a.json", ['{"source_file": "mine", "v": 1}'])
    back = read_json_lines(spark, f"{tmp}/in", with_source=True).first()
    assert back.source_file == "mine" and back.source_file_2.endswith("a.json")
    ingest_frame(spark.createDataFrame([(1, "j", None), (None, "k", "x")], "id int, job_id string, null_check_result string"),
                 ["id"], f"{tmp}/out", "job_1")
    assert good_rows(spark, f"{tmp}/out", "job_1").first().job_id_data == "j"
    assert bad_rows(spark, f"{tmp}/out", "job_1").first().null_check_result_data == "x"


def test_jobs_of_one_second_do_not_meet():
    assert len({new_job_id() for _ in range(100)}) == 100


def test_new_checkpoint_keeps_old_rows_and_counts_are_recorded(spark, tmp):
    from flatgate.streaming.files import stream_ingest, stream_json

    lines(f"{tmp}/in/a.json", ['{"id": 1}', '{"id": null}'])
    ledger, seen = Ledger(spark, f"{tmp}/ledger"), []
    stream_ingest(stream_json(spark, f"{tmp}/in", "id int"), ["id"], f"{tmp}/out", f"{tmp}/c1", ledger=ledger, on_batch=seen.append).awaitTermination()
    lines(f"{tmp}/in2/b.json", ['{"id": 7}'])
    stream_ingest(stream_json(spark, f"{tmp}/in2", "id int"), ["id"], f"{tmp}/out", f"{tmp}/c2", ledger=ledger, on_batch=seen.append).awaitTermination()
    assert good_rows(spark, f"{tmp}/out").count() == 2 and bad_rows(spark, f"{tmp}/out").count() == 1
    assert [(r.total, r.loaded, r.errors) for r in seen] == [(2, 1, 1), (1, 1, 0)]
    assert sorted((r.total_record_count, r.status) for r in ledger.current().collect()) == [(1, "COMPLETED"), (2, "COMPLETED")]


def test_ledger_times_are_instants(spark, tmp, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        ledger = Ledger(spark, f"{tmp}/ledger")
        ledger.start("a", "", None, "", "", at=dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
        ledger.start("b", "", None, "", "", at=dt.datetime(2024, 1, 1))  # without a zone: UTC
        ledger.start("c", "", None, "", "")
        got = {r.job_id: r.t for r in ledger.current().select("job_id", F.unix_timestamp("job_start_time").alias("t")).collect()}
        assert got["a"] == got["b"] == 1704067200
        assert abs(got["c"] - time.time()) < 60
    finally:
        monkeypatch.undo()
        time.tzset()


def test_broken_records_keep_their_text(spark, tmp):
    lines(f"{tmp}/in/a.json", ['{"id": 1, "v": "x"}', '{"id": 2, "v"'])
    for schema in (None, "id int, v string"):
        out = f"{tmp}/out_{schema is None}"
        res = validate_and_process(spark, f"{tmp}/in", "id", out, job_id="j", schema=schema, quarantine_root=f"{out}/q")
        assert (res.total, res.errors) == (2, 1)
        assert bad_rows(spark, out, "j").first()._corrupt_record == '{"id": 2, "v"'
        assert good_rows(spark, out, "j").columns == ["id", "v", "source_file"]
        assert '""v""' in "".join(open(f"{out}/q/quarantine/job_id=j/{f}").read() for f in os.listdir(f"{out}/q/quarantine/job_id=j") if f.endswith("csv"))


def test_csv_keeps_empty_and_null_apart(spark, tmp):
    df = spark.createDataFrame([(1, ""), (2, None), (3, " "), (4, "a")], "id int, s string")
    write_csv(df, f"{tmp}/csv", mode="overwrite")
    assert sorted(map(tuple, read_csv(spark, f"{tmp}/csv", schema=df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_a_report_replaces_its_own_pages_only(spark, tmp):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for n, text in ((1, "a"), (2, "b"), (1, "c")):
            write_report(spark.createDataFrame([(n, text)], "dq_id int, html string"), f"{tmp}/r")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert {(r.dq_id, r.value) for r in spark.read.text(f"{tmp}/r").collect()} == {(1, "c"), (2, "b")}


def test_a_repeated_csv_job_doubles_nothing(spark, tmp):
    from flatgate.plans.documents import json_docs_to_csv, write_json_docs

    write_json_docs(spark.range(5).select("id", F.struct("id").alias("s")), f"{tmp}/docs")
    for _ in range(2):
        json_docs_to_csv(spark, f"{tmp}/docs", f"{tmp}/csv", schema="id bigint, s struct<id bigint>", job_id="j")
    assert read_csv(spark, f"{tmp}/csv").count() == 5


def test_scratch_goes_with_the_process(tmp):
    import subprocess
    import sys

    code = ("from flatgate.session import get_session, scratch_dir; s = get_session('local', **{'spark.checkpoint.dir': %r}); "
            "s.range(3).write.parquet(scratch_dir(s)); import os; print([f for d, _, f in os.walk(%r) if '/scratch-' in d])") % (tmp, tmp)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200,
                          cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "parquet" in done.stdout, done.stderr[-500:]
    assert not [d for d, _, _ in os.walk(tmp) if os.path.basename(d).startswith("scratch-")]


def test_expected_files_as_a_frame(spark):
    df = spark.createDataFrame([("x/a.json",), ("x/b.json",)], "source_file string")
    want = spark.createDataFrame([("a.json",), ("c.json",), ("c.json",)], "file_name string")
    assert [r.file_name for r in R.expected_files_missing(df, want).collect()] == ["c.json"]
    assert [r.file_name for r in R.expected_files_missing(df, ["b.json", "d.json"]).collect()] == ["d.json"]


def test_stored_schema_of_the_job_entry(spark, tmp, capsys):
    from flatgate.__main__ import main

    lines(f"{tmp}/in/a.json", ['{"id": 1}', '{"id": null}'])
    lines(f"{tmp}/rules.json", [json.dumps({"columns": "id", "dq_file_path": f"{tmp}/elsewhere"})])
    for _ in range(2):  # the first job stores the schema, the second uses it
        assert main(["--profile", "local", "--source", f"{tmp}/in", "--rules", f"{tmp}/rules.json", "--out", f"{tmp}/out",
                     "--schema", f"{tmp}/schema"]) == 0
    assert [json.loads(x)["errors"] for x in capsys.readouterr().out.strip().splitlines() if x.startswith("{")] == [1, 1]
    assert len([f for f in os.listdir(f"{tmp}/elsewhere/quarantine") if f.startswith("job_id=")]) == 2


def test_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from flatgate.session import ensure_checkpoint_dir

    sc = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, getConf=lambda: {})
    session = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)
