"""Sources, sinks, ledger, routing and streaming."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from flatgate.operators.ledger import Ledger, ledger_current
from flatgate.operators.routing import route_counts, route_target, with_route
from flatgate.plans.documents import write_json_docs
from flatgate.plans.ingest import bad_rows, good_rows, validate_and_process
from flatgate.sinks.files import read_csv, write_csv, write_report
from flatgate.sources.json import corrupt_rows, read_json_docs, read_json_lines
from flatgate.streaming.files import stream_ingest, stream_json


def _lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_malformed_line_is_one_corrupt_row(spark, tmp):
    p = os.path.join(tmp, "in", "a.json")
    _lines(p, ['{"a": 1}', '{"a": 2'])
    df = read_json_lines(spark, os.path.dirname(p), schema="a int", keep_corrupt=True)
    bad = corrupt_rows(df).collect()
    assert len(bad) == 1 and bad[0].a is None and bad[0]._corrupt_record == '{"a": 2'


def test_schema_inferred_once_and_stored(spark, tmp):
    from flatgate.sources.json import infer_schema, load_schema, store_schema

    p = os.path.join(tmp, "in", "s.json")
    _lines(p, ['{"a": 1, "b": {"c": [1, 2]}}', '{"a": 2, "b": null}'])
    schema = infer_schema(spark, os.path.dirname(p))
    store_schema(spark, schema, os.path.join(tmp, "schema"))
    again = load_schema(spark, os.path.join(tmp, "schema"))
    assert again == schema
    assert read_json_lines(spark, os.path.dirname(p), schema=again).count() == 2


def test_mixed_types_read_as_string(spark, tmp):
    p = os.path.join(tmp, "in", "m.json")
    _lines(p, ['{"v":1}', '{"v":{"x":2}}', '{"v":[1]}'])
    df = read_json_lines(spark, os.path.dirname(p))
    assert df.schema["v"].dataType.simpleString() == "string"
    assert sorted(r.v for r in df.collect()) == ['1', '[1]', '{"x":2}']


def test_json_docs_roundtrip(spark, tmp):
    df = spark.range(25).select("id", F.struct((F.col("id") * 2).alias("x")).alias("s"))
    write_json_docs(df, os.path.join(tmp, "docs"), max_bytes=200)
    assert len([f for f in os.listdir(os.path.join(tmp, "docs")) if f.startswith("part")]) > 3
    back = read_json_docs(spark, os.path.join(tmp, "docs"), schema=df.schema)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_csv_roundtrip_newlines_quotes_spaces(spark, tmp):
    df = spark.createDataFrame(
        [(1, 'a "quoted"\nline', "  ", None, {"k": 1}), (2, "", "x", [1, 2], None)],
        "id int, t string, s string, a array<int>, m map<string,int>",
    )
    write_csv(df, os.path.join(tmp, "csv"), mode="overwrite")
    back = read_csv(spark, os.path.join(tmp, "csv"), schema="id int, t string, s string, a string, m string")
    got = {r.id: tuple(r) for r in back.collect()}
    assert got[1][1:4] == ('a "quoted"\nline', "  ", None)
    assert got[1][4] == '{"k":1}' and got[2][3] == "[1,2]"
    assert got[2][1] == ""  # empty text and NULL stay apart


def test_ingest_pipeline_idempotent_and_ledger(spark, tmp):
    src = os.path.join(tmp, "src", "balanceSheet-1.json")
    _lines(src, [json.dumps({"accountId": "a1", "items": [{"v": 1}, {"v": 2}]}),
                 json.dumps({"accountId": None, "items": [{"v": 3}]}),
                 json.dumps({"accountId": "a3", "items": None})])
    out = os.path.join(tmp, "out")
    ledger_path = os.path.join(tmp, "ledger")
    for _ in range(2):  # a retried job replaces its own output
        res = validate_and_process(spark, os.path.dirname(src), "accountId", out, job_id="j1", ledger_path=ledger_path)
    assert (res.total, res.loaded, res.errors) == (4, 3, 1)
    assert good_rows(spark, out, "j1").count() == 3
    assert bad_rows(spark, out, "j1").count() == 1
    q = read_csv(spark, os.path.join(out, "quarantine"))
    assert q.count() == 1 and set(q.columns) >= {"accountId", "v", "null_check_result", "job_id"}
    cur = Ledger(spark, ledger_path).current().filter("job_id = 'j1'").first()
    assert cur.status == "COMPLETED" and cur.job_description == "PAYMENT"
    assert (cur.total_record_count, cur.load_record_count, cur.error_record_count) == (4, 3, 1)
    assert cur.job_start_time is not None and cur.source_path.endswith("src")
    # a retry whose input no longer has bad rows leaves no stale quarantine
    _lines(src, [json.dumps({"accountId": "a1", "items": [{"v": 1}]})])
    res = validate_and_process(spark, os.path.dirname(src), "accountId", out, job_id="j1")
    assert (res.total, res.errors) == (1, 0)
    assert bad_rows(spark, out, "j1").count() == 0 and good_rows(spark, out, "j1").count() == 1
    assert read_csv(spark, os.path.join(out, "quarantine")).count() == 0


def test_ingest_then_rules_and_report(spark, tmp):
    from flatgate.operators.rules import NOT_NULL, QUERY, UNIQUE, Rule

    src = os.path.join(tmp, "src2")
    _lines(os.path.join(src, "Invoices-1.json"), [json.dumps({"id": i, "name": None if i == 3 else f"n{i % 4}"})
                                                  for i in range(8)])
    rules = [
        Rule(1, "name", NOT_NULL, columns=("name",), dq_id=5),
        Rule(2, "name unique", UNIQUE, columns=("name",), dq_id=5),
        Rule(3, "file read", QUERY, dq_id=5, query=(
            "SELECT f FROM (SELECT 'Invoices-1.json' AS f) e LEFT JOIN (SELECT DISTINCT "
            "get(reverse(split(source_file, '/')), 0) AS g FROM temp) t ON t.g = e.f WHERE t.g IS NULL")),
    ]
    res = validate_and_process(spark, src, "name", os.path.join(tmp, "out2"), job_id="j2", rules=rules,
                               report_dir=os.path.join(tmp, "report"))
    got = {r.rule_id: (r.fail_count, r.total_count) for r in res.rule_results.collect()}
    assert got == {1: (1, 8), 2: (3, 8), 3: (0, 8)}
    html = spark.read.text(os.path.join(tmp, "report")).first().value
    assert "DQ ID = 5</b>, with failures." in html


def test_ledger_current_keeps_fields_not_updated(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    ev = spark.createDataFrame(
        [(1, "j", "desc", 10, t0, None, "STARTED"), (2, "j", None, 12, None, t1, "COMPLETED")],
        "seq bigint, job_id string, d string, total bigint, st timestamp, en timestamp, status string",
    )
    r = ledger_current(ev).first()
    assert (r.d, r.total, r.st, r.en, r.status) == ("desc", 12, t0, t1, "COMPLETED")


def test_routing(spark):
    df = spark.createDataFrame([("acme_balanceSheet_1.json",), ("x_INVOICES.json",), ("other.json",),
                                ("balancesheet_invoices.json",)], "name string")
    got = [r.route for r in with_route(df, "name").collect()]
    assert got == ["BalanceSheet", "Invoices", "other.json", "BalanceSheet"]
    counts = {r.route: (r.rows, r.job_name) for r in route_counts(df, "name", stamp="20240101000000").collect()}
    assert counts["BalanceSheet"] == (2, "BalanceSheet_20240101000000")
    tgt = {r.route: r.target_table for r in route_target(with_route(df, "name"), "route",
                                                           {"BalanceSheet": "balance_sheet"}).collect()}
    assert tgt["BalanceSheet"] == "balance_sheet" and tgt["Invoices"] is None


def test_write_report(spark, tmp):
    rep = spark.createDataFrame([(1, "<html>a</html>"), (2, "<html>b</html>")], "dq_id int, html string")
    write_report(rep, os.path.join(tmp, "rep"))
    assert os.path.isdir(os.path.join(tmp, "rep", "dq_id=1"))
    assert spark.read.text(os.path.join(tmp, "rep")).count() == 2


def test_stream_ingest_replay_adds_nothing(spark, tmp):
    src = os.path.join(tmp, "arrivals")
    _lines(os.path.join(src, "f1.json"), [json.dumps({"id": i, "v": None if i % 3 == 0 else i}) for i in range(9)])
    out, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ckpt")
    schema = "id int, v int"
    stream_ingest(stream_json(spark, src, schema), ["v"], out, ckpt).awaitTermination()
    assert bad_rows(spark, out).count() == 3 and good_rows(spark, out).count() == 6
    # same checkpoint: nothing new, nothing doubled
    stream_ingest(stream_json(spark, src, schema), ["v"], out, ckpt).awaitTermination()
    assert bad_rows(spark, out).count() == 3
    # a new file is processed once, in its own batch
    _lines(os.path.join(src, "f2.json"), [json.dumps({"id": 100, "v": None})])
    stream_ingest(stream_json(spark, src, schema), ["v"], out, ckpt).awaitTermination()
    assert bad_rows(spark, out).count() == 4


def test_uniqueness_across_stream_batches(spark, tmp):
    from flatgate.operators.rules import UNIQUE, Rule, run_rules
    from flatgate.plans.quality_report import ingested_rows

    src, out, ckpt = os.path.join(tmp, "arr"), os.path.join(tmp, "o"), os.path.join(tmp, "c")
    schema = "id int, v int"
    _lines(os.path.join(src, "a.json"), [json.dumps({"id": i, "v": i}) for i in range(5)])
    stream_ingest(stream_json(spark, src, schema), ["v"], out, ckpt).awaitTermination()
    _lines(os.path.join(src, "b.json"), [json.dumps({"id": 4, "v": 40}), json.dumps({"id": 5, "v": 50})])
    stream_ingest(stream_json(spark, src, schema), ["v"], out, ckpt).awaitTermination()
    rule = [Rule(1, "id", UNIQUE, columns=("id",))]
    batches = sorted(f.split("=")[1] for f in os.listdir(os.path.join(out, "rows")) if f.startswith("job_id="))
    per_batch = [run_rules(ingested_rows(spark, out, b), rule).first().fail_count for b in batches]
    assert per_batch == [0, 0]
    assert run_rules(ingested_rows(spark, out), rule).first().fail_count == 1  # id 4 in both batches


def test_job_entry(spark, tmp, capsys):
    from flatgate.__main__ import main

    src = os.path.join(tmp, "jsrc")
    _lines(os.path.join(src, "acme_balanceSheet_1.json"),
           [json.dumps({"accountId": None if i % 5 == 0 else f"a{i}", "lines": [{"amt": i}, {"amt": i + 1}]})
            for i in range(20)])
    rules = os.path.join(tmp, "rules.json")
    with open(rules, "w") as fh:
        json.dump({"dq_id": 101, "rules": [{"rule_id": 1012, "name": "NOT NULL fields", "description": "d",
                                            "rule_type": "not null", "columns": ["accountId"]}]}, fh, indent=2)
    assert main(["--profile", "local", "--source", src, "--rules", rules, "--out", os.path.join(tmp, "jout"),
                 "--job-id", "j1", "--report", os.path.join(tmp, "jrep")]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == {"job_id": "j1", "total": 40, "loaded": 32, "errors": 8, "rules_failed": 1}


def test_flatten_and_leaf_paths_on_a_stream(spark, tmp):
    from flatgate.operators.flatten import flatten, leaf_paths
    from flatgate.streaming.files import stream_to_parquet

    src = os.path.join(tmp, "sarr")
    _lines(os.path.join(src, "a.json"), [json.dumps({"id": i, "s": {"x": i}, "xs": [i, i + 1], "j": '{"k": %d}' % i})
                                        for i in range(4)])
    schema = "id int, s struct<x int>, xs array<int>, j string"
    flat = flatten(stream_json(spark, src, schema), prefix=True)
    out = os.path.join(tmp, "sflat")
    stream_to_parquet(flat, out, os.path.join(tmp, "sck1")).awaitTermination()
    assert spark.read.parquet(out).count() == 8
    leaves = leaf_paths(stream_json(spark, src, schema), "id", "j", depth=1)  # no schema pass on a stream
    out2 = os.path.join(tmp, "sleaf")
    stream_to_parquet(leaves, out2, os.path.join(tmp, "sck2")).awaitTermination()
    assert sorted((r.id, r.path, r.value) for r in spark.read.parquet(out2).collect()) == [
        (i, "k", str(i)) for i in range(4)
    ]


def test_ingest_of_an_empty_arrival(spark, tmp):
    from flatgate.plans.ingest import ingest_frame

    df = spark.createDataFrame([], "id int, s struct<a int>, xs array<int>")
    out = os.path.join(tmp, "empty")
    res = ingest_frame(df, ["id"], out, "j0")
    assert (res.total, res.loaded, res.errors) == (0, 0, 0)
    assert good_rows(spark, out, "j0").count() == 0 and bad_rows(spark, out, "j0").count() == 0
    assert set(good_rows(spark, out, "j0").columns) == {"id", "a", "xs"}
