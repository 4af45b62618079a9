"""Row predicates (P1-P6), rule engine (D1-D10) and the sample report's
golden counts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from flatgate.functions.predicates import is_blank, not_null_failure, parse_columns
from flatgate.operators import rules as R
from flatgate.operators.quality import null_flag, run_metrics, split_good_bad
from flatgate.operators.report import report_html
from flatgate.sources.json import read_json_lines
from flatgate.sources.rules import load_rules, read_rules


def test_blanks(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("\t",), ("x",)], "s string")
    types = {"s": df.schema["s"].dataType}
    assert df.filter(not_null_failure(["s"], types)).count() == 3  # TRIM strips spaces only
    assert df.filter(is_blank("s")).count() == 4
    assert null_flag(df, ["s"]).filter("null_check_result").count() == 1


def test_not_null_on_non_string_columns(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (double('NaN'), true, date'2024-01-01', array(1)), "
        "(CAST(NULL AS DOUBLE), CAST(NULL AS BOOLEAN), CAST(NULL AS DATE), CAST(NULL AS ARRAY<INT>)), "
        "(1.0D, false, date'2024-01-02', array()) AS t(d, b, dt, a)"
    )
    types = {f.name: f.dataType for f in df.schema.fields}
    assert df.filter(not_null_failure(["d"], types)).count() == 1  # NaN passes
    assert df.filter(not_null_failure(["b"], types)).count() == 1
    assert df.filter(not_null_failure(["dt"], types)).count() == 1
    assert df.filter(not_null_failure(["a"], types)).count() == 2  # null and empty


def test_duplicate_keys_with_nulls_and_cnt_column(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "cnt int")
    res = R.rule_unique(df, ["cnt"]).first()
    assert (res.fail_count, res.total_count, res.status) == (2, 5, "fail")


def test_parse_columns():
    assert parse_columns(" a, b ,c") == ["a", "b", "c"]
    assert parse_columns(["a"]) == ["a"]
    with pytest.raises(ValueError):
        parse_columns(" , ")


def test_split_good_bad_partition_input(spark):
    df = spark.range(100).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("v"))
    good, bad = split_good_bad(df, "v")
    assert "null_check_result" in bad.columns and "null_check_result" not in good.columns
    assert good.count() + bad.count() == 100
    m = run_metrics(df, "v").first()
    assert (m.total_record_count, m.load_record_count, m.error_record_count) == (100, 85, 15)


def test_query_rule_refuses_ddl(spark):
    df = spark.range(3)
    with pytest.raises(Exception):
        R.query_rule_count(df, "DROP TABLE IF EXISTS x")
    assert R.query_rule_count(df, "WITH t AS (SELECT * FROM temp WHERE id > 0) SELECT * FROM t") == 2


def test_query_rule_pass_count_can_go_negative(spark):
    df = spark.range(2)
    res = R.rule_query(df, "SELECT * FROM temp a JOIN temp b ON true JOIN temp c ON true").first()
    assert (res.fail_count, res.pass_count, res.pass_count_valid) == (8, -6, False)


def _write_recipes(path):
    """1,042 recipes in 3 files; 3 duplicated names; 327 rows fail the
    not-null rule on (name, cookTime, prepTime)."""
    os.makedirs(path, exist_ok=True)
    rows = []
    for i in range(1042):
        name = f"recipe {i}" if i < 1039 else f"recipe {i - 1039}"
        cook, prep = f"PT{i % 50}M", f"PT{i % 7}M"
        if 100 <= i < 427:  # 327 failing rows, spread over the kinds of failure
            k = i % 4
            if k == 0:
                cook = ""
            elif k == 1:
                prep = None
            elif k == 2:
                cook = "   "
            else:
                prep = ""
        rows.append({"name": name, "cookTime": cook, "prepTime": prep})
    for f in range(3):
        with open(os.path.join(path, f"recipes-{f:03d}.json"), "w") as fh:
            for r in rows[f::3]:
                fh.write(json.dumps(r) + "\n")


# The sample report's rule names and query.
SAMPLE_QUERY = (
    "WITH file_names AS (SELECT 'recipes-000.json' AS file_name UNION SELECT 'recipes-001.json' AS file_name "
    "UNION SELECT 'recipes-002.json' AS file_name)\n"
    "SELECT f.file_name FROM file_names f\n"
    "LEFT JOIN (SELECT DISTINCT get(reverse(split(source_file, '/')), 0) as file_name FROM temp) t\n"
    "ON t.file_name = f.file_name\nWHERE t.file_name IS NULL"
)


def test_sample_report_golden_counts(spark, tmp):
    data = os.path.join(tmp, "recipes")
    _write_recipes(data)
    rules_path = os.path.join(tmp, "rules.json")
    with open(rules_path, "w") as fh:
        json.dump(
            {
                "dq_id": 101,
                "rules": [
                    {"rule_id": 1011, "name": "Primary / Natural Keys", "description": "no duplicates",
                     "rule_type": "unique", "columns": ["name"]},
                    {"rule_id": 1012, "name": "NOT NULL fields", "description": "Field should have valid value",
                     "rule_type": "not null", "columns": ["name", "cookTime", "prepTime"]},
                    {"rule_id": 1013, "name": "File names check", "description": "all input files read",
                     "rule_type": "query", "query": SAMPLE_QUERY},
                ],
            },
            fh,
            indent=2,
        )
    df = read_json_lines(spark, data, schema="name string, cookTime string, prepTime string", with_source=True)
    rules = load_rules(spark, rules_path)
    res = {r.rule_id: (r.pass_count, r.fail_count, r.total_count) for r in R.run_rules(df, rules).collect()}
    assert res == {1011: (1039, 3, 1042), 1012: (715, 327, 1042), 1013: (1042, 0, 1042)}
    results = R.run_rules(df, rules)
    assert R.verdict(results).first().passed is False
    assert [r.rule_id for r in R.failed(results).collect()] == [1011, 1012]
    html = report_html(results).first().html
    assert ", with failures. " in html
    assert html.index("Failed DQ details") < html.index("Succeeded DQ details")
    assert html.count("<tr>") == 3 and "<td>1039</td>" in html


def test_report_escapes_and_omits_empty_tables(spark):
    df = spark.createDataFrame([("<b>",)], "name string")
    results = R.run_rules(df, [R.Rule(1, "<script>", R.NOT_NULL, columns=("name",), dq_id=7)])
    html = report_html(results).first().html
    assert "&lt;script&gt;" in html and "<script>" not in html
    assert "Failed DQ details" not in html and "Succeeded DQ details" in html
    assert "DQ ID = 7</b>. Check" in html


def test_rules_file_shapes(spark, tmp):
    nested = os.path.join(tmp, "nested.json")
    with open(nested, "w") as fh:
        json.dump({"dq_id": 101, "rules": [{"rule_id": 1012, "name": "NOT NULL fields", "description": "d",
                                            "rule_type": "not null", "columns": ["accountId"]}]}, fh, indent=2)
    flat = os.path.join(tmp, "flat.json")
    with open(flat, "w") as fh:
        fh.write(json.dumps({"columns": "a, b", "dq_file_path": "/data/quarantine/"}))
    r1 = load_rules(spark, nested)
    assert r1 == [R.Rule(1012, "NOT NULL fields", R.NOT_NULL, "d", ("accountId",), None, 101)]
    mixed = os.path.join(tmp, "mixed.json")
    with open(mixed, "w") as fh:
        json.dump({"dq_id": 3, "rules": [{"rule_id": 1, "name": "n", "rule_type": " Not Null ", "columns": "a , b"}]}, fh)
    assert load_rules(spark, mixed) == [R.Rule(1, "n", R.NOT_NULL, None, ("a", "b"), None, 3)]
    listed = os.path.join(tmp, "listed.json")
    with open(listed, "w") as fh:
        json.dump({"dq_id": 3, "rules": [{"rule_id": 1, "rule_type": "unique", "columns": ["col0 ", " col1", "c2"]}]}, fh)
    assert list(read_rules(spark, listed).first().columns) == ["col0", "col1", "c2"]
    assert list(read_rules(spark, mixed).first().columns) == ["a", "b"]
    t2 = read_rules(spark, flat).first()
    assert (t2.rule_type, list(t2.columns), t2.dq_file_path) == ("not null", ["a", "b"], "/data/quarantine/")


def test_unique_rules_of_several_key_lists(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (2, "b", "y")], "k int, g string, v string")
    rules = [
        R.Rule(1, "k", R.UNIQUE, columns=("k",)),
        R.Rule(2, "g", R.UNIQUE, columns=("g",)),
        R.Rule(3, "kg", R.UNIQUE, columns=("k", "g")),
        R.Rule(4, "v", R.NOT_NULL, columns=("v",)),
        R.Rule(5, "k again", R.UNIQUE, columns=("k",)),
    ]
    res = {r.rule_id: r.fail_count for r in R.run_rules(df, rules).collect()}
    assert res == {1: 1, 2: 1, 3: 0, 4: 1, 5: 1}


def test_query_rule_with_input_file_name(spark, tmp):
    data = os.path.join(tmp, "recipes")
    _write_recipes(data)
    df = read_json_lines(spark, data, schema="name string, cookTime string, prepTime string")
    sql = SAMPLE_QUERY.replace("get(reverse(split(source_file, '/')), 0)", "reverse(split(input_file_name(), '/'))[0]")
    assert R.query_rule_count(df, sql) == 0
    assert R.query_rule_count(df, sql.replace("recipes-002.json", "recipes-009.json")) == 1
