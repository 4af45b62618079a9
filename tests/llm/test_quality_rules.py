import collections

import duckdb
import pytest

from flatgate.llm import quality_rules as Q
from flatgate.llm.oracles import ORACLES
from flatgate.llm.queries import QUERIES
from tests.llm.helpers import EDGE, SF, WORD, canon, frame, words


def brute(text):
    text = text or ""
    w = words(text)
    windows = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_edge_rows(spark):
    got = Q.rule_counts(frame(spark)).collect()
    assert canon((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == canon(
        (d, *brute(t)) for d, t, *_ in EDGE)
    judged = Q.quality_rules(frame(spark)).collect()
    assert len(judged) == len(EDGE)
    assert not any(r.kept for r in judged if r.base_failed)
    assert Q.quality_rules(frame(spark, [])).collect() == []


def test_a_bad_host_takes_its_documents_along(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "spam " * 80
    rows = [(i, good if host == "fine" or i % 10 == 0 else bad, "en", host) for host in ("fine", "foul") for i in range(200)]
    rows += [(900, bad, "en", "lone"), (901, good, "en", "new")]
    got = Q.quality_rules(frame(spark, rows)).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.host].append(r)
    assert all(r.kept for r in by["fine"]) and not any(r.kept for r in by["foul"])
    # a sparse host is drawn to the others and not judged by one document
    assert by["new"][0].kept and 0 < by["new"][0].host_failure_rate < 0.5
    assert 0.1 < by["lone"][0].host_failure_rate < 0.9


@pytest.mark.parametrize("name", ["op6_quality_rules", "op10_url_filters"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    found = con.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert canon(df.select(columns).collect()) == canon(found.fetchall())


def test_plan_has_no_python(spark):
    plan = Q.quality_rules(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan
