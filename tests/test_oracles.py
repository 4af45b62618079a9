"""The correctness gate: every registered query against its DuckDB
oracle at sf0.01 (row count, column names and order-insensitive values);
queries without an oracle must at least run."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from flatgate.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["total_record_count", "load_record_count", "error_record_count"]
    assert df.count() == 1


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())
