import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from flatgate.llm import exact_dedup as X
from tests.llm.helpers import EDGE, SF, frame


def one_spaced(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    """Rows without the choice among rows that repeat id and text; and the
    number of rows that stay."""
    groups = collections.defaultdict(list)
    for d, t, *_ in rows:
        groups[one_spaced(t)].append(d)
    least = {t: min((d is None, d or 0) for d in ids) for t, ids in groups.items()}
    out = []
    for d, t, *_ in rows:
        n = one_spaced(t)
        keep = None if least[n][0] else least[n][1]
        out.append((d, keep, len(groups[n]), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr), len(groups)


def check(got, rows):
    want, groups = expected(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) == groups
    assert all(r.doc_id == r.keep_id for r in kept)


MORE = [
    *EDGE,
    (40, "the same\t\ttext", "en", "a"), (41, "the same text", "en", "a"), (30, "the same \r\n text", "de", "b"),
    (42, " the same text", "en", "a"), (43, "The same text", "en", "a"),
    *[(100 + i % 7, "copied by many", "en", "hot") for i in range(300)],
]


def test_edge_rows(spark):
    check(X.exact_duplicates(frame(spark, MORE)).collect(), MORE)


@pytest.mark.parametrize("weak", [lambda t: F.lit(b"x"), lambda t: F.encode(F.length(t).cast("string"), "utf-8"),
                                  lambda t: F.substring(F.unhex(F.sha2(t, 256)), 1, 1)])
def test_texts_of_one_hash_stay_apart(spark, weak):
    check(X.exact_duplicates(frame(spark, MORE), content_hash=weak).collect(), MORE)


def test_empty_table_and_kept_ids(spark):
    assert X.exact_duplicates(frame(spark, [])).collect() == []
    assert sorted(r.doc_id for r in X.keep_smallest(frame(spark, [(2, "a  b", "", ""), (1, "a b", "", ""), (3, "c", "", "")])).collect()) == [1, 3]


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = X.exact_duplicates(docs).collect()
    check(got, [(r.doc_id, r.text) for r in docs.collect()])
    assert any(not r.kept for r in got)


def test_rows_that_carry_texts_are_shuffled_once_and_combined_first(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", X.one_spaced(F.col("text")).alias("t")).withColumn("content", X.hash128(F.col("t")))
    plan = rows.select("content", "t").distinct().groupBy("content").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(keys=[content") == 4 and "SortAggregate" not in plan
