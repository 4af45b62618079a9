"""Published commits and ledger snapshots; uniqueness across arrivals."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from flatgate.operators import rules as R
from flatgate.operators.commits import CommitLog
from flatgate.plans.ingest import committed_rows, good_rows, ingest_frame
from flatgate.streaming.files import stream_files, stream_ingest
from flatgate.streaming.unique import repeated_keys, stream_unique_rules, unique_results


def rows(spark, ids):
    return spark.createDataFrame([(i, "x" if i % 3 else None) for i in ids], "id int, v string")


def test_failed_and_unfinished_jobs_stay_invisible(spark, tmp):
    out, log = f"{tmp}/out", CommitLog(spark, f"{tmp}/log")
    log.start("a", "d", None, "src", "q/")
    ingest_frame(rows(spark, range(10)), ["v"], out, "a")
    log.fail("a")
    log.start("c", "d", None, "src", "q/")
    ingest_frame(rows(spark, range(20, 25)), ["v"], out, "c")  # and never finishes
    with pytest.raises(Exception):
        ingest_frame(rows(spark, range(3)).withColumn("v", F.raise_error(F.lit("stop"))), ["v"], out, "d", ledger=log)
    assert log.jobs().count() == 0 and committed_rows(spark, out, log).count() == 0
    ingest_frame(rows(spark, range(10, 20)), ["v"], out, "b", ledger=log)
    assert good_rows(spark, out).count() > 7
    assert sorted(r.id for r in committed_rows(spark, out, log).collect()) == [i for i in range(10, 20) if i % 3]
    assert sorted(r.id for r in committed_rows(spark, out, log, flag=True).collect()) == [12, 15, 18]
    assert [log.state(j) for j in "abcdz"] == ["FAILED", "COMPLETED", "STARTED", "FAILED", None]
    plan = committed_rows(spark, out, log, schema="id int, v string, job_id string, null_check_result string")
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()


def test_a_published_job_is_not_run_again(spark, tmp):
    out, log = f"{tmp}/out", CommitLog(spark, f"{tmp}/log")
    first = ingest_frame(rows(spark, range(10)), ["v"], out, "a", ledger=log)
    again = ingest_frame(rows(spark, range(500)), ["v"], out, "a", ledger=log)
    assert (again.total, again.loaded, again.errors) == (first.total, first.loaded, first.errors) == (10, 6, 4)
    assert committed_rows(spark, out, log).count() == 6 and log.events().count() == 2


def test_snapshots_bound_the_files_and_keep_the_state(spark, tmp):
    log, kept = CommitLog(spark, f"{tmp}/log", every=10), {}
    most = 0
    for i in range(105):
        job = f"job{i % 23}"
        if i % 3 == 0:
            log.start(job, f"run {i}", None, "src", "q/")
            kept[job] = (f"run {i}", "STARTED", None)
        elif i % 3 == 1:
            log.finish(job, i, i, 0, "q/")
            kept[job] = (kept.get(job, (None,))[0], "COMPLETED", i)
        else:
            log.fail(job)
            kept[job] = (*kept.get(job, (None, None, None))[:1], "FAILED", kept.get(job, (None, None, None))[2])
        most = max(most, sum(n.endswith(".json") or n.startswith("state") for n in os.listdir(f"{tmp}/log")))
    assert most <= 2 * 10 + 1 + 2 * 2 + 2
    got = {r.job_id: r for r in log.current().collect()}
    assert set(got) == set(kept)
    for job, (description, status, _) in kept.items():
        assert (got[job].job_description, got[job].status) == (description, status)
    assert max(r.seq for r in got.values()) == 105
    # a reader that opens the log anew sees the same
    assert sorted(map(str, CommitLog(spark, f"{tmp}/log").current().collect())) == sorted(map(str, got.values()))


def test_writers_at_one_time_take_different_versions(spark, tmp):
    def run(k):
        log = CommitLog(spark, f"{tmp}/log", every=1000)
        return [log._append(job_id=f"job{k}", status="STARTED") for _ in range(12)]

    with ThreadPoolExecutor(4) as pool:
        versions = [v for vs in pool.map(run, range(4)) for v in vs]
    assert sorted(versions) == list(range(1, 49))
    assert CommitLog(spark, f"{tmp}/log").events().count() == 48
    assert not [n for n in os.listdir(f"{tmp}/log") if n.startswith(".0") and not n.endswith(".crc")]


def test_renaming_does_not_replace(spark, tmp):
    """What file systems without links use."""
    log = CommitLog(spark, f"{tmp}/a log")
    assert log._publish("one", "first") and not log._publish("one", "second")
    for name, there in (("two", False), ("one", True)):
        assert log._publish("part", name)
        if there:
            with pytest.raises(Py4JJavaError):
                log._rename(log._at("part"), log._at(name))
        else:
            log._rename(log._at("part"), log._at(name))
    assert (log._read("one"), log._read("two")) == ("first", "two")


def test_a_stream_publishes_its_batches(spark, tmp):
    for i in range(3):
        rows(spark, range(10 * i, 10 * i + 10)).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    log = CommitLog(spark, f"{tmp}/log", every=2)
    for _ in range(2):  # the second run finds nothing new
        s = stream_files(spark, f"{tmp}/in", "id int, v string", "parquet", max_files_per_trigger=1)
        stream_ingest(s, ["v"], f"{tmp}/out", f"{tmp}/ckpt", ledger=log).awaitTermination()
    assert committed_rows(spark, f"{tmp}/out", log).count() == 20 and log.jobs().count() == 3


RULES = [R.Rule(1, "id", R.UNIQUE, columns=("id",)), R.Rule(2, "both", R.UNIQUE, columns=("v", "id")), R.Rule(3, "v", R.UNIQUE, columns=("v",), dq_id=4)]


def test_unique_rules_across_batches(spark, tmp):
    arrivals = [[(1, "a"), (2, "b"), (None, None)], [(1, "c"), (3, "d")], [(4, "e"), (5, None), (6, None)], [(1, "a"), (7, "f"), (None, "g")]]
    columns = ["rule_id", "dq_id", "status", "pass_count", "fail_count", "total_count", "pass_count_valid"]
    assert {r.status for r in unique_results(spark, f"{tmp}/u", RULES).collect()} == {"pass"}
    seen = []
    for batch in arrivals:
        seen += batch
        spark.createDataFrame(batch, "id int, v string").coalesce(1).write.mode("append").parquet(f"{tmp}/in")
        s = stream_files(spark, f"{tmp}/in", "id int, v string", "parquet")
        query = stream_unique_rules(s, RULES, f"{tmp}/u", f"{tmp}/ckpt")
        query.awaitTermination()
        want = R.run_rules(spark.createDataFrame(seen, "id int, v string"), RULES).select(columns).collect()
        assert sorted(unique_results(spark, f"{tmp}/u", RULES).select(columns).collect()) == sorted(want)
    files = sorted(os.listdir(f"{tmp}/u"))
    stream_unique_rules(stream_files(spark, f"{tmp}/in", "id int, v string", "parquet"), RULES, f"{tmp}/u", f"{tmp}/ckpt").awaitTermination()
    assert sorted(os.listdir(f"{tmp}/u")) == files
    repeated = {r["__fg_k0"]: r["__fg_n"] for r in repeated_keys(spark, f"{tmp}/u").filter("__fg_gid = 0").collect()}
    assert repeated == {1: 3, None: 2}
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_only_unique_rules_with_known_columns(spark, tmp):
    df = spark.createDataFrame([(1,)], "id int")
    for rule in (R.Rule(1, "n", R.NOT_NULL, columns=("id",)), R.Rule(1, "n", R.UNIQUE, columns=("nope",))):
        with pytest.raises(ValueError):
            stream_unique_rules(df, [rule], f"{tmp}/u", f"{tmp}/c")
