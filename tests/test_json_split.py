"""Whole-file JSON documents read by many tasks."""

import contextlib
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flatgate.sources.json import corrupt_rows, read_json_docs
from flatgate.sources.json_split import _ranges, read_json_docs_split, split_json_docs

SCHEMA = "id bigint, s string, a array<struct<k: string, v: bigint>>, o struct<t: string>"


@contextlib.contextmanager
def ranges_of(spark, n_bytes):
    """Files are cut into ranges of so many bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(n_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def put(tmp, name, text):
    with open(f"{tmp}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


def documents(n, seed=0):
    rng = random.Random(seed)
    bits = ['"', "\\", "{", "}", "[", "]", ",", "\n", "é", "日", "a", "},{", '\\"', "😀", "\\u0041"]
    text = lambda m: "".join(rng.choices(bits, k=rng.randrange(m)))
    return [{"id": i, "s": text(12), "a": [{"k": text(5), "v": j} for j in range(rng.randrange(4))], "o": {"t": text(30)}} for i in range(n)]


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("n_bytes", [7, 64, 1000, 1 << 20])
def test_rows_are_those_of_the_whole_file_reader(spark, tmp, n_bytes):
    put(tmp, "plain.json", json.dumps(documents(40)))
    put(tmp, "indented.json", "\n " + json.dumps(documents(12, 1), indent=2, ensure_ascii=False) + "\n\n")
    put(tmp, "one.json", json.dumps(documents(1, 2)[0], indent=1))
    put(tmp, "empty.json", "[ ]")
    put(tmp, "nothing.json", "")
    want = read_json_docs(spark, f"{tmp}/[pio]*.json", schema=SCHEMA, with_source=True)
    with ranges_of(spark, n_bytes):
        got = read_json_docs_split(spark, tmp, SCHEMA, with_source=True)
        assert rows(got) == rows(want) and want.count() == 53


def test_one_file_is_read_by_many_tasks(spark, tmp):
    put(tmp, "big.json", json.dumps(documents(3000)))
    with ranges_of(spark, 40_000):
        text = spark.read.option("lineSep", "}").text(tmp)
        used = text.groupBy(F.spark_partition_id()).count().count()
        assert used >= 4
        assert rows(read_json_docs_split(spark, tmp, SCHEMA)) == rows(read_json_docs(spark, tmp, schema=SCHEMA))


def test_a_document_longer_than_many_ranges(spark, tmp):
    docs = [{"id": 1, "s": "x}" * 500}, {"id": 2, "a": [{"k": "{", "v": i} for i in range(200)]}, {"id": 3}]
    put(tmp, "long.json", json.dumps(docs))
    with ranges_of(spark, 50):
        got = read_json_docs_split(spark, tmp, SCHEMA)
        assert rows(got) == rows(read_json_docs(spark, tmp, schema=SCHEMA)) and got.count() == 3


@pytest.mark.parametrize("n_bytes", [9, 1 << 20])
def test_broken_documents_are_rows_of_their_own(spark, tmp, n_bytes):
    put(tmp, "broken.json", '[{"id": 1}, {"id": x}, 7, {"id": 2},]')
    put(tmp, "cut.json", '[{"id": 3}, {"id": 4')
    with ranges_of(spark, n_bytes):
        df = read_json_docs_split(spark, tmp, "id bigint, _corrupt_record string", keep_corrupt=True)
        assert sorted(r.id for r in df.filter("id is not null").collect()) == [1, 2, 3]
        assert sorted(r["_corrupt_record_2"].strip() for r in corrupt_rows(df).collect()) == ["7", '{"id": 4', '{"id": x}']
        texts = sorted(r.text.strip() for r in split_json_docs(spark, f"{tmp}/cut.json").collect())
        assert texts == ['{"id": 3}', '{"id": 4']


def test_ranges_of_a_batch_are_kept_apart():
    batch = pa.RecordBatch.from_pydict({
        "value": [b"a", b"b", b"", b"c", b"d"], "file": ["x", "x", "x", "y", "y"], "start": [0, 0, 7, 7, 7], "size": [9, 9, 9, 5, 5]})
    assert list(_ranges([batch.slice(0, 0), batch])) == [(("x", 0), 9, b"a}b}"), (("x", 7), 9, b"}"), (("y", 7), 5, b"c}d}")]
