import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from flatgate.llm import conversation_trie as T
from tests.llm.helpers import SF, words

SCHEMA = ("conv_id long, turn long, role string, text string, depth long, k1 string, part string, i long, q1 string, words string, "
          "ends string, band string, node string, root string")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", "y", 9, "z", "w", "e", "b", "n", "r") for r in rows], SCHEMA)


def rem(a, b):
    return a - b * int(a / b)  # as division towards zero leaves it


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        base = [] if c is None else own.get(c - rem(c, 20), [])
        rebuilt[c] = tuple(base[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    least = {p: min((c for c in m if c is not None), default=None) for p, m in members.items()}
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own_saved = (len(members[p]) - 1) * len(words(p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = own_saved + sum(saved[k] for k in kids[p])
    return sorted(((least[p], len(p), least[p[:-1]] if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(c for c in ends[p] if c is not None)).encode()).hexdigest())
                   for p in members), key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


EDGE = [
    (0, 0, "system", "be kind"), (0, 1, "user", "hello there"), (0, 2, "assistant", "hi"), (0, 3, "user", "tell me more of it"),
    (1, 0, "system", "be kind"), (1, 1, "user", "hello there"), (2, 0, "x", "a"), (3, None, "user", "first of all"), (3, 0, None, None),
    (3, 0, None, "tie two"), (3, 0, "b", "tie two"), (4, 5, "user", ""), (4, 5, "user", ""), (5, 1, "u", " \t "), (25, 0, "u", "no base"),
    (45, 0, "u", "no base"), (45, 1, "u", "longer"), (-3, 0, "n", "below zero"), (-25, 1, "n", "below"), (-20, 0, "m", "minus twenty"),
    (None, 1, "null", "id of its own"), (None, None, "null", "id"), (10**17, 0, "far", "id"),
    (41, 0, "long", " ".join(f"w{i % 97}" for i in range(50_000))), (6, 0, "ab", "c"), (7, 0, "a", "bc"),
]


def test_edge_rows(spark):
    assert got(T.prefix_trie(frame(spark, EDGE))) == brute(EDGE)
    assert T.prefix_trie(frame(spark, [])).collect() == []
    only = [(None, 0, "a", "b"), (None, 1, "a", "c d")]
    assert got(T.prefix_trie(frame(spark, only))) == brute(only)


def crowd(seed, convs=120, depth=9, letters=2):
    r = random.Random(seed)
    return [(c, i, r.choice(["user", "assistant"][:1 + i % 2]), " ".join(r.choice("ab"[:letters]) for _ in range(1 + i % 2)))
            for c in range(convs) for i in range(r.randrange(1, depth))]


@pytest.mark.parametrize("sizes", [
    {"least_share": 5, "band": 2, "limit": 3}, {"least_share": 0, "most_top": 40, "band": 1, "limit": 1},
    {"least_share": 10**9, "band": 3, "limit": 2}, {"least_share": 20, "band": 1000, "limit": 4}])
def test_shards_bands_and_spills(spark, sizes):
    rows = crowd(7)
    assert got(T.prefix_trie(frame(spark, rows), **sizes)) == brute(rows)


def test_conversations_over_several_ranges(spark):
    r = random.Random(3)
    long = [(r.choice(["u", "v"]), f"turn {i} of many") for i in range(900)]
    rows = [(c, i, *t) for c, n in ((40, 900), (43, 900), (44, 700), (47, 650)) for i, t in enumerate(long[:n])] + crowd(5, convs=30)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = frame(spark, rows).repartition(4)
        turns = T.hashed_turns(df)
        assert turns.groupBy("conv_id").agg({"part": "min"}).count() == 34
        assert len({x.part for x in turns.filter("conv_id = 43").select("part").distinct().collect()}) > 1
        assert sorted(x.i for x in turns.filter("conv_id = 43").collect()) == list(range(900))
        assert got(T.prefix_trie(df, band=100, least_share=3, limit=16)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_conversations_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert got(T.prefix_trie(df)) == brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


def test_queue_keeps_order_through_spills():
    r = random.Random(1)
    messages = [((r.randrange(50), r.randrange(3), 0), (1, r.randrange(9), 2)) for _ in range(2000)]
    queue, sums = T.SpillingQueue(limit=7), defaultdict(lambda: (0, 0, 0))
    for order, values in messages:
        queue.push(order, values)
        sums[order] = tuple(a + b for a, b in zip(sums[order], values, strict=True))
    assert len(queue.runs) > 100
    for order in sorted(sums):
        assert queue.take(order) == sums[order]
    assert not queue and queue.take((99, 0, 0)) == (0, 0, 0)
    queue.push((1, 0, 0), (1, 1, 1))
    with pytest.raises(ValueError, match="met no node"):
        queue.take((2, 0, 0))


def test_end_ids_in_several_blocks(spark):
    rows = [(20 * c, 0, "u", "all the same") for c in range(3000)]
    assert got(T.prefix_trie(frame(spark, rows))) == brute(rows)


def test_tasks_spill_where_spark_spills(spark, monkeypatch, tmp_path):
    def folder(batches):
        for batch in batches:
            yield batch.from_pydict({"folder": [T.spill_folder()]})

    named = {r.folder for r in spark.range(2, numPartitions=2).mapInArrow(folder, "folder string").collect()}
    assert named and None not in named
    monkeypatch.setenv("SPARK_LOCAL_DIRS", f"/not/there,{tmp_path}")
    assert T.spill_folder() == str(tmp_path)
    monkeypatch.delenv("SPARK_LOCAL_DIRS")
    assert T.spill_folder() is None
