"""Nested inputs derived from flat tables: hot parents are split into
bounded documents without losing or duplicating a child."""

from pyspark.sql import functions as F

from flatgate.operators.flatten import flatten
from flatgate.plans.fixtures import nest_children


def test_hot_parent_is_split_into_bounded_documents(spark):
    # one parent holds a third of all rows
    ch = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    docs = nest_children(ch, "k", ["v"], "items", max_items=1000)
    hot = docs.filter("k = 7")
    assert hot.count() >= 10
    assert docs.agg(F.max(F.size("items"))).first()[0] <= 1200
    flat = flatten(docs.drop("part"))
    assert flat.count() == 30000
    assert flat.agg(F.countDistinct("v")).first()[0] == 30000


def test_equal_items_of_a_hot_parent_spread(spark):
    ch = spark.range(20000).select(F.lit(7).alias("k"), (F.col("id") % 3).alias("v"))
    docs = nest_children(ch, "k", ["v"], "items", max_items=100)
    assert docs.agg(F.max(F.size("items"))).first()[0] <= 160
    assert docs.agg(F.sum(F.size("items"))).first()[0] == 20000


def test_queries_do_not_depend_on_the_cut(spark):
    from flatgate.plans.queries import q_leaf_paths_nested

    sf = "/root/testdata/sf0.001"
    a, b = (sorted(map(tuple, q_leaf_paths_nested(spark, sf, n).collect()), key=repr) for n in (2, 10_000))
    assert a == b and len(a) > 1000


def test_contiguous_parts_keep_order(spark):
    ch = spark.range(50).select(F.lit(1).alias("k"), F.col("id").alias("turn"), F.col("id").cast("string").alias("r"))
    docs = nest_children(ch, "k", ["turn", "r"], "t", sort_cols=["turn"], max_items=16, part_col="turn")
    got = [(r.part, [x.turn for x in r.t]) for r in docs.orderBy("part").collect()]
    assert [p for p, _ in got] == [0, 1, 2, 3]
    assert sum((turns for _, turns in got), []) == list(range(50))
