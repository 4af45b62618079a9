"""Derived inputs: nested documents built from the flat driver tables.

The driver tables are flat; the operators under test work on nested
documents. These builders nest child rows under their parent the way a JSON
producer would, with one guard for scale: a parent never carries more than
about ``max_items`` children in one document. A parent with more children is
written as several documents (``part`` 0, 1, ...). The queries built on them
give the same rows wherever the cuts fall, and no single array, task or
group ever has to hold a hot parent's children at once.

Sibling arrays are deliberately not derived from the tables: exploding two
arrays of one parent emits all pairs within that parent's group. The
operator (``explode_all``) is tested on small inline frames instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatgate.operators.flatten import col_of

DEFAULT_MAX_ITEMS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nest_children(
    children: DataFrame,
    key: str,
    item_cols: list[str],
    name: str,
    sort_cols: list[str] | None = None,
    max_items: int = DEFAULT_MAX_ITEMS,
    part_col: str | None = None,
) -> DataFrame:
    """``(key, part, name array<struct<item_cols>>)`` with about
    ``max_items`` elements per array at most.

    A parent with ``n`` children is split into ``ceil(n / max_items)`` parts
    by a hash of the child row's place in its table, so equal children spread
    as well; ``n`` comes from a map-side combined count and an ordinary join
    (the planner splits a hot parent's side). Arrays are sorted by
    ``sort_cols`` (or the item struct) so the documents are deterministic.

    With ``part_col`` (a column unique within the parent, e.g. a turn
    number) parts are contiguous ranges ``part_col div max_items`` instead,
    so documents of one parent can be put back in order.
    """
    if part_col is not None:
        salted = children.withColumn("part", F.floor(col_of(part_col) / F.lit(max_items)).cast("long"))
        return _group_parts(salted, key, item_cols, name, sort_cols)
    sizes = children.groupBy(col_of(key)).agg(F.ceil(F.count(F.lit(1)) / F.lit(max_items)).cast("long").alias("__fg_parts"))
    placed = children.withColumn("__fg_place", F.monotonically_increasing_id())
    salted = placed.join(sizes, key).withColumn("part", F.pmod(F.xxhash64("__fg_place"), F.col("__fg_parts")))
    return _group_parts(salted.drop("__fg_place", "__fg_parts"), key, item_cols, name, sort_cols)


def _group_parts(salted: DataFrame, key: str, item_cols: list[str], name: str, sort_cols: list[str] | None) -> DataFrame:
    item = F.struct(*[col_of(c) for c in item_cols])
    order = sort_cols or item_cols
    sort_key = F.struct(*[col_of(c) for c in order], item.alias("__fg_item"))
    grouped = salted.groupBy(col_of(key), "part").agg(F.collect_list(F.struct(sort_key.alias("s"), item.alias("i"))).alias("__fg_l"))
    # sort_array and the field of an array of structs need no lambda per element
    return grouped.select(col_of(key), "part", F.sort_array("__fg_l")["i"].alias(name))


def orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, st, cust struct<c_name, seg struct<c_mktsegment,
    c_nationkey>>``; ``st`` is the order status, NULL where it was 'P'."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("st")
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    cust = F.struct(
        F.col("c_name"),
        F.struct(F.col("c_mktsegment"), F.col("c_nationkey")).alias("seg"),
    )
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select("o_orderkey", "st", cust.alias("cust"))


def orders_nested(spark: SparkSession, sf_dir: str, max_items: int = DEFAULT_MAX_ITEMS) -> DataFrame:
    """``orders_with_customer`` and ``items array<struct<l_linenumber,
    l_quantity, l_shipdate>>`` (null array for orders without lineitem)."""
    lineitem = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity", "l_shipdate"
    )
    items = nest_children(lineitem, "o_orderkey", ["l_linenumber", "l_quantity", "l_shipdate"], "items", max_items=max_items)
    return orders_with_customer(spark, sf_dir).join(items, "o_orderkey", "left").select("o_orderkey", "st", "cust", "items")


def conversations_nested(spark: SparkSession, sf_dir: str, max_items: int = 4) -> DataFrame:
    """``conv_id, part, t array<struct<turn, role, text>>`` sorted by turn;
    part ``p`` holds turns ``[p*max_items, (p+1)*max_items)``."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return nest_children(conv, "conv_id", ["turn", "role", "text"], "t", sort_cols=["turn"], max_items=max_items,
                         part_col="turn")


def orders_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with ``st`` = status, NULL where it was 'P', and ``pr`` =
    priority, two spaces where it started with '1'."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "*",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("st"),
        F.when(F.col("o_orderpriority").startswith("1"), F.lit("  ")).otherwise(F.col("o_orderpriority")).alias("pr"),
    )
