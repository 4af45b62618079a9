"""Filter interaction audit: what each filter of a cleaning chain removes, in
every order of the chain, and its Shapley value.

A document is a set of failed filters. One aggregation counts the documents
of each set per part; from it come the removals of all coalitions of filters
(32 for five filters). What a filter removes at a step is the difference of
two coalitions. The Shapley values are the solution of a least-squares
problem: the additive game nearest to the removals of all coalitions under
the Shapley kernel's weights, with the values' sum held to the removals of
the whole chain. Its normal equations are solved in rationals, so the values
are exact.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatgate.llm.common import WORD_CUT
from flatgate.llm.exact_dedup import ContentHash, content_groups, hash128

RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")
MOST_FILTERS = 7  # 7! orders of 7 steps are 35,280 rows a part


def kernel_weight(players: int, size: int) -> Fraction:
    """Weight of a coalition of ``size`` players, neither none nor all."""
    return Fraction(players - 1, math.comb(players, size) * size * (players - size))


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Solution of a regular system by elimination in rationals."""
    rows = [[*m, r] for m, r in zip(matrix, right, strict=True)]
    for i in range(len(rows)):
        pivot = next(r for r in range(i, len(rows)) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(len(rows)):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i], strict=True)]
    return [row[-1] for row in rows]


def shapley_values(worth: Sequence[int], players: int) -> list[Fraction]:
    """Shapley values of the game ``worth`` (by coalition, as a bit mask;
    ``worth[0]`` is 0): the values that minimise the kernel-weighted squares
    of ``worth[S] - sum of S's values`` and add up to the worth of all."""
    if players == 1:
        return [Fraction(worth[1])]
    # gradient and constraint: one row per player, one for the multiplier
    matrix = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
    right = [Fraction(0)] * (players + 1)
    for coalition in range(1, (1 << players) - 1):
        inside = [i for i in range(players) if coalition >> i & 1]
        weight = kernel_weight(players, len(inside))
        for i in inside:
            right[i] += weight * worth[coalition]
            for j in inside:
                matrix[i][j] += weight
    for i in range(players):
        matrix[i][players] = matrix[players][i] = Fraction(1)
    right[players] = Fraction(worth[-1])
    return solve(matrix, right)[:players]


def removals(counts: dict[int, int], players: int) -> list[int]:
    """Documents that each coalition of filters removes, from the number of
    documents by set of failed filters."""
    return [sum(n for failed, n in counts.items() if failed & coalition) for coalition in range(1 << players)]


def audit_rows(part: str, letters: str, all_docs: dict[int, int], good: dict[int, int], toxic: dict[int, int]) -> list[tuple]:
    """Result rows of one part: every order of the filters, every step."""
    n = len(letters)
    total, everything = sum(all_docs.values()), (1 << n) - 1
    worth, good_worth, toxic_worth = (removals(c, n) for c in (all_docs, good, toxic))
    orders = math.factorial(n)
    summed = [int(orders * v) for v in shapley_values(worth, n)]
    out = []
    for order in itertools.permutations(range(n)):
        name, before = "".join(letters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = worth[after] - worth[before]
            out.append((part, name, step, total - worth[after], removed, worth[1 << i] - removed,
                        worth[everything] - worth[everything & ~(1 << i)], good_worth[after] - good_worth[before],
                        toxic_worth[after] - toxic_worth[before], summed[i]))
            before = after
    return out


def audit(flagged: DataFrame, letters: str, part: str = "part", good: str = "good", toxic: str = "toxic") -> DataFrame:
    """``RESULT`` rows per part of ``flagged``: boolean columns named by
    ``letters`` say which filters a row fails, ``good`` and ``toxic`` how it
    is labelled. Null flags count as false, a null part as the empty one.

    Rows are combined map-side to at most 2^n counts a part, so a part that
    holds a third of all rows costs its neighbours nothing."""
    if not 1 <= len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"letters must name 1 to {MOST_FILTERS} filters, each once: {letters!r}")
    failed = F.lit(0)
    for i, letter in enumerate(letters):
        failed = failed + F.when(F.col(letter), F.lit(1 << i)).otherwise(F.lit(0))
    counts = flagged.select(F.coalesce(F.col(part), F.lit("")).alias("part"), failed.alias("failed"),
                            F.col(good).alias("good"), F.col(toxic).alias("toxic"))
    counts = counts.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    kinds = [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
             *[(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]]

    def one_part(table: pa.Table) -> pa.Table:  # at most 2^n rows
        by_set = {c: dict(zip(table["failed"].to_pylist(), table[c].to_pylist(), strict=True)) for c in ("n", "good", "toxic")}
        rows = audit_rows(table["part"][0].as_py(), letters, by_set["n"], by_set["good"], by_set["toxic"])
        return pa.table([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[k for k, _ in kinds])

    return counts.groupBy("part").applyInArrow(one_part, RESULT)


def text_failures(text: str) -> dict[str, Column]:
    """Failure conditions of a text by itself, over a column of its words
    ``words`` beside it: few words (A), few distinct ones (B), many capitals
    (C), any of six symbols (D)."""
    words, t = F.size("words").cast("long"), F.col(text)
    return {
        "A": words < 200,
        "B": 100 * F.size(F.array_distinct("words")).cast("long") < 50 * words,
        "C": 100 * F.regexp_count(t, F.lit("[A-Z]")).cast("long") > 3 * F.length(t).cast("long"),
        "D": t.rlike(r"[#$%&*|]"),
    }


def flagged_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      part_col: str = "lang", content_hash: ContentHash = hash128) -> DataFrame:
    """``(part, A, B, C, D, E, good, toxic)`` of every row of ``docs``: the
    text's own failures, E for a text that a smaller id has too, and the
    labels of the id.

    Null texts are empty, null parts the empty part; a null id is larger
    than all others and has no label; an id labelled twice is good or toxic
    if any label says so; rows that repeat the smallest id all pass E."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    rows = rows.withColumn("words", F.filter(F.split("t", WORD_CUT), lambda w: w != ""))
    rows = rows.select("doc_id", "part", *[c.alias(k) for k, c in text_failures("t").items()], "t")
    keyed = content_groups(rows, "t", content_hash)
    least = keyed.groupBy(F.col("content").alias("l_content"), F.col("variant").alias("l_variant")).agg(F.min("doc_id").alias("least"))
    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("l_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    joined = keyed.join(least, (F.col("content") == F.col("l_content")) & (F.col("variant") == F.col("l_variant")))
    joined = joined.join(known, F.col("doc_id") == F.col("l_id"), "left")
    repeated = F.col("least").isNotNull() & (F.col("doc_id").isNull() | (F.col("least") < F.col("doc_id")))
    return joined.select("part", "A", "B", "C", "D", repeated.alias("E"),
                         *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")])


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang", content_hash: ContentHash = hash128) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley)``: five filters over every row of
    ``docs``, 600 rows per value of ``part_col``; see ``flagged_documents``
    for what nulls and repeated rows mean. ``shapley`` is the filter's value
    times 120: its removals summed over all orders. Other columns are
    ignored; an empty table gives an empty result."""
    return audit(flagged_documents(docs, labels, id_col, text_col, part_col, content_hash), "ABCDE")
