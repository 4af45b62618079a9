"""Why a row is in quarantine: the rules that each row fails.

The rule engine counts failures; here they are given back to their rows, by
a stable identity (the Parquet file a row was written to and its place
there). Not-null rules and conditions are decided inside the row, all in one
scan. A unique rule's repeated keys come from a count combined map-side, so a
key that a third of the rows share is one row of the set that is joined back;
what is joined are identities and keys, not whole rows, and no key is sorted
against itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatgate.functions.predicates import not_null_failure_sql
from flatgate.operators.flatten import col_of, quote
from flatgate.operators.rules import NO_ACCESS, NOT_NULL, QUERY, UNIQUE, Access, Rule, fused_conditions
from flatgate.operators.sql_guard import DATA

FILE, PLACE = "row_file", "row_place"
REASONS = "failed_rules"


def with_identity(df: DataFrame) -> DataFrame:
    """Rows of a Parquet table with their file's path and their place in it
    (``row_file``, ``row_place``)."""
    taken = {c.lower() for c in df.columns} & {FILE, PLACE}
    if taken:
        raise ValueError(f"the data has columns {sorted(taken)}: they would hide the rows' identity")
    return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(PLACE))


def row_reasons(df: DataFrame, rules: Sequence[Rule], identity: Sequence[str] = (FILE, PLACE), access: Access = NO_ACCESS) -> DataFrame:
    """``identity`` columns and ``failed_rules``: per row of ``df`` that fails
    any rule, the places (from 0) of those rules in ``rules``, ascending.

    A row fails a unique rule if another row has its key (null keys are
    alike). A query rule counts if it is a condition on rows (see
    ``rules.fused_conditions``); other SQL returns rows that need not be rows
    of the data, and is refused."""
    conditions = fused_conditions(df, rules, access)
    foreign = [r.rule_id for i, r in enumerate(rules) if r.rule_type == QUERY and i not in conditions]
    if foreign:
        raise ValueError(f"rules {foreign}: their SQL is not a condition on rows of the data")
    types = {f.name: f.dataType for f in df.schema.fields}
    own = []
    for i, r in enumerate(rules):
        if r.rule_type == NOT_NULL:
            own.append(F.when(F.expr(not_null_failure_sql(r.columns, types)), F.lit(i)))
        elif i in conditions:
            own.append(F.lit(i) if conditions[i] is None else F.when(conditions[i], F.lit(i)))
    ids = [col_of(c).alias(f"__fg_id{n}") for n, c in enumerate(identity)]
    names = [f"__fg_id{n}" for n in range(len(identity))]
    found = df.alias(DATA).select(*ids, F.explode(F.filter(F.array(*own), lambda x: x.isNotNull())).alias("__fg_rule")) if own else None
    by_key: dict[tuple[str, ...], list[int]] = {}
    for i, r in enumerate(rules):
        if r.rule_type == UNIQUE:
            by_key.setdefault(tuple(sorted(set(r.columns))), []).append(i)
    for key, places in by_key.items():
        keys = [f"__fg_k{n}" for n in range(len(key))]
        keyed = df.select(*ids, *[col_of(c).alias(k) for c, k in zip(key, keys, strict=True)])
        repeated = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__fg_n")).filter("__fg_n > 1")
        repeated = repeated.select(*[F.col(k).alias(f"{k}r") for k in keys])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"{k}r"))
        of_rule = keyed.join(repeated, same, "left_semi").select(*names, F.explode(F.array(*map(F.lit, places))).alias("__fg_rule"))
        found = of_rule if found is None else found.unionByName(of_rule)
    if found is None:
        found = df.limit(0).select(*ids, F.lit(0).alias("__fg_rule"))
    # at most one entry per rule: the lists are bounded by the rule set
    reasons = found.groupBy(*names).agg(F.array_sort(F.collect_set("__fg_rule")).alias(REASONS))
    return reasons.select(*[F.col(n).alias(c) for n, c in zip(names, identity, strict=True)], REASONS)


def quarantine_reasons(df: DataFrame, rules: Sequence[Rule], identity: Sequence[str] = (FILE, PLACE), access: Access = NO_ACCESS) -> DataFrame:
    """The rows of ``df`` that fail any rule, whole, with the ids of the
    rules they fail (``failed_rules array<struct<rule_id, name>>``, in the
    order of ``rules``)."""
    reasons = row_reasons(df, rules, identity, access)
    listed = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.name).alias("name")) for r in rules])
    renamed = reasons.select(*[col_of(c).alias(f"__fg_r{n}") for n, c in enumerate(identity)], REASONS)
    same = F.lit(True)
    for n, c in enumerate(identity):
        same = same & (col_of(c) == F.col(f"__fg_r{n}"))
    joined = df.join(renamed, same)
    named = F.transform(REASONS, lambda i: F.element_at(listed, i + 1))
    return joined.select(*[F.expr(quote(c)) for c in df.columns], named.alias(REASONS))
