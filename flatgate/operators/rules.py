"""Declarative data-quality rules: not null, unique, query.

Every not-null rule and the total are answered by one keyless aggregate (one
row per task leaves the scan). Every unique rule is answered by one
``GROUPING SETS`` aggregation, one set per distinct key list (a plain
``groupBy`` when there is one), combined map-side before the shuffle. The
two stay apart so that a shuffle of near-unique keys carries no counters of
other rules. A query rule that counts rows of the data under a condition joins
the scan of the not-null rules; any other SQL runs a job of its own. The
reference shape (one job per rule plus one for the total) costs k+1 scans.

Rule SQL is checked before anything runs (``sql_guard``): it reads the data
and what the caller's ``Access`` declares, nothing else.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructType

from flatgate.functions.predicates import not_null_failure_sql, parse_columns
from flatgate.operators.flatten import col_of, quote
from flatgate.operators.sql_guard import DATA, ParsedRule, RuleSqlError, check_rule_sql
from flatgate.session import application_id

# Rule type names as they appear in rule files.
NOT_NULL = "not null"
UNIQUE = "unique"
QUERY = "query"
RULE_TYPES = (NOT_NULL, UNIQUE, QUERY)

RESULT_SCHEMA = (
    "app_id string, dq_id int, rule_id int, rule_name string, rule_type string, description string, "
    "columns_or_query string, status string, pass_count bigint, fail_count bigint, total_count bigint, "
    "pass_count_valid boolean"
)


@dataclass(frozen=True)
class Access:
    """What query rules may use besides the data: ``tables`` by name, files
    at or below ``paths`` (as ``format.`path```), functions by name."""

    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    paths: tuple[str, ...] = ()
    functions: tuple[str, ...] = ()

    def check(self, spark: SparkSession, rule: Rule) -> ParsedRule:
        try:
            return check_rule_sql(spark, rule.query, self.tables, self.paths, self.functions)
        except RuleSqlError as e:
            raise RuleSqlError(f"rule {rule.rule_id} ({rule.name}): {e}") from None


NO_ACCESS = Access()


@dataclass(frozen=True)
class Rule:
    rule_id: int
    name: str
    rule_type: str
    description: str | None = None
    columns: tuple[str, ...] | None = None
    query: str | None = None
    dq_id: int | None = None

    def __post_init__(self):
        if self.rule_type not in RULE_TYPES:
            raise ValueError(f"rule {self.rule_id}: unknown rule_type {self.rule_type!r}")
        if self.rule_type == QUERY:
            if not self.query or not self.query.strip():
                raise ValueError(f"rule {self.rule_id}: query rule without query")
        elif not self.columns:
            raise ValueError(f"rule {self.rule_id}: {self.rule_type} rule without columns")

    @property
    def target(self) -> str:
        """Columns (as a JSON list) or the query text, for the report."""
        return self.query if self.rule_type == QUERY else json.dumps(list(self.columns))


def rule_from_dict(d: dict, dq_id: int | None = None) -> Rule:
    cols = d.get("columns")
    if cols is not None:
        cols = tuple(parse_columns(cols))
    return Rule(
        rule_id=int(d["rule_id"]),
        name=d.get("name") or str(d["rule_id"]),
        rule_type=(d.get("rule_type") or "").strip().lower(),
        description=d.get("description"),
        columns=cols,
        query=d.get("query"),
        dq_id=d.get("dq_id", dq_id),
    )


def rules_from_dicts(dicts: Iterable[dict], dq_id: int | None = None) -> list[Rule]:
    return [rule_from_dict(d, dq_id) for d in dicts]


# ---------------------------------------------------------------------------
# counting
# ---------------------------------------------------------------------------


def _types(df: DataFrame) -> dict[str, DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def not_null_plan(df: DataFrame, rules: Sequence[Rule], conditions: Sequence[Column | None] = ()) -> DataFrame:
    """One row: the total, the failures of each not-null rule and the rows
    under each condition (``__fg_total``, ``__fg_nn<i>`` and ``__fg_q<i>`` by
    place), a keyless aggregate over the columns that they read."""
    types = _types(df)
    # SQL text: one driver->JVM call per rule, however many columns
    failures = [
        F.expr(f"count_if({not_null_failure_sql(r.columns, types)}) AS __fg_nn{i}") for i, r in enumerate(rules)
    ]
    counts = [(F.count(F.lit(1)) if c is None else F.count_if(c)).alias(f"__fg_q{i}") for i, c in enumerate(conditions)]
    # conditions may call the data by its name
    return (df.alias(DATA) if counts else df).agg(F.count(F.lit(1)).alias("__fg_total"), *failures, *counts)


def unique_plan(df: DataFrame, key_sets: Sequence[tuple[str, ...]]) -> tuple[DataFrame, list[int]]:
    """``(frame, ids)``: one row per key list (``__fg_gid``, ``__fg_total``,
    ``__fg_dups``), and the id of each key list. The shuffle carries the key
    and a count per key group, nothing else."""
    # stable internal names for the key columns, so a rule column called
    # like one of our aliases (e.g. ``cnt``) can never be ambiguous
    all_keys = list(dict.fromkeys(k for ks in key_sets for k in ks))
    alias = {k: f"__fg_k{i}" for i, k in enumerate(all_keys)}
    src = df.selectExpr(*[f"{quote(k)} AS {alias[k]}" for k in all_keys])
    per_group = F.count(F.lit(1)).alias("__fg_n")
    per_list = [F.sum("__fg_n").alias("__fg_total"), F.count_if(F.col("__fg_n") > 1).alias("__fg_dups")]
    if len(key_sets) == 1:
        # one key list: a plain groupBy, then a keyless global aggregate
        groups = src.groupBy(*[alias[k] for k in key_sets[0]]).agg(per_group)
        return groups.agg(*per_list).withColumn("__fg_gid", F.lit(0)), [0]
    sets = [[alias[k] for k in ks] for ks in key_sets]
    groups = src.groupingSets(sets, *[alias[k] for k in all_keys]).agg(F.grouping_id().alias("__fg_gid"), per_group)
    # grouping_id bit (n-1-i) is 1 when key i is NOT grouped
    n = len(all_keys)
    ids = [sum(1 << (n - 1 - i) for i, k in enumerate(all_keys) if k not in ks) for ks in key_sets]
    return groups.groupBy("__fg_gid").agg(*per_list), ids


def not_null_counts(df: DataFrame, rules: Sequence[Rule], conditions: Sequence[Column | None] = ()) -> tuple[int, list[int]]:
    """Total rows, and failures by place in ``rules`` and then ``conditions``."""
    row = not_null_plan(df, rules, conditions).first()
    return row["__fg_total"], [row[f"__fg_nn{i}"] for i in range(len(rules))] + [row[f"__fg_q{i}"] for i in range(len(conditions))]


def unique_counts(df: DataFrame, rules: Sequence[Rule]) -> tuple[int, list[int]]:
    """Total rows, and duplicated key *groups* (not rows) by place in
    ``rules``; NULL keys group together. Rules sharing a set of keys share a
    grouping set."""
    key_of = [tuple(sorted(set(r.columns))) for r in rules]
    key_sets = list(dict.fromkeys(key_of))
    frame, ids = unique_plan(df, key_sets)
    rows = {r["__fg_gid"]: r for r in frame.collect()}  # one small row per key list
    found = {ks: rows.get(i) for ks, i in zip(key_sets, ids, strict=True)}
    first = found[key_sets[0]]
    total = int(first["__fg_total"] or 0) if first else 0
    return total, [int(found[ks]["__fg_dups"]) if found[ks] else 0 for ks in key_of]


def query_rule_count(df: DataFrame, sql: str, access: Access = NO_ACCESS) -> int:
    """D3: rows returned by ``sql``, where the data is visible as ``temp``
    and the tables of ``access`` by their names.

    The data is registered under a unique view name and aliased to ``temp``
    by a CTE, so concurrent callers never share a view. The text has to
    parse by itself and pass the guard before it is wrapped.
    """
    check_rule_sql(df.sparkSession, sql, access.tables, access.paths, access.functions)
    return _checked_rule_count(df, sql, access)


def _checked_rule_count(df: DataFrame, sql: str, access: Access) -> int:
    spark = df.sparkSession
    views = {name: f"__fg_src_{uuid.uuid4().hex}" for name in (DATA, *access.tables)}
    for name, frame in {DATA: df, **access.tables}.items():
        frame.createOrReplaceTempView(views[name])
    try:
        named = ", ".join(f"{quote(name)} AS (SELECT * FROM {view})" for name, view in views.items())
        wrapped = f"WITH {named} SELECT count(*) AS n FROM (\n{sql.strip().rstrip(';')}\n) q"
        return int(spark.sql(wrapped).first()["n"])
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def fused_conditions(df: DataFrame, rules: Sequence[Rule], access: Access = NO_ACCESS) -> dict[int, Column | None]:
    """Conditions of the query rules (by place in ``rules``) that only count
    rows of the data: ``SELECT columns FROM temp [WHERE condition]`` over
    columns that exist. Every query rule passes the guard first."""
    known = {c.lower() for c in df.columns}
    parsed = {i: access.check(df.sparkSession, r) for i, r in enumerate(rules) if r.rule_type == QUERY}
    return {i: p.condition for i, p in parsed.items() if p.counted and p.columns <= known}


def run_rules(df: DataFrame, rules: Sequence[Rule], app_id: str | None = None,
              max_concurrent_jobs: int = 8, access: Access = NO_ACCESS) -> DataFrame:
    """Run every rule (all three types), return the result table.

    ``fail_count`` is rows failing (not null), duplicated groups (unique) or
    rows returned (query); ``pass_count = total - fail`` (may go negative
    for a query rule, flagged by ``pass_count_valid``); status is 'fail'
    iff fail_count > 0.

    Query rules that only count rows under a condition are part of the
    not-null scan. That scan, the unique scan and the jobs of other query
    rules are independent, so they are submitted together (one Spark application,
    several concurrent jobs). Results are kept by place in ``rules``: two
    rules may share an id, within a rule set or across rule sets.
    """
    spark = df.sparkSession
    app_id = app_id or application_id(spark)
    fused = fused_conditions(df, rules, access)
    places = {t: [i for i, r in enumerate(rules) if r.rule_type == t and i not in fused] for t in RULE_TYPES}
    of = {t: [rules[i] for i in places[t]] for t in RULE_TYPES}
    workers = max(1, min(max_concurrent_jobs, 2 + len(of[QUERY])))
    fails: dict[int, int] = {}  # by place in the list: rule ids may repeat
    with ThreadPoolExecutor(workers) as pool:
        # the total rides on whichever of the two scans runs
        scans = []
        if of[NOT_NULL] or fused or not of[UNIQUE]:
            scans.append(([*places[NOT_NULL], *fused], pool.submit(not_null_counts, df, of[NOT_NULL], list(fused.values()))))
        if of[UNIQUE]:
            scans.append((places[UNIQUE], pool.submit(unique_counts, df, of[UNIQUE])))
        pending = [(i, pool.submit(_checked_rule_count, df, rules[i].query, access)) for i in places[QUERY]]
        for at, scan in scans:
            total, counts = scan.result()
            fails.update(zip(at, counts, strict=True))
        fails.update((i, job.result()) for i, job in pending)
    rows = [
        (app_id, r.dq_id, r.rule_id, r.name, r.rule_type, r.description, r.target,
         "fail" if fails[i] > 0 else "pass", total - fails[i], fails[i], total, total - fails[i] >= 0)
        for i, r in enumerate(rules)
    ]
    return local_table(spark, rows, RESULT_SCHEMA)


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few rows as a local relation: reading them runs no job."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), schema)


def rule_not_null(df: DataFrame, columns: str | Sequence[str], rule_id: int = 1, name: str = "not null") -> DataFrame:
    """D1 on its own (result table with one row)."""
    return run_rules(df, [Rule(rule_id, name, NOT_NULL, columns=tuple(parse_columns(columns)))])


def rule_unique(df: DataFrame, columns: str | Sequence[str], rule_id: int = 1, name: str = "unique") -> DataFrame:
    """D2 on its own (result table with one row)."""
    return run_rules(df, [Rule(rule_id, name, UNIQUE, columns=tuple(parse_columns(columns)))])


def rule_query(df: DataFrame, sql: str, rule_id: int = 1, name: str = "query", access: Access = NO_ACCESS) -> DataFrame:
    """D3 on its own (result table with one row)."""
    return run_rules(df, [Rule(rule_id, name, QUERY, query=sql)], access=access)


def verdict(results: DataFrame) -> DataFrame:
    """``passed`` is true iff no rule failed."""
    return results.agg(F.coalesce(F.bool_and(F.col("status") == "pass"), F.lit(True)).alias("passed"))


def failed(results: DataFrame) -> DataFrame:
    """Failed rules."""
    return results.filter(F.col("status") == "fail")


def passed(results: DataFrame) -> DataFrame:
    """Passed rules."""
    return results.filter(F.col("status") == "pass")


def missing_keys(expected: DataFrame, key: str, seen: DataFrame, seen_key: str | None = None) -> DataFrame:
    """D7 generalised: expected keys absent from ``seen`` (a left anti join;
    the planner picks broadcast or shuffle from the measured sizes). The
    seen keys are made distinct first, combined map-side, so a key repeated
    a billion times is one row on the join's build side."""
    seen_key = seen_key or key
    s = seen.select(col_of(seen_key).alias("__fg_key")).distinct()
    return expected.join(s, col_of(key) == F.col("__fg_key"), "left_anti")


def expected_files_missing(df: DataFrame, names: Iterable[str] | DataFrame, file_col: str = "source_file",
                           level: int = 1) -> DataFrame:
    """Expected file names not present among the rows' source files.

    ``level`` picks the path element from the end (1 = file name, 2 = its
    folder, e.g. a ``key=value`` partition folder). The expected names are a
    short list (configuration) or, of any length, a frame with a column
    ``file_name``; the seen names are a distinct over the data (combined
    map-side, one row per file)."""
    if isinstance(names, DataFrame):
        expected = names.select("file_name").distinct()
    else:
        expected = local_table(df.sparkSession, [(n,) for n in dict.fromkeys(names)], "file_name string")
    seen = df.select(F.element_at(F.split(col_of(file_col), "/"), -level).alias("file_name")).distinct()
    return missing_keys(expected, "file_name", seen)
