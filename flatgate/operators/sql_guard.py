"""What the SQL of a query rule may do, decided on its parsed plan.

Rule files are written by people who do not own the cluster. Their SQL may
read ``temp`` and what the caller declares, and nothing else: no other table
or view, no file by its path, no function that reaches outside the data. The
check walks the plan as parsed, before names are looked up, so a refused rule
has not listed a file, inferred a schema or started a job. Everything that is
not known to be harmless is refused.

The same walk recognises a rule that only counts rows of ``temp`` under a
condition; such rules share one scan (``rules.run_rules``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.sql import Column, SparkSession

DATA = "temp"

# Plan nodes that a query may consist of. Not among them: scripts, commands,
# hints with side effects, and relations named by an expression.
_PLANS = frozenset(
    "Project Filter Aggregate Join Sort Distinct Deduplicate Union Except Intersect GlobalLimit LocalLimit Offset Tail Window "
    "WithWindowDefinition SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedWith UnresolvedHaving UnresolvedInlineTable "
    "UnresolvedRelation UnresolvedTableValuedFunction Generate LateralJoin Pivot Unpivot OneRowRelation Range LocalRelation "
    "Expand Sample PipeOperator AsOfJoin UnionLoop SubqueryColumnAliases UnresolvedOrdinal".split())

# Groups of built-in functions that compute on their arguments only. Out are
# those of the group for the rest (reflection, the session, the environment)
# and XML, whose parsers follow references.
_GROUPS = frozenset(
    "agg_funcs array_funcs bitwise_funcs collection_funcs conditional_funcs conversion_funcs csv_funcs datetime_funcs "
    "generator_funcs hash_funcs json_funcs lambda_funcs map_funcs math_funcs predicate_funcs string_funcs struct_funcs url_funcs "
    "variant_funcs window_funcs".split())
# Also harmless: the file a row came from, a value's type.
_MORE = frozenset({"input_file_name", "typeof"})
# Their value is not the same for each evaluation, so they cannot be part of a
# condition that is counted in an aggregate.
_VARYING = frozenset("rand randn random uniform randstr shuffle input_file_name".split())
_LEAVES = frozenset("Literal UnresolvedAttribute UnresolvedStar AttributeReference UnresolvedNamedLambdaVariable".split())

_TREE = "org.apache.spark.sql.catalyst.trees.TreeNode"
_PLAN = "org.apache.spark.sql.catalyst.plans.logical.LogicalPlan"
_LOGICAL, _EXPRESSIONS = "org.apache.spark.sql.catalyst.plans.logical.", "org.apache.spark.sql.catalyst.expressions."


class RuleSqlError(ValueError):
    """A rule's SQL does what rules may not."""


@dataclass(frozen=True)
class ParsedRule:
    """``columns``: the condition reads these (lower case, first name part);
    ``condition`` is None for "every row". ``counted`` says that the rule is
    nothing but such a count."""

    counted: bool = False
    condition: Column | None = None
    columns: frozenset[str] = frozenset()


def _class(obj: JavaObject) -> str:
    return obj.getClass().getName()


def _names(seq: JavaObject) -> list[str]:
    return [seq.apply(i) for i in range(seq.length())]


class _Walk:
    """One walk over a parsed plan."""

    def __init__(self, spark: SparkSession, tables: Iterable[str], paths: Iterable[str], functions: Iterable[str]):
        self.gateway, self.jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
        self.tables = {DATA, *(t.lower() for t in tables)}
        self.paths = [p.rstrip("/") for p in paths]
        self.functions = {f.lower() for f in functions}
        self.builtin = self.jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin()

    def is_a(self, obj: JavaObject, name: str) -> bool:
        return is_instance_of(self.gateway, obj, name)

    def is_plan(self, obj: JavaObject, name: str) -> bool:
        # every question to the JVM costs; where the package decides, ask none
        return name.startswith(_LOGICAL) or (not name.startswith(_EXPRESSIONS) and self.is_a(obj, _PLAN))

    def nodes(self, value) -> Iterator[tuple[JavaObject, str]]:
        """Tree nodes directly inside a value, with their class: an option,
        sequence or tuple of them, or one itself."""
        if not isinstance(value, JavaObject):
            return
        name = _class(value)
        if name.startswith("scala.collection."):
            each = value.iterator()
            while each.hasNext():
                yield from self.nodes(each.next())
        elif name == "scala.Some" or name.startswith("scala.Tuple"):
            for i in range(value.productArity()):
                yield from self.nodes(value.productElement(i))
        elif "$Lambda" in name:
            raise RuleSqlError("a name given by an expression is not allowed")
        elif name.startswith(_EXPRESSIONS) or (name.startswith(_LOGICAL) and name.rsplit(".", 1)[-1] in _PLANS):
            yield value, name
        elif name.startswith("org.apache.spark.") and self.is_a(value, _TREE):
            yield value, name

    def inside(self, node: JavaObject) -> Iterator[tuple[JavaObject, str]]:
        if not self.is_a(node, "scala.Product"):  # a constant of the expressions' package
            return
        for i in range(node.productArity()):
            yield from self.nodes(node.productElement(i))

    # -- what is allowed ----------------------------------------------------

    def check(self, node: JavaObject, name: str, scope: frozenset[str] = frozenset()) -> None:
        """Raise for anything that is not allowed in ``node`` or below.
        ``scope``: names of common table expressions that can be seen."""
        kind = name.rsplit(".", 1)[-1]
        if kind in _LEAVES:
            return
        if self.is_plan(node, name):
            if kind == "UnresolvedWith":
                return self.check_with(node, scope)
            if kind.rstrip("$") not in _PLANS:
                raise RuleSqlError(f"{kind.rstrip('$')} is not allowed in a rule")
            if kind == "UnresolvedRelation":
                return self.check_relation(_names(node.multipartIdentifier()), scope)
        if kind == "UnresolvedFunction":
            self.check_function(_names(node.nameParts()))
        elif kind == "UnresolvedTableValuedFunction":
            self.check_function(_names(node.productElement(0)), table=True)
        elif kind == "UnresolvedGenerator":
            self.check_function([node.name().funcName()])
        elif "UnresolvedIdentifier" in kind or "Reflect" in kind or "UDF" in kind:
            raise RuleSqlError(f"{kind} is not allowed in a rule")
        for child, child_name in self.inside(node):
            self.check(child, child_name, scope)

    def check_with(self, node: JavaObject, scope: frozenset[str]) -> None:
        relations = node.cteRelations()
        recursive = bool(node.allowRecursion())
        for i in range(relations.length()):
            one = relations.apply(i)
            name = one.productElement(0).lower()
            body = one.productElement(1)
            self.check(body, _class(body), scope | {name} if recursive else scope)
            scope = scope | {name}
        self.check(node.child(), _class(node.child()), scope)

    def check_relation(self, parts: list[str], scope: frozenset[str]) -> None:
        name = ".".join(parts).lower()
        if name in self.tables or (len(parts) == 1 and name in scope):
            return
        if len(parts) == 2 and ".." not in parts[1]:
            at = parts[1].rstrip("/")
            if any(at == p or at.startswith(p + "/") for p in self.paths):
                return
        raise RuleSqlError(f"a rule may not read {'.'.join(parts)!r}: only {DATA!r} and what the caller declares")

    def check_function(self, parts: list[str], table: bool = False) -> None:
        name = ".".join(parts).lower()
        if name in self.functions:
            return
        if len(parts) == 1:
            if name in _MORE or (table and name == "range"):
                return
            info = self.builtin.lookupFunction(self.jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name))
            if info.isDefined() and info.get().getGroup() in _GROUPS:
                return
        raise RuleSqlError(f"a rule may not call {'.'.join(parts)!r}")

    # -- plain counts ---------------------------------------------------------

    def parsed(self, plan: JavaObject) -> ParsedRule:
        """``plan`` as a count of the data's rows under a condition, if it is
        one: columns or constants of ``temp``, with or without WHERE."""
        if not _class(plan).endswith(".Project"):
            return ParsedRule()
        columns: set[str] = set()
        items = plan.projectList()
        if not all(self.plain(items.apply(i), columns) for i in range(items.length())):
            return ParsedRule()
        below, condition = plan.child(), None
        if _class(below).endswith(".Filter"):
            expression, below = below.condition(), below.child()
            if not self.countable(expression, _class(expression), columns):
                return ParsedRule()
            condition = Column(self.jvm.org.apache.spark.sql.classic.ExpressionUtils.column(expression))
        if not _class(below).endswith(".UnresolvedRelation") or [n.lower() for n in _names(below.multipartIdentifier())] != [DATA]:
            return ParsedRule()
        return ParsedRule(True, condition, frozenset(columns))

    def column(self, node: JavaObject, columns: set[str]) -> None:
        parts = [p.lower() for p in _names(node.nameParts())]
        columns.add(parts[1] if len(parts) > 1 and parts[0] == DATA else parts[0])

    def plain(self, item: JavaObject, columns: set[str]) -> bool:
        kind = _class(item).rsplit(".", 1)[-1]
        if kind in ("Alias", "UnresolvedAlias"):
            return self.plain(item.child(), columns)
        if kind == "UnresolvedAttribute":
            self.column(item, columns)
            return True
        return kind == "Literal" or (kind == "UnresolvedStar" and not item.target().isDefined())

    def countable(self, node: JavaObject, name: str, columns: set[str]) -> bool:
        kind = name.rsplit(".", 1)[-1]
        if kind == "UnresolvedAttribute":
            self.column(node, columns)
        if kind in _LEAVES:
            return kind != "UnresolvedStar"
        if self.is_plan(node, name):  # a subquery
            return False
        if kind == "UnresolvedFunction":
            function = _names(node.nameParts())[-1].lower()
            info = self.builtin.lookupFunction(self.jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(function))
            if function in _VARYING or not info.isDefined() or info.get().getGroup() in ("agg_funcs", "window_funcs", "generator_funcs"):
                return False
        return all(self.countable(child, child_name, columns) for child, child_name in self.inside(node))


def check_rule_sql(spark: SparkSession, sql: str, tables: Iterable[str] = (), paths: Iterable[str] = (),
                   functions: Iterable[str] = ()) -> ParsedRule:
    """Raise ``RuleSqlError`` unless ``sql`` is a query over ``temp``,
    ``tables``, files at or below ``paths`` and its own common table
    expressions, calling built-in functions of the data and ``functions``
    only. Nothing is looked up or run. Returns what the rule is."""
    walk = _Walk(spark, tables, paths, functions)
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql.strip().rstrip(";"))
    walk.check(plan, _class(plan))
    return walk.parsed(plan)
