"""Schema drift: what arriving JSON looks like against the stored schema.

A schema is inferred once and stored; later arrivals are read with it, and a
field that changed silently becomes NULL. Here every arrival's documents are
parsed as they are, and the kinds of value seen at each path are merged in a
lattice: a kind is a bit, the merge of two arrivals' kinds is their bitwise
or. That merge is a fixed-width partial aggregate, combined in each task
before the shuffle, so documents of any number and spelling cost the driver
nothing; only the stored schema, which is configuration, is walked there.

Paths are keys behind dots and ``[]`` for the elements of an array; a dot,
bracket or backslash in a key has a backslash before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatgate.operators.flatten import col_of, leaf_steps
from flatgate.operators.rules import local_table

BOOLEAN, BIGINT, DECIMAL, DOUBLE, STRING, OBJECT, ARRAY = (1 << i for i in range(7))
KINDS = {BOOLEAN: "BOOLEAN", BIGINT: "BIGINT", DECIMAL: "DECIMAL", DOUBLE: "DOUBLE", STRING: "STRING", OBJECT: "OBJECT", ARRAY: "ARRAY"}
_NUMBERS = BIGINT | DECIMAL | DOUBLE
_SCALARS = BOOLEAN | _NUMBERS | STRING


def kind_of(dt: T.DataType) -> int:
    """The kind that JSON values of a stored type have."""
    if isinstance(dt, T.BooleanType):
        return BOOLEAN
    if isinstance(dt, T.IntegralType):
        return BIGINT
    if isinstance(dt, T.DecimalType):
        return DECIMAL
    if isinstance(dt, T.FractionalType):
        return DOUBLE
    if isinstance(dt, (T.StructType, T.MapType, T.VariantType)):
        return OBJECT
    if isinstance(dt, T.ArrayType):
        return ARRAY
    return 0 if isinstance(dt, T.NullType) else STRING  # dates and times are text in JSON


def _key(name: str) -> str:
    for special in "\\.[":
        name = name.replace(special, "\\" + special)
    return "." + name


def stored_paths(dt: T.DataType, at: str = "") -> list[tuple[str, int]]:
    """``(path, kind)`` of every field of a stored schema, containers too."""
    out = [(at, kind_of(dt))] if at else []
    if isinstance(dt, T.StructType):
        return out + [p for f in dt.fields for p in stored_paths(f.dataType, at + _key(f.name))]
    if isinstance(dt, T.MapType):
        raise ValueError(f"{at}: the keys of a map are data, not schema")
    return out + stored_paths(dt.elementType, at + "[]") if isinstance(dt, T.ArrayType) else out


def _kind_bit(kind: Column) -> Column:
    bit = F.lit(0)
    for value, name in KINDS.items():
        bit = F.when(kind.startswith(name), F.lit(value)).otherwise(bit)
    return F.when(kind == "FLOAT", F.lit(DOUBLE)).otherwise(bit)


def observed_kinds(df: DataFrame, json_col: str, arrival_col: str, depth: int | None = None) -> DataFrame:
    """``(arrival, path, kinds, n_values)`` of JSON text: the kinds of value
    at each path of each arrival's documents as bits, JSON nulls without one,
    and the number of values (below a container: of its scalars). Documents
    that do not parse are the row of a NULL path. An empty object or array
    says nothing, nor does a NULL text."""
    leaves = leaf_steps(df.select(col_of(arrival_col).alias("arrival"), col_of(json_col).alias("doc")), "arrival", "doc", depth=depth)
    # positions do not matter: one pattern for all elements of an array
    pattern = F.transform("steps", lambda s: s["key"])
    patterns = leaves.select("arrival", pattern.alias("keys"), _kind_bit(F.col("kind")).alias("kind")).groupBy("arrival", "keys").agg(
        F.expr("bit_or(kind)").alias("kinds"), F.count(F.lit(1)).alias("n"))

    def spelled(key: Column) -> Column:
        name = key
        for special in "\\.[":
            name = F.replace(name, F.lit(special), F.lit("\\" + special))
        return F.when(key.isNull(), F.lit("[]")).otherwise(F.concat(F.lit("."), name))

    def prefix(i: Column) -> Column:
        # what stands at the prefix: the leaf's kinds, or the container of the next step
        within = F.when(F.get("keys", i).isNull(), F.lit(ARRAY)).otherwise(F.lit(OBJECT))
        return F.struct(F.array_join(F.transform(F.slice("keys", 1, i), spelled), "").alias("path"),
                        F.when(i == F.size("keys"), F.col("kinds")).otherwise(within).alias("kinds"))

    whole = F.size("keys") == 0  # a document that is a scalar
    prefixes = F.when(F.col("keys").isNull() | whole, F.array(F.struct(F.when(whole, F.lit("")).alias("path"), F.col("kinds")))).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size("keys"), F.lit(1))), prefix))
    rows = patterns.select("arrival", F.explode(prefixes).alias("p"), "n")
    return rows.groupBy("arrival", F.col("p.path").alias("path")).agg(F.expr("bit_or(p.kinds)").alias("kinds"), F.sum("n").alias("n_values"))


def kind_text(kinds: Column) -> Column:
    """``BIGINT|STRING`` for a set of kinds, ``VOID`` for none."""
    names = F.concat_ws("|", *[F.when(kinds.bitwiseAND(F.lit(bit)) != 0, F.lit(name)) for bit, name in KINDS.items()])
    return F.when(names == "", F.lit("VOID")).otherwise(names)


def drift_status(kinds: Column, stored: Column) -> Column:
    """``same``: every value seen fits the stored type (nulls fit all, a
    whole number fits every number, any scalar fits text). ``widened``: a
    wider number holds both. ``conflicting``: no such type."""
    both = kinds.bitwiseOR(stored)
    inside = (both == stored) | ((stored == STRING) & (both.bitwiseAND(F.lit(~_SCALARS)) == 0))
    numbers = (both.bitwiseAND(F.lit(~_NUMBERS)) == 0) & (stored != 0)
    return (
        F.when(inside | (kinds == 0), F.lit("same")).when(numbers & (kinds <= stored), F.lit("same"))
        .when(numbers & (both < 2 * stored), F.lit("same")).when(numbers | (stored == 0), F.lit("widened")).otherwise(F.lit("conflicting")))


def schema_drift(df: DataFrame, json_col: str, arrival_col: str, stored: T.StructType, depth: int | None = None) -> DataFrame:
    """``(arrival, path, status, stored_type, observed_type, n_values)`` per
    arrival and path of the documents in ``json_col``.

    Status is ``same``, ``widened``, ``conflicting`` (see ``drift_status``),
    ``added`` for a path that the stored schema lacks, ``absent`` for a
    stored one that no document of the arrival has, and ``malformed`` for
    documents that do not parse (NULL path). The stored schema may not hold
    maps. One pass over the documents (and one for their depth unless it is
    given); a shuffle of one row per task, arrival and path."""
    known = sorted(stored_paths(stored))
    fields = local_table(df.sparkSession, known, "s_path string, s_kind int")
    seen = observed_kinds(df, json_col, arrival_col, depth)
    # the stored schema's fields: configuration, a few thousand rows at most
    joined = seen.join(F.broadcast(fields), F.col("path") == F.col("s_path"), "left")
    found = joined.select(
        "arrival", "path",
        F.when(F.col("path").isNull(), F.lit("malformed")).when(F.col("s_path").isNull(), F.lit("added"))
        .otherwise(drift_status(F.col("kinds"), F.col("s_kind"))).alias("status"),
        F.when(F.col("s_kind").isNotNull(), kind_text(F.col("s_kind"))).alias("stored_type"),
        F.when(F.col("path").isNotNull(), kind_text(F.col("kinds"))).alias("observed_type"), "n_values")
    # absent: per arrival the stored paths (a bounded set) less those it has
    paths = F.array(*[F.lit(p) for p, _ in known]).cast("array<string>")
    has = joined.groupBy("arrival").agg(F.collect_set("s_path").alias("has"))
    gone = has.select("arrival", F.explode(F.array_except(paths, "has")).alias("path"))
    gone = gone.join(F.broadcast(fields), F.col("path") == F.col("s_path"))
    return found.unionByName(gone.select(
        "arrival", "path", F.lit("absent").alias("status"), kind_text(F.col("s_kind")).alias("stored_type"),
        F.lit(None).cast("string").alias("observed_type"), F.lit(0).cast("long").alias("n_values")))
