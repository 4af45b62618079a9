"""Flatten operators: nested structs and arrays to flat columns and rows.

All of them walk the ``StructType`` on the driver (schema only, no data) and
emit plain ``select`` / ``explode_outer`` plans, so Catalyst keeps column and
nested-field pruning down to the scan and everything stays in codegen.

Naming rule shared by every variant: compute each output name from its leaf
path, then claim it case-insensitively (Spark resolves names that way by
default). A name already taken falls back to the prefixed path name and then
to a numeric suffix (``name_2``, ``name_3`` ...), so no two output columns
can ever be ambiguous.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType


def quote(name: str) -> str:
    """Back-quote a column name so dots, spaces and backticks resolve."""
    return "`" + name.replace("`", "``") + "`"


def col_of(name: str) -> Column:
    return F.col(quote(name))


# Flatten plans are built as SQL expression text and applied with one
# ``selectExpr`` per level: one driver->JVM call per projection instead of
# several per column, which keeps planning time flat on wide schemas.
Cols = list[tuple[str, str, DataType]]  # (output name, SQL expression, type)


def _frame_cols(df: DataFrame) -> Cols:
    return [(f.name, quote(f.name), f.dataType) for f in df.schema.fields]


def _select(df: DataFrame, cols: Cols, generator_at: int | None = None) -> tuple[DataFrame, Cols]:
    """Apply ``cols`` (outer-exploding column ``generator_at``) and return
    the new frame with its columns re-based on their output names."""
    exprs = []
    out: Cols = []
    for i, (name, expr, dt) in enumerate(cols):
        if i == generator_at:
            exprs.append(f"explode_outer({expr}) AS {quote(name)}")
            dt = dt.elementType
        else:
            exprs.append(f"{expr} AS {quote(name)}")
        out.append((name, quote(name), dt))
    return df.selectExpr(*exprs), out


def is_complex(dt: DataType) -> bool:
    return isinstance(dt, (StructType, ArrayType))


class Namer:
    """Hands out output names that are unique ignoring case."""

    def __init__(self, taken: Iterable[str] = ()):
        self._taken = {n.lower() for n in taken}

    def release(self, name: str) -> None:
        self._taken.discard(name.lower())

    def claim(self, *candidates: str, sep: str = "_") -> str:
        for cand in candidates:
            if cand.lower() not in self._taken:
                self._taken.add(cand.lower())
                return cand
        base = candidates[-1]
        n = 2
        while f"{base}{sep}{n}".lower() in self._taken:
            n += 1
        name = f"{base}{sep}{n}"
        self._taken.add(name.lower())
        return name


def _dedupe_type(dt: DataType) -> DataType:
    """Rename struct fields that differ only in case, at every depth.

    A struct cast is positional, so casting a column to the returned type
    renames the fields without touching the data.
    """
    if isinstance(dt, StructType):
        namer = Namer()
        fields = [
            StructField(namer.claim(f.name), _dedupe_type(f.dataType), f.nullable, f.metadata)
            for f in dt.fields
        ]
        return StructType(fields)
    if isinstance(dt, ArrayType):
        return ArrayType(_dedupe_type(dt.elementType), dt.containsNull)
    if isinstance(dt, MapType):
        return MapType(dt.keyType, _dedupe_type(dt.valueType), dt.valueContainsNull)
    return dt


def normalize_names(df: DataFrame) -> DataFrame:
    """Make top-level and nested names unique ignoring case.

    Top level is renamed positionally with ``toDF`` (never resolves a name,
    so even two columns ``Id``/``id`` are safe); nested structs are cast to
    a renamed type only where a clash exists.
    """
    namer = Namer()
    new_names = [namer.claim(f.name) for f in df.schema.fields]
    # always re-alias: fresh attributes carry no table qualifier, so
    # ``a`.`b`` in the generated SQL can only mean field b of column a
    df = df.toDF(*new_names)
    casts = []
    changed = False
    for f in df.schema.fields:
        fixed = _dedupe_type(f.dataType)
        if fixed != f.dataType:
            changed = True
            casts.append(col_of(f.name).cast(fixed).alias(f.name))
        else:
            casts.append(col_of(f.name))
    return df.select(*casts) if changed else df


def complex_columns(df: DataFrame) -> list[tuple[str, DataType]]:
    """top-level array and struct columns, in schema order."""
    return [(f.name, f.dataType) for f in df.schema.fields if is_complex(f.dataType)]


# ---------------------------------------------------------------------------
# plain (bare-name) flatten
# ---------------------------------------------------------------------------


def _flatten_bare(df: DataFrame, sep: str) -> DataFrame:
    """First complex column in schema order is handled each turn: a struct's
    children are appended at the end under their bare names (parent dropped),
    an array is outer-exploded in place. Repeats until nothing is nested."""
    cols: Cols = _frame_cols(df)
    paths = {c[0]: (c[0],) for c in cols}  # output name -> original path, for fallback names
    namer = Namer(c[0] for c in cols)
    while True:
        idx = next((i for i, c in enumerate(cols) if is_complex(c[2])), None)
        if idx is None:
            break
        name, expr, dt = cols[idx]
        if isinstance(dt, StructType):
            del cols[idx]
            namer.release(name)
            for f in dt.fields:
                child_path = paths[name] + (f.name,)
                nm = namer.claim(f.name, sep.join(child_path), sep=sep)
                paths[nm] = child_path
                cols.append((nm, f"{expr}.{quote(f.name)}", f.dataType))
        else:
            df, cols = _select(df, cols, generator_at=idx)
    return df.selectExpr(*[f"{expr} AS {quote(n)}" for n, expr, _t in cols])


# ---------------------------------------------------------------------------
# Prefixed flatten
# ---------------------------------------------------------------------------


def _leaves(cols: Cols, sep: str, prefix: str | None = None) -> Iterator[tuple[str, str, DataType]]:
    """What is left of ``cols`` without structs, as (full name, expression,
    type): a node's own leaves, then its structs from the last to the first."""
    named = [(name if prefix is None else f"{prefix}{sep}{name}", expr, t) for name, expr, t in cols]
    yield from (c for c in named if not isinstance(c[2], StructType))
    for full, expr, t in reversed(named):
        if isinstance(t, StructType):
            yield from _leaves([(f.name, f"{expr}.{quote(f.name)}", f.dataType) for f in t.fields], sep, full)


def _struct_pass(cols: Cols, sep: str) -> Cols | None:
    """Columns with every struct opened, or None if there is no struct."""
    if not any(isinstance(t, StructType) for _n, _e, t in cols):
        return None
    namer = Namer()
    return [(namer.claim(full, sep=sep), expr, t) for full, expr, t in _leaves(cols, sep)]


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """expand every struct to ``parent<sep>child`` columns; arrays and
    maps are leaves. One ``select``."""
    df = normalize_names(df)
    cols = _struct_pass(_frame_cols(df), sep)
    return df if cols is None else _select(df, cols)[0]


def explode_all(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """outer-explode each listed array column in place (all top-level
    arrays when ``cols`` is None). Sibling arrays multiply: a row with arrays
    of 3 and 2 elements gives 6 rows; null or empty arrays keep the row."""
    df, _cols = _explode_each(df, _frame_cols(df), cols)
    return df


def _explode_each(df: DataFrame, cols: Cols, names: Sequence[str] | None = None) -> tuple[DataFrame, Cols]:
    if names is None:
        names = [n for n, _e, t in cols if isinstance(t, ArrayType)]
    for name in names:
        idx = next(i for i, c in enumerate(cols) if c[0] == name)
        df, cols = _select(df, cols, generator_at=idx)
    return df, cols


def _flatten_prefixed(df: DataFrame, sep: str) -> DataFrame:
    """struct pass, then rounds of (explode every array, struct pass)
    until no array is left. Types are tracked on the driver, so no round
    asks the JVM for a schema."""
    cols = _frame_cols(df)
    passed = _struct_pass(cols, sep)
    if passed is not None:
        df, cols = _select(df, passed)
    while any(isinstance(t, ArrayType) for _n, _e, t in cols):
        df, cols = _explode_each(df, cols)
        passed = _struct_pass(cols, sep)
        if passed is not None:
            df, cols = _select(df, passed)
    return df


def flatten_zipped(df: DataFrame, sep: str = "_") -> DataFrame:
    """F4 without the product: the sibling arrays of a level advance
    together, so a row of arrays of 3 and 2 elements gives 3 rows, the
    shorter one padded with nulls. Names as of the prefixed flatten; null or
    empty arrays keep their row. A level costs one Generate, and rows are
    the longest array's length, where ``explode_all`` multiplies lengths."""
    df = normalize_names(df)
    cols = _struct_pass(_frame_cols(df), sep) or _frame_cols(df)
    while arrays := [i for i, c in enumerate(cols) if isinstance(c[2], ArrayType)]:
        plain = [f"{expr} AS {quote(name)}" for i, (name, expr, _t) in enumerate(cols) if i not in arrays]
        # the zip of a null array would be null as a whole
        whole = ", ".join(f"coalesce({cols[i][1]}, array())" for i in arrays)
        zipped = Namer([c[0] for c in cols]).claim("__fg_zip", sep=sep)
        df = df.selectExpr(*plain, f"explode_outer(arrays_zip({whole})) AS {zipped}")
        # a zip of expressions numbers its fields
        names = [f.name for f in df.schema[zipped].dataType.fields]
        cols = [(name, quote(name), t) if i not in arrays else (name, f"{zipped}.{quote(names[arrays.index(i)])}", t.elementType)
                for i, (name, _e, t) in enumerate(cols)]
        cols = _struct_pass(cols, sep) or cols
    return df.selectExpr(*[f"{expr} AS {quote(name)}" for name, expr, _t in cols])


def flatten(df: DataFrame, prefix: bool = False, sep: str = "_", max_rows: int | None = None) -> DataFrame:
    """F1 (``prefix=False``) or F2 (``prefix=True``): every struct and array
    gone, maps kept. Null structs give null children; null or empty arrays
    keep their row with nulls.

    ``max_rows`` (opt-in) first counts the exact output size in one
    aggregation pass and raises instead of starting a cross-product
    blow-up of sibling arrays."""
    df = normalize_names(df)
    if max_rows is not None:
        n = explode_estimate(df)
        if n > max_rows:
            raise ValueError(f"flatten would produce {n} rows, more than max_rows={max_rows}")
    return _flatten_prefixed(df, sep) if prefix else _flatten_bare(df, sep)


# ---------------------------------------------------------------------------
# Exact output size before exploding
# ---------------------------------------------------------------------------


def _rows_expr(expr: Column, dt: DataType) -> Column | None:
    """Rows one value turns into after a full outer explode (None = 1)."""
    if isinstance(dt, StructType):
        parts = [p for f in dt.fields if (p := _rows_expr(expr.getField(f.name), f.dataType)) is not None]
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out * p
        return out
    if isinstance(dt, ArrayType):
        inner = dt.elementType

        def per_elem(x: Column) -> Column:
            r = _rows_expr(x, inner)
            return F.lit(1).cast("bigint") if r is None else r.cast("bigint")

        total = F.aggregate(F.transform(expr, per_elem), F.lit(0).cast("bigint"), lambda a, b: a + b)
        return F.greatest(F.lit(1).cast("bigint"), F.coalesce(total, F.lit(0).cast("bigint")))
    return None


def explode_estimate_expr(df: DataFrame) -> Column:
    """Per-row count of rows a full flatten produces (product over sibling
    arrays of the summed element counts, at least 1)."""
    parts = [p for f in df.schema.fields if (p := _rows_expr(col_of(f.name), f.dataType)) is not None]
    if not parts:
        return F.lit(1).cast("bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out * p
    return out


def explode_estimate(df: DataFrame) -> int:
    """Exact number of rows ``flatten`` will return, from one aggregation
    pass (no explode). Lets a caller refuse a cross-product blow-up before
    running it."""
    return df.agg(F.sum(explode_estimate_expr(df)).alias("n")).first()["n"] or 0


# ---------------------------------------------------------------------------
# positional flatten (arrays to numbered columns)
# ---------------------------------------------------------------------------


def _via_field(fn, name: str):
    # one-argument closures: F.transform reads a lambda's arity to choose
    # between (x) and (x, index), so no default arguments here
    return lambda c: fn(c.getField(name))


def _via_elements(fn):
    return lambda c: F.array_max(F.transform(c, lambda x: fn(x)))


def _size_specs(dt: DataType, key: tuple, exclude: frozenset):
    """(array key, fn(value) -> max size) for every array node below dt."""
    specs = []
    if isinstance(dt, StructType):
        for f in dt.fields:
            if f.name in exclude:
                continue
            for k, fn in _size_specs(f.dataType, key + (f.name,), exclude):
                specs.append((k, _via_field(fn, f.name)))
    elif isinstance(dt, ArrayType):
        specs.append((key, F.size))
        for k, fn in _size_specs(dt.elementType, key + ("[]",), exclude):
            specs.append((k, _via_elements(fn)))
    return specs


def array_widths(df: DataFrame, exclude: Iterable[str] = ()) -> dict[tuple, int]:
    """Max element count of every array node, all arrays in one pass."""
    exclude = frozenset(exclude)
    specs = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        for k, fn in _size_specs(f.dataType, (f.name,), exclude):
            specs.append((k, F.max(fn(col_of(f.name)))))
    if not specs:
        return {}
    row = df.agg(*[e.alias(f"w{i}") for i, (_k, e) in enumerate(specs)]).first()
    return {k: max(0, row[f"w{i}"] or 0) for i, (k, _e) in enumerate(specs)}


#: Columns that a positional layout may have; wider data belongs in rows.
MAX_POSITIONAL_COLUMNS = 20_000


def flatten_positional(
    df: DataFrame,
    max_items: int | None = None,
    exclude: Iterable[str] = (),
    sep: str = "_",
    max_columns: int = MAX_POSITIONAL_COLUMNS,
) -> DataFrame:
    """one row in, one row out. Struct fields become ``a<sep>b``
    columns, array elements numbered columns ``a<sep>0<sep>b`` (0-based);
    keys in ``exclude`` are skipped at every depth; empty structs and arrays
    give no column. Missing positions read as null (``get`` never raises out
    of bounds).

    Width of each array is the data's maximum (one pass) unless
    ``max_items`` fixes it (a stream has no such pass). No element is left
    out: a row with a longer array then fails the job. A layout of more than
    ``max_columns`` columns is refused; ``leaf_paths`` gives the same values
    as rows, whatever the length of an array.
    """
    if max_items is not None and max_items < 1:
        raise ValueError("max_items must be at least 1")
    df = normalize_names(df)
    exclude = frozenset(exclude)
    widths = array_widths(df, exclude) if max_items is None else None
    out: list[str] = []
    namer = Namer()

    def emit(expr: str, dt: DataType, parts: tuple, key: tuple) -> None:
        if isinstance(dt, StructType):
            for f in dt.fields:
                if f.name not in exclude:
                    emit(f"{expr}.{quote(f.name)}", f.dataType, parts + (f.name,), key + (f.name,))
        elif isinstance(dt, ArrayType):
            width = max_items if widths is None else widths.get(key, 0)
            if widths is None:
                text = f"flatten_positional: {sep.join(parts)} has more than max_items={max_items} elements".replace("'", "''")
                expr = f"if(size({expr}) > {max_items}, raise_error('{text}'), {expr})"
            for i in range(width):
                # get() is null past the end (never raises under ANSI)
                emit(f"get({expr}, {i})", dt.elementType, parts + (str(i),), key + ("[]",))
        else:
            out.append(f"{expr} AS {quote(namer.claim(sep.join(parts), sep=sep))}")
            if len(out) > max_columns:
                raise ValueError(f"flatten_positional would make more than {max_columns} columns; use leaf_paths for rows instead")

    for f in df.schema.fields:
        if f.name not in exclude:
            emit(quote(f.name), f.dataType, (f.name,), (f.name,))
    return df.selectExpr(*out)


# ---------------------------------------------------------------------------
# leaf paths of schemaless JSON (long form)
# ---------------------------------------------------------------------------


CORRUPT_PATH = "_corrupt_record"
USUAL_DEPTH = 8


def _deep_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(d, t)``: the largest usual depth of a batch of JSON texts, and each
    text that looks deeper with its own."""
    for batch in batches:
        texts = batch.column(0).drop_null()
        depth = _json_depths(texts) if len(texts) else np.zeros(0, np.int64)
        deep = np.flatnonzero(depth > USUAL_DEPTH)
        d = [depth[depth <= USUAL_DEPTH].max(initial=0), *depth[deep]]
        yield pa.RecordBatch.from_arrays([pa.array(d, pa.int32()), pa.array([None, *texts.take(deep).to_pylist()], pa.string())], names=["d", "t"])


_MARKS = np.zeros(256, np.int8)
_MARKS[list(b"{[")], _MARKS[list(b"}]")], _MARKS[list(b'"')] = 1, -1, 2


def _json_depths(texts: pa.StringArray) -> np.ndarray:
    """Nesting depths of JSON texts: the largest number of brackets open at
    once outside strings. Keys of any spelling do not matter."""
    for escaped in ("\\\\", '\\"'):
        texts = pc.replace_substring(texts, escaped, "")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    marks = _MARKS[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]]
    at = np.flatnonzero(marks)
    marks, bounds = marks[at], np.searchsorted(at, ends - ends[0])
    quote = marks == 2

    def since(total: np.ndarray) -> np.ndarray:
        """Running totals begun again at each text."""
        return total - np.repeat(np.append(0, total)[bounds[:-1]], np.diff(bounds))

    outside = ~quote & (since(np.cumsum(quote)) % 2 == 0)
    level = since(np.cumsum(np.where(outside, marks, 0)))
    depth, some = np.zeros(len(texts), np.int64), np.diff(bounds) > 0
    if some.any():
        depth[some] = np.maximum(np.maximum.reduceat(level, bounds[:-1][some]), 0)
    return depth


def leaf_paths(
    df: DataFrame,
    id_col: str,
    json_col: str,
    exclude: Iterable[str] = (),
    sep: str = "_",
    max_depth: int | None = None,
    depth: int | None = None,
    malformed: str = "mark",
    escape: bool = False,
) -> DataFrame:
    """``(id, path, value)`` for every scalar leaf of a JSON text column.

    Same traversal as ``flatten_positional`` but for documents without a
    known schema: object keys and array positions joined by ``sep``; keys in
    ``exclude`` skipped at every depth; empty objects/arrays give nothing;
    a JSON null gives a null value; values are the scalar's text. A NULL
    text has no leaves.

    Paths are for reading: a key that contains ``sep`` or looks like a
    position may give the path of another leaf. ``escape=True`` writes keys
    with a backslash before every backslash and ``sep`` in them, and
    positions in brackets; ``leaf_steps`` returns the path as an array.

    A text that does not parse (malformed, a key twice in one object, or
    larger than a VARIANT holds) comes back as one row with the path
    ``_corrupt_record`` and its whole text; ``malformed='fail'`` fails the
    job instead.

    The text is parsed once into VARIANT; each nesting level fans the
    objects and arrays still open out to their entries with one plain outer
    generator (all levels fuse into one codegen stage, no shuffle). The
    number of levels is the largest depth of any document: one pass over the
    text that returns one number. A caller who knows it passes ``depth`` to
    skip that pass; the plan then carries a guard that fails the job if any
    document is deeper. ``max_depth`` refuses deeper documents up front.
    """
    if malformed not in ("mark", "fail"):
        raise ValueError("malformed must be 'mark' or 'fail'")
    key, position = F.col("__k"), F.col("__p").cast("string")
    if escape:
        for special in ("\\", sep):
            key = F.replace(key, F.lit(special), F.lit("\\" + special))
        position = F.concat(F.lit("["), position, F.lit("]"))
    k = F.coalesce(key, position)
    # with ``escape`` a first key may be empty: the root is then told by NULL
    root = F.lit(None).cast("string") if escape else F.lit("")
    at_root = F.col("path").isNull() if escape else F.col("path") == ""
    longer = F.when(at_root, k).otherwise(F.concat_ws(sep, "path", k))
    leaves = _leaf_rows(df, id_col, json_col, exclude, root, longer, max_depth, depth, malformed == "fail")
    broken = F.col("raw").isNotNull()
    path = F.when(broken, F.lit(CORRUPT_PATH)).otherwise(F.coalesce("path", F.lit("")))
    return leaves.select(F.col("id").alias(id_col), path.alias("path"), F.coalesce("raw", "value").alias("value"))


STEPS = "array<struct<key: string, pos: int>>"


def leaf_steps(df: DataFrame, id_col: str, json_col: str, exclude: Iterable[str] = (), max_depth: int | None = None,
               depth: int | None = None) -> DataFrame:
    """F6 without ambiguity: ``(id, steps, kind, value)`` for every scalar
    leaf of a JSON text column.

    A step has a ``key`` (an object's) or a ``pos`` (an array's place), so no
    spelling of a key can look like another path. ``kind`` is the scalar's
    type (``VOID`` for a JSON null). A text that does not parse is one row
    with NULL steps and kind, which no leaf has, and the whole text as its
    value. Otherwise as ``leaf_paths``."""
    one = F.struct(F.col("__k").alias("key"), F.col("__p").alias("pos"))
    root = F.array().cast(STEPS)
    leaves = _leaf_rows(df, id_col, json_col, exclude, root, F.concat("path", F.array(one)), max_depth, depth, False)
    steps = F.when(F.col("raw").isNull(), F.col("path"))
    return leaves.select(F.col("id").alias(id_col), steps.alias("steps"), F.schema_of_variant("v").alias("kind"),
                         F.coalesce("raw", "value").alias("value"))


def documents_from_leaves(leaves: DataFrame, id_col: str, out: str = "doc") -> DataFrame:
    """``(id, out)``: JSON documents put together again from the rows of
    ``leaf_steps``; ids must tell documents apart.

    Keys come in their own order. An empty object or array has no leaf: it is
    gone from an object, and null where it was an element of an array, so
    that the others keep their places. A document that did not parse comes
    back as its text. Rows are shuffled once, by id, and sorted by path
    within it: what a leaf opens and closes then follows from the row before
    it, for all rows of an Arrow batch at once."""
    quoted = F.to_json(F.array("value"))
    text = F.when(F.col("kind") == "VOID", F.lit("null")).when(
        F.col("kind") == "STRING", F.substring(quoted, F.lit(2), F.length(quoted) - 2)).otherwise(F.col("value"))
    # a text or scalar that is a document of its own need not meet others of its id
    alone = F.when(F.coalesce(F.size("steps"), F.lit(0)) <= 0, F.xxhash64("value"))
    rows = leaves.select(col_of(id_col).alias("id"), "steps", text.alias("text"), alone.alias("alone"))
    rows = rows.repartition("id", "alone").sortWithinPartitions("id", "steps", "text").drop("alone")
    found = rows.mapInArrow(_documents, rows.select("id", "text").schema)
    return found.select(F.col("id").alias(id_col), F.col("text").alias(out))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents from ``(id, steps, text)`` in the order of ids and steps; the
    rows of a batch's last document wait for the next batch."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        before = waiting[-1].slice(waiting[-1].num_rows - 1) if waiting else batch.slice(0, 0)
        first = _first(pa.chunked_array([x.column("id") for x in (before, batch)]), pa.chunked_array([x.column("steps") for x in (before, batch)]))
        starts = np.flatnonzero(first[before.num_rows:])
        if len(starts):
            yield from _assembled([*waiting, batch.slice(0, starts[-1])])
            waiting, batch = [], batch.slice(starts[-1])
        waiting.append(batch)
    yield from _assembled(waiting)


def _first(ids: pa.ChunkedArray, steps: pa.ChunkedArray) -> np.ndarray:
    """Rows that begin a document: another id than the row before (null and
    NaN are ids, as in a grouping), or a whole document, which has no steps."""
    ids = ids.combine_chunks()
    old, new = ids.slice(0, max(len(ids) - 1, 0)), ids.slice(1)
    try:
        other = pc.fill_null(pc.not_equal(old, new), False).to_numpy(zero_copy_only=False)
        other = other | (old.is_valid().to_numpy(zero_copy_only=False) != new.is_valid().to_numpy(zero_copy_only=False))
        if pa.types.is_floating(ids.type):
            other &= ~pc.and_(pc.is_nan(old).fill_null(False), pc.is_nan(new).fill_null(False)).to_numpy(zero_copy_only=False)
    except pa.ArrowNotImplementedError:  # a struct, say
        other = np.array([a != b for a, b in zip(old.to_pylist(), new.to_pylist(), strict=True)], bool)
    whole = pc.fill_null(pc.list_value_length(steps), 0).to_numpy() == 0
    first = whole.copy()
    first[:1] = True
    first[1:] |= other | whole[:-1]
    return first


def _assembled(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of batches that hold all leaves of each of them."""
    rows = pa.Table.from_batches(batches) if batches else None
    if not rows:
        return
    first = _first(rows.column("id"), rows.column("steps"))
    ids, steps, text = (c.combine_chunks() for c in rows.columns)
    n, at = len(ids), steps.offsets.to_numpy().astype(np.int64)
    size, at, flat = np.diff(at), at - at[0], steps.flatten()
    key, pos = flat.field("key").dictionary_encode(), flat.field("pos")
    # a step as a number: a key's place in the dictionary, or -1 - pos
    code = np.where(key.is_valid(), pc.fill_null(key.indices, 0), -1 - pc.fill_null(pos, 0).to_numpy().astype(np.int64))

    # how many containers a row shares with the row before it, without the last step of either
    shared, same = np.zeros(n, np.int64), ~first
    for depth in range(size.max()):
        same[1:] &= (size[1:] > depth + 1) & (size[:-1] > depth + 1)
        i = np.flatnonzero(same)
        same[i] = code[at[i] + depth] == code[at[i - 1] + depth]
        shared += same
    row = np.repeat(np.arange(n), size)
    depth = np.arange(at[-1]) - at[row]
    # a step at the depth where rows part follows an entry, deeper ones open a container
    beside = (depth == shared[row]) & ~first[row]
    opens = depth >= shared[row]
    i = np.flatnonzero(beside)
    prior = code[at[row[i] - 1] + shared[row[i]]]
    mixed = row[i[(code[i] < 0) != (prior < 0)]]
    if len(mixed):  # repeated ids: where an array meets an object, the object stays
        stay = np.ones(n, bool)
        for r in mixed.tolist():
            before = r - 1
            while stay[before]:
                stay[before] = False
                if first[before] or shared[before] < shared[r]:
                    break
                before -= 1
        yield from _assembled(rows.filter(pa.array(stay)).to_batches())
        return
    skipped = np.where(code < 0, -1 - code, 0)
    skipped[i] = np.where((code[i] < 0) & (prior < 0), prior - code[i] - 1, 0)
    if (skipped < 0).any():
        raise ValueError("documents_from_leaves: two elements at one place of an array; ids must tell documents apart")
    stays = np.append(np.where(first[1:], -1, shared[1:]), -1)
    closes = depth > stays[row]

    # the text of each document: tokens of its rows, opening steps, value, closing brackets from the deepest
    names = ["", *(_json_string(k) + ":" for k in key.dictionary.to_pylist())]
    distinct, token = np.unique(((skipped * 2 + beside) * len(names) + np.maximum(code, -1) + 1)[opens], return_inverse=True)
    words = []
    for gap_mark, k in zip(*(x.tolist() for x in np.divmod(distinct, len(names))), strict=True):
        words.append(("," if gap_mark % 2 else "{" if k else "[") + "null," * (gap_mark // 2) + names[k])
    n_opens, n_closes = np.bincount(row[opens], minlength=n), np.bincount(row[closes], minlength=n)
    start = np.concatenate([[0], np.cumsum(n_opens + 1 + n_closes)])
    order = np.empty(start[-1], np.int64)
    order[start[row[opens]] + (depth - shared[row])[opens]] = n + token
    order[start[:-1] + n_opens] = np.arange(n)
    order[start[row[closes] + 1] - 1 - (depth - stays[row] - 1)[closes]] = n + len(words) + (code[closes] < 0)
    pieces = pa.concat_arrays([text.cast(pa.large_string()), pa.array([*words, "}", "]"], pa.large_string())]).take(pa.array(order))
    docs = pa.LargeListArray.from_arrays(pa.array(np.append(start[:-1][first], start[-1])), pieces)
    yield pa.RecordBatch.from_arrays([ids.filter(pa.array(first)), pc.binary_join(docs, pa.scalar("", pa.large_string())).cast(pa.string())], names=["id", "text"])


def _json_string(text: str) -> str:
    """As ``to_json`` writes it: other control characters in capitals."""
    return re.sub(r"\\(u....|.)", lambda m: m[0][:2] + m[0][2:].upper(), json.dumps(text, ensure_ascii=False))


def _leaf_rows(df: DataFrame, id_col: str, json_col: str, exclude: Iterable[str], root: Column, longer: Column,
               max_depth: int | None, depth: int | None, fail: bool) -> DataFrame:
    """``(id, path, raw, v, value)`` per leaf: ``root`` is the path of a whole
    document, ``longer`` the one of an entry (``__k`` its key or ``__p`` its
    place) below ``path``. ``raw`` is the text of a document without a
    value."""
    exclude = sorted(set(exclude))
    text = col_of(json_col)
    base = df.select(col_of(id_col).alias("id"), root.alias("path"), text.alias("raw"),
                     (F.parse_json(text) if fail else F.try_parse_json(text)).alias("v"))
    # the text goes on only where it has no value
    base = base.select("id", "path", F.when(F.col("v").isNull(), F.col("raw")).alias("raw"), "v")
    if depth is None:
        # a broken text may open any number of brackets: a document that
        # looks unusually deep counts only if it parses
        seen = df.select(text.cast("string").alias("t")).mapInArrow(_deep_texts, "d int, t string")
        real = F.when(F.col("t").isNull() | F.try_parse_json("t").isNotNull(), F.col("d"))
        planned = seen.agg(F.max(real).alias("d")).first()["d"] or 0
    else:
        planned = depth
    if max_depth is not None and planned > max_depth:
        raise ValueError(f"leaf_paths: documents nest deeper than max_depth={max_depth}")

    obj = F.try_variant_get("v", "$", "map<string,variant>")
    arr = F.try_variant_get("v", "$", "array<variant>")
    is_open = obj.isNotNull() | arr.isNotNull()

    def step(frontier: DataFrame) -> DataFrame:
        # One level: one plain outer generator (no lambdas, so it stays in
        # codegen). Objects fan out to (key, value), arrays to (position,
        # element); a scalar passes as one row and stays a leaf; an empty
        # object or array and a missing document yield nothing.
        entries = frontier.lateralJoin(frontier.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
        entries = entries.select(
            "id", "path", "raw", "v", F.col("key").alias("__k"), F.when(F.col("key").isNull(), F.col("pos")).alias("__p"), F.col("value").alias("__e")
        )
        # (a missing document -- SQL NULL, not JSON null -- is dropped at
        # the end, where the test cannot be pushed below the parse and make
        # Spark parse every document twice)
        scalar = F.col("__k").isNull() & F.col("__p").isNull()
        keep = ~(scalar & is_open)
        if exclude:
            keep = keep & ~(F.col("__k").isNotNull() & F.col("__k").isin(exclude))
        return entries.filter(keep).select(
            "id", F.when(scalar, F.col("path")).otherwise(longer).alias("path"), "raw",
            F.when(scalar, F.col("v")).otherwise(F.col("__e")).alias("v"),
        )

    frontier = base
    for _ in range(planned):
        frontier = step(frontier)
    # guard: anything still open here means the planned depth was too small
    value = F.when(
        is_open, F.raise_error(F.lit(f"leaf_paths: a document nests deeper than depth={planned}"))
    ).otherwise(F.col("v").cast("string"))
    return frontier.filter(F.col("v").isNotNull() | F.col("raw").isNotNull()).select("id", "path", "raw", "v", value.alias("value"))
