"""Registered queries: one per operator of the inventory, each over the
driver tables (or data Spark derives from them), with a DuckDB oracle.

Every query reads whole tables; nothing is sampled, capped or filtered to
keep a check cheap. ``preview_top`` keeps its limit because a top-k report
is the feature.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flatgate.functions.predicates import is_blank
from flatgate.functions.text import route_label, run_stamp
from flatgate.operators import columns as C
from flatgate.operators import flatten as FL
from flatgate.operators import quality as Q
from flatgate.operators import rules as R
from flatgate.operators.commits import CommitLog
from flatgate.operators.drift import schema_drift
from flatgate.operators.keep_first import KeepFirstStore
from flatgate.operators.ledger import COMPLETED, LEDGER_COLUMNS, LEDGER_SCHEMA, STARTED, Ledger, latest_per_key
from flatgate.operators.reasons import quarantine_reasons, with_identity
from flatgate.operators.report import report_html, report_table
from flatgate.operators.routing import route_counts, route_target, with_route
from flatgate.plans import fixtures as FX
from flatgate.plans.documents import write_json_docs, write_json_lines
from flatgate.plans.ingest import bad_rows, committed_rows, ingest_frame
from flatgate.plans.sql import sql_on
from flatgate.session import scratch_dir
from flatgate.sinks.files import read_csv, write_csv, write_good, write_quarantine, write_report
from flatgate.sources.arrivals import arrivals_audit
from flatgate.sources.json import corrupt_column, corrupt_rows, read_json_docs, read_json_lines
from flatgate.sources.json_split import read_json_docs_split

Query = Callable[[SparkSession, str], DataFrame]

# Fixed test parameters (not reference values).
ROUTE_LABELS_SOURCE = ("src1", "src2")
ROUTE_LABELS_PART = ("Promo", "Standard")
ROUTE_TARGETS = {"Promo": "promo_parts", "Standard": "standard_parts"}
FIXED_STAMP = "20240101000000"
EMBEDDING_WIDTH_SF001 = 64  # width of the embedding arrays at sf0.01 (oracle only)
CONV_PART = 4  # turns per conversation document (longer ones are several)


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return FX.table(spark, sf, name)


# ---------------------------------------------------------------------------
# flatten family
# ---------------------------------------------------------------------------


def q_flatten_prefixed(spark, sf):
    return FL.flatten(FX.orders_nested(spark, sf), prefix=True)


def q_flatten_plain(spark, sf):
    return FL.flatten(FX.orders_nested(spark, sf), prefix=False)


def q_flatten_structs(spark, sf):
    return FL.flatten_structs(FX.orders_with_customer(spark, sf))


def q_flatten_positional(spark, sf):
    flat = FL.flatten_positional(T(spark, sf, "embeddings"))
    return flat.selectExpr(
        *[f"CAST({FL.quote(c)} AS DOUBLE) AS {FL.quote(c)}" if c.startswith("embedding_") else FL.quote(c) for c in flat.columns]
    )


def q_flatten_positional_nested(spark, sf):
    return FL.flatten_positional(FX.conversations_nested(spark, sf, CONV_PART))


def q_leaf_paths(spark, sf):
    return FL.leaf_paths(T(spark, sf, "events"), "event_id", "props")


def _orders_json(spark, sf, max_items: int = FX.DEFAULT_MAX_ITEMS):
    """Orders as JSON text documents (ints and strings only). Of an order
    in several documents the first carries the order's own fields."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = T(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    li = T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    items = FX.nest_children(li, "o_orderkey", ["l_linenumber"], "items", max_items=max_items)
    cust = F.struct("c_name", F.struct("c_mktsegment", "c_nationkey").alias("seg"))
    # items are placed by order already: a window needs neither their lines again nor a join
    items = items.withColumn("lead", F.min("part").over(Window.partitionBy("o_orderkey")))
    first = F.col("part").isNull() | (F.col("part") == F.col("lead"))
    doc = F.struct(F.when(first, F.col("o_orderkey")).alias("o_orderkey"), F.when(first, cust).alias("cust"), "items")
    docs = (
        o.join(c, o.o_custkey == c.c_custkey, "left")
        .join(items, "o_orderkey", "left")
        .select("o_orderkey", F.to_json(doc).alias("doc"))
    )
    # the operators pass over the texts more than once: built once
    path = scratch_dir(spark, "order-docs")
    docs.write.parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def q_leaf_paths_nested(spark, sf, max_items: int = FX.DEFAULT_MAX_ITEMS):
    """Leaves of order documents; array positions, which depend on where a
    document was cut, are written as ``*``."""
    leaves = FL.leaf_paths(_orders_json(spark, sf, max_items), "o_orderkey", "doc")
    return leaves.withColumn("path", F.regexp_replace("path", r"^items_\d+_", "items_*_"))


def q_leaf_paths_malformed(spark, sf):
    """Leaves of events.props where every third event's text is cut short
    and every fifth has its key twice: those come back whole, marked."""
    cut = F.expr("left(props, length(props) - 1)")
    twice = F.expr("concat('{\"k\": 0, ', substring(props, 2))")
    ev = T(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, cut).when(F.col("event_id") % 5 == 0, twice).otherwise(F.col("props")).alias("props"))
    return FL.leaf_paths(ev, "event_id", "props")


def q_leaf_steps(spark, sf):
    """Unambiguous leaves of documents in which different leaves have one
    text path (a.b and a_b, key 0 and place 0) and a key is called like the
    mark of broken texts; every fourth text is cut short."""
    doc = F.to_json(F.struct(
        F.struct(F.col("event_id").alias("b"), F.array("event_type").alias("0")).alias("a"), F.col("event_type").alias("a_b"),
        F.struct(F.struct(F.col("user_id").alias("0")).alias("0")).alias("a_0"), F.col("user_id").alias("_corrupt_record")))
    text = F.when(F.col("event_id") % 4 == 0, F.expr("left(doc, length(doc) - 1)")).otherwise(F.col("doc"))
    ev = T(spark, sf, "events").select("event_id", doc.alias("doc")).select("event_id", text.alias("doc"))
    steps = F.transform("steps", lambda s: F.coalesce(F.concat(F.lit("."), s["key"]), F.concat(F.lit("["), s["pos"].cast("string"), F.lit("]"))))
    return FL.leaf_steps(ev, "event_id", "doc").select("event_id", F.array_join(steps, "").alias("steps"), "kind", "value")


def q_leaf_paths_rebuilt(spark, sf):
    """Order documents and events.props taken apart into leaves and put
    together again; every seventh event's text is cut short."""
    props = F.when(F.col("event_id") % 7 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    ev = T(spark, sf, "events").select(F.concat(F.lit("e"), "event_id").alias("id"), props.alias("doc"))
    od = _orders_json(spark, sf).select(F.concat(F.lit("o"), "o_orderkey").alias("id"), "doc")
    return FL.documents_from_leaves(FL.leaf_steps(ev.unionByName(od), "id", "doc"), "id")


def q_corrupt_rows_own_field(spark, sf):
    """Events as JSON lines that have a field called like the mark; every
    'error' event's line does not parse. All rows, the mark beside the
    field."""
    ev = T(spark, sf, "events")
    line = F.to_json(F.struct("event_id", F.col("event_type").alias("_corrupt_record")))
    text = F.when(F.col("event_type") == "error", F.expr("left(j, length(j) - 1)")).otherwise(F.col("j"))
    path = scratch_dir(spark, "corrupt")
    ev.select(line.alias("j"), "event_type").select(text.alias("value")).write.text(path)
    back = read_json_lines(spark, path, schema="event_id bigint, _corrupt_record string", keep_corrupt=True)
    return back.withColumnRenamed(corrupt_column(back), "broken")


DRIFT_SCHEMA = "id bigint, kind string, size bigint, user struct<id: bigint, age: double>, tags array<string>"


def q_schema_drift(spark, sf):
    """Events as JSON documents in five arrivals. Arrival 0 has the stored
    schema; 1 adds a field and an object; 2 lacks two; in 3 sizes are
    fractions and ages whole; in 4 ids are text, users a number, every tag a
    number or an object, and some documents cut short."""
    ev = T(spark, sf, "events").withColumn("arrival", F.col("event_id") % 5)
    num = F.col("event_id").cast("string")
    quoted = F.concat(F.lit('"'), num, F.lit('"'))

    def doc(*fields):
        return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in fields]), F.lit("}"))

    kind = F.concat(F.lit('"'), "event_type", F.lit('"'))
    user = doc(("id", num), ("age", F.lit("1.5e1")))
    tags = F.concat(F.lit("["), kind, F.lit(',"x"]'))
    base = {"id": num, "kind": kind, "size": num, "user": user, "tags": tags}
    shapes = [
        base, {**base, "extra": F.lit("true"), "more": doc(("a.b", num))}, {k: base[k] for k in ("id", "kind", "size", "tags")},
        {**base, "size": F.lit("2.5e0"), "user": doc(("id", num), ("age", F.lit("15")))},
        {**base, "id": quoted, "user": num, "tags": F.when(F.col("event_id") % 2 == 0, F.lit("[7]")).otherwise(F.lit('[{"t":null}]'))}]
    text_of = F.when(F.lit(False), F.lit(""))
    for i, shape in enumerate(shapes):
        text_of = text_of.when(F.col("arrival") == i, doc(*shape.items()))
    docs = ev.select("arrival", "event_id", text_of.alias("doc"))
    broken = (F.col("arrival") == 4) & (F.col("event_id") % 3 == 0)
    docs = docs.select("arrival", F.when(broken, F.lit("{")).otherwise(F.col("doc")).alias("doc"))
    return schema_drift(docs, "doc", "arrival", spark.createDataFrame([], DRIFT_SCHEMA).schema)


def q_flatten_zipped(spark, sf):
    """Conversation documents with sibling arrays (roles, texts of user turns
    only, turns as structs): siblings advance together."""
    docs = FX.conversations_nested(spark, sf, CONV_PART)
    users = F.filter("t", lambda x: x["role"] == "user")
    arrays = F.struct(F.transform("t", lambda x: x["role"]).alias("roles"), F.transform(users, lambda x: x["text"]).alias("said"),
                      F.transform("t", lambda x: F.struct(x["turn"].alias("turn"))).alias("at"))
    return FL.flatten_zipped(docs.select("conv_id", "part", arrays.alias("d")))


def q_arrivals_audit(spark, sf):
    """D7 from the listing: documents arrive as JSON, a folder per source;
    one folder's only file is empty, one source is not expected, and the
    last five expected ones are missing. Sizes depend on the writer, so what
    is compared is whether there are any."""
    docs = T(spark, sf, "documents").select("doc_id", "source")
    path = scratch_dir(spark, "arrivals")
    docs.write.partitionBy("source").json(path)
    spark.createDataFrame([], "value string").write.text(f"{path}/source=nothing")
    n = docs.select(F.countDistinct("source").alias("n"))
    expected = n.select(F.explode(F.sequence(F.lit(1), F.col("n") + 4)).alias("i")).select(
        F.concat(F.lit("source=src"), F.col("i").cast("string")).alias("file_name"))
    expected = expected.unionByName(spark.createDataFrame([("source=nothing",)], "file_name string"))
    audit = arrivals_audit(spark, path, expected, level=2)
    return audit.select("file_name", "status", (F.col("n_files") > 0).alias("arrived"), (F.col("bytes") > 0).alias("has_content"))


def q_dedup_incremental(spark, sf):
    """F9 across jobs: documents in three arrivals by their ids' remainders;
    later ones bring copies with smaller ids, which replace kept rows."""
    docs = T(spark, sf, "documents")
    store = KeepFirstStore(spark, scratch_dir(spark, "kept"), ["text"], ["doc_id"], buckets=16)
    arrivals = docs.withColumn("arrival", F.lit(3) - F.pmod(F.col("doc_id"), F.lit(3)))
    for i in (1, 2, 3):
        store.add(arrivals.filter(F.col("arrival") == i).drop("arrival"), f"arrival-{i}")
    return store.rows()


def q_explode_estimate(spark, sf):
    nested = FX.orders_nested(spark, sf)
    return nested.agg(F.sum(FL.explode_estimate_expr(nested)).alias("rows"))


def q_merge_fingerprint(spark, sf):
    docs = C.merge_array_field(FX.conversations_nested(spark, sf, CONV_PART), "t", "role", "fingerprint")
    return docs.select("conv_id", "part", "fingerprint")


def q_merge_columns(spark, sf):
    flat = FL.flatten_positional(FX.conversations_nested(spark, sf, CONV_PART))
    merged = C.merge_columns(flat, r"t_\d+_role", "fingerprint")
    return merged.select("conv_id", "part", "fingerprint")


def q_fingerprint_first_seen(spark, sf):
    """Pipeline D over conversation documents: role fingerprint per
    document, keep (conv_id, part, fingerprint), first document per
    fingerprint."""
    from flatgate.plans.positional import positional_report

    docs = FX.conversations_nested(spark, sf, CONV_PART)
    return positional_report(docs, r"t_\d+_role", "fingerprint", ["conv_id", "part"], ["fingerprint"],
                             ["conv_id", "part"])


def q_dedup_keep_first(spark, sf):
    return C.dedup_keep_first(T(spark, sf, "documents"), ["text"], ["doc_id"])


def q_dedup_null_order(spark, sf):
    """First order per customer by a status that is NULL for some."""
    o = FX.orders_nulls(spark, sf).select("o_custkey", "st", "o_orderkey", "pr")
    return C.dedup_keep_first(o, ["o_custkey"], ["st", "o_orderkey"])


def q_keep_known(spark, sf):
    return C.keep_known(T(spark, sf, "orders"), ["o_totalprice", "o_orderkey", "no_such_column", "o_orderdate"])


def q_stamp_job(spark, sf):
    return Q.stamp(T(spark, sf, "orders").select("o_orderkey"), job_id="job_" + FIXED_STAMP)


def q_preview_top(spark, sf):
    return C.preview(T(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100)


# ---------------------------------------------------------------------------
# row-level quality
# ---------------------------------------------------------------------------


def q_null_flag(spark, sf):
    return Q.null_flag(FX.orders_nulls(spark, sf).select("o_orderkey", "st"), ["st"])


def q_quarantine_rows(spark, sf):
    _good, bad = Q.split_good_bad(FX.orders_nulls(spark, sf).select("o_orderkey", "st", "pr"), "st")
    return bad


def q_good_rows(spark, sf):
    good, _bad = Q.split_good_bad(FX.orders_nulls(spark, sf).select("o_orderkey", "st", "pr"), "st")
    return good


def q_run_metrics(spark, sf):
    return Q.run_metrics(FX.orders_nulls(spark, sf), "st")


def q_blank_filter(spark, sf):
    return Q.blank_filter(FX.orders_nulls(spark, sf).select("o_orderkey", "pr"), "pr")


def q_is_blank_count(spark, sf):
    o = FX.orders_nulls(spark, sf)
    return o.agg(
        F.count_if(is_blank("pr")).alias("blank_pr"),
        F.count_if(is_blank("st")).alias("blank_st"),
    )


# ---------------------------------------------------------------------------
# rules
# ---------------------------------------------------------------------------

RESULT_COLS = ["rule_id", "rule_type", "status", "pass_count", "fail_count", "total_count"]


def _orders_rules(sf: str) -> list[R.Rule]:
    return [
        R.Rule(1, "status present", R.NOT_NULL, "status must be set", columns=("st",), dq_id=101),
        R.Rule(2, "priority present", R.NOT_NULL, "priority must not be blank", columns=("pr",), dq_id=101),
        R.Rule(3, "status and priority", R.NOT_NULL, None, columns=("st", "pr"), dq_id=101),
        R.Rule(4, "order key", R.UNIQUE, "primary key", columns=("o_orderkey",), dq_id=101),
        R.Rule(5, "customer", R.UNIQUE, "one order per customer", columns=("o_custkey",), dq_id=101),
        R.Rule(6, "orders have lines", R.QUERY, "every order has lineitems", query=_no_lines_sql(sf), dq_id=101),
        R.Rule(7, "key and status", R.UNIQUE, None, columns=("o_orderkey", "st"), dq_id=101),
    ]


def _no_lines_sql(sf: str) -> str:
    return (
        "SELECT t.o_orderkey FROM temp t "
        f"LEFT JOIN (SELECT DISTINCT l_orderkey FROM parquet.`{sf.rstrip('/')}/lineitem.parquet`) l "
        "ON l.l_orderkey = t.o_orderkey WHERE l.l_orderkey IS NULL"
    )


def q_rule_not_null(spark, sf):
    return R.rule_not_null(FX.orders_nulls(spark, sf), ["st", "pr"]).select(*RESULT_COLS)


def q_rule_unique(spark, sf):
    return R.rule_unique(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).select(*RESULT_COLS)


def _rule_access(sf: str) -> R.Access:
    return R.Access(paths=(f"{sf.rstrip('/')}/lineitem.parquet",))


def q_rule_query(spark, sf):
    return R.rule_query(T(spark, sf, "orders"), _no_lines_sql(sf), access=_rule_access(sf)).select(*RESULT_COLS)


def _report(spark, sf):
    return R.run_rules(FX.orders_nulls(spark, sf), _orders_rules(sf), access=_rule_access(sf))


def q_rules_report(spark, sf):
    return _report(spark, sf).select("dq_id", "rule_name", *RESULT_COLS, "pass_count_valid")


def q_rules_failed(spark, sf):
    return R.failed(_report(spark, sf)).select("rule_id", "fail_count")


def q_rules_verdict(spark, sf):
    return R.verdict(_report(spark, sf))


HTML_RULES = [
    R.Rule(1, "status present", R.NOT_NULL, "status must be set", columns=("st",), dq_id=101),
    R.Rule(2, "order key", R.UNIQUE, "primary key", columns=("o_orderkey",), dq_id=101),
    R.Rule(3, "big orders", R.QUERY, "no order above 400000",
           query="SELECT * FROM temp WHERE o_totalprice > 400000", dq_id=101),
]


def q_rules_html(spark, sf):
    """D10 with a fixed application id and run time, so the page is
    deterministic and checkable against SQL."""
    results = R.run_rules(FX.orders_nulls(spark, sf), HTML_RULES, app_id="flatgate")
    return report_html(results, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def q_report_table(spark, sf):
    """D8 over the orders' rules."""
    return report_table(R.run_rules(FX.orders_nulls(spark, sf), _orders_rules(sf), app_id="flatgate", access=_rule_access(sf))).drop("columns_or_query")


FUSED_RULES = [
    R.Rule(1, "big orders", R.QUERY, query="SELECT * FROM temp WHERE o_totalprice > 400000"),
    R.Rule(2, "late and urgent", R.QUERY, query="SELECT o_orderkey FROM temp WHERE upper(o_orderpriority) LIKE '1-%' AND year(o_orderdate) >= 1997;"),
    R.Rule(3, "no status", R.QUERY, query="SELECT temp.o_orderkey AS k, 'x' AS why FROM temp WHERE temp.st IS NULL OR trim(pr) = ''"),
    R.Rule(4, "all orders", R.QUERY, query="SELECT * FROM temp"),
    R.Rule(5, "status present", R.NOT_NULL, columns=("st",)),
    R.Rule(6, "customers", R.QUERY, query="SELECT DISTINCT o_custkey FROM temp WHERE o_totalprice > 400000"),
    R.Rule(7, "orders have lines", R.QUERY,
           query="SELECT t.o_orderkey FROM temp t LEFT ANTI JOIN lines l ON l.l_orderkey = t.o_orderkey WHERE t.st IS NOT NULL"),
    R.Rule(8, "of known customers", R.QUERY, query="SELECT * FROM temp WHERE o_custkey NOT IN (SELECT c_custkey FROM customers)"),
    R.Rule(9, "a third", R.QUERY, query="SELECT * FROM temp WHERE pmod(o_orderkey, 3) = 0"),
]


def q_rules_fused_queries(spark, sf):
    """Nine rules, five of them conditions on rows: those share the not-null
    scan, the others run by themselves over declared tables."""
    access = R.Access(tables={"lines": T(spark, sf, "lineitem"), "customers": T(spark, sf, "customer")})
    return R.run_rules(FX.orders_nulls(spark, sf), FUSED_RULES, access=access).select("rule_name", *RESULT_COLS)


def q_report_page(spark, sf):
    """K5: the page as it stands in the written folder."""
    path = scratch_dir(spark, "page")
    write_report(q_rules_html(spark, sf), path)
    return spark.read.text(path, wholetext=True).select("dq_id", F.rtrim(F.col("value"), F.lit("\n")).alias("html"))


REPEATED_IDS = [
    R.Rule(1, "status present", R.NOT_NULL, columns=("st",), dq_id=1),
    R.Rule(1, "priority present", R.NOT_NULL, columns=("pr",), dq_id=2),
    R.Rule(1, "order key", R.UNIQUE, columns=("o_orderkey",), dq_id=2),
    R.Rule(1, "customer", R.UNIQUE, columns=("o_custkey",), dq_id=1),
    R.Rule(1, "big orders", R.QUERY, query="SELECT * FROM temp WHERE o_totalprice > 400000", dq_id=1),
    R.Rule(1, "all orders", R.QUERY, query="SELECT * FROM temp", dq_id=2),
]


def q_rules_repeated_ids(spark, sf):
    """Rules that share their id, within and across rule sets."""
    results = R.run_rules(FX.orders_nulls(spark, sf), REPEATED_IDS)
    return results.select("dq_id", "rule_name", *RESULT_COLS)


def q_missing_keys(spark, sf):
    return R.missing_keys(T(spark, sf, "orders").select("o_orderkey"), "o_orderkey", T(spark, sf, "lineitem"), "l_orderkey")


def q_missing_files(spark, sf):
    """D7 on file names: documents written as JSON partitioned by source
    (one ``source=<name>`` folder per arriving source), read back with the
    file path carried as a column; expected are ``src0`` .. ``src<n+4>``
    for n distinct sources, so the last five are reported missing."""
    docs = T(spark, sf, "documents").select("doc_id", "source")
    path = scratch_dir(spark, "files")
    docs.write.partitionBy("source").json(path)
    back = read_json_lines(spark, path, schema="doc_id bigint", with_source=True)
    # one expected name per distinct source and five more, as a frame
    n = docs.select(F.countDistinct("source").alias("n"))
    expected = n.select(F.explode(F.sequence(F.lit(0), F.col("n") + 4)).alias("i")).select(
        F.concat(F.lit("source=src"), F.col("i").cast("string")).alias("file_name"))
    return R.expected_files_missing(back, expected, level=2)


# ---------------------------------------------------------------------------
# SQL surface reached through the query rule
# ---------------------------------------------------------------------------


def q_sql_union_distinct(spark, sf):
    o = T(spark, sf, "orders")
    return sql_on(o, "SELECT o_orderstatus AS s FROM temp UNION SELECT o_orderpriority AS s FROM temp")


def q_sql_distinct(spark, sf):
    return sql_on(T(spark, sf, "lineitem"), "SELECT DISTINCT l_returnflag, l_linestatus FROM temp")


def q_sql_split_reverse(spark, sf):
    return sql_on(
        T(spark, sf, "part"), "SELECT p_partkey, get(reverse(split(p_name, ' ')), 0) AS last_word FROM temp"
    )


def q_sql_left_join_null(spark, sf):
    return sql_on(
        T(spark, sf, "orders"),
        "WITH keys AS (SELECT DISTINCT l_orderkey FROM parquet.`" + sf.rstrip("/") + "/lineitem.parquet`)\n"
        "SELECT t.o_orderkey FROM temp t LEFT JOIN keys k ON k.l_orderkey = t.o_orderkey WHERE k.l_orderkey IS NULL",
    )


# ---------------------------------------------------------------------------
# ledger, stamps, routing
# ---------------------------------------------------------------------------


def q_latest_per_key(spark, sf):
    return latest_per_key(T(spark, sf, "events"), "user_id", "ts")


def q_latest_null_order(spark, sf):
    """Latest order per customer by a key that is NULL for some."""
    o = FX.orders_nulls(spark, sf).select(
        "o_custkey", F.when(F.col("st").isNotNull(), F.col("o_totalprice")).alias("price"), "o_orderkey", "st")
    return latest_per_key(o, "o_custkey", ["price", "o_orderkey"])


def q_ledger_run(spark, sf):
    """A job's ledger rows through ``start`` and ``finish``, its counts from
    the orders; times as wall clock of the session's zone."""
    counts = Q.run_metrics(FX.orders_nulls(spark, sf), "st").first()
    ledger = Ledger(spark, scratch_dir(spark, "ledger"))
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    ledger.start("job_" + FIXED_STAMP, "orders", None, "orders", "quarantine/", at=at)
    ledger.finish("job_" + FIXED_STAMP, counts["total_record_count"], counts["load_record_count"],
                  counts["error_record_count"], "quarantine/", at=at + dt.timedelta(hours=1))
    current = ledger.current().drop("seq")
    return current.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("job_start_time", "job_end_time")})


def q_ledger_events(spark, sf):
    """Each documents source is a job: STARTED with its total, COMPLETED
    with loaded (labelled) and error (unlabelled) counts; the ledger is
    written (append) and its current view read back."""
    docs = T(spark, sf, "documents").select("doc_id", "source")
    labels = T(spark, sf, "labels").select("doc_id", F.lit(True).alias("labelled"))
    per_job = docs.join(labels, "doc_id", "left").groupBy("source").agg(
        F.count(F.lit(1)).alias("total"), F.count("labelled").alias("loaded")
    )
    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp")
    t1 = F.lit("2024-01-01 01:00:00").cast("timestamp")
    types = {f.name: f.dataType for f in StructType.fromDDL(LEDGER_SCHEMA)}

    def event(**fields):
        return per_job.select(*[fields.get(c, F.lit(None)).cast(types[c]).alias(c) for c in LEDGER_COLUMNS])

    started = event(
        seq=F.lit(1), job_id=F.col("source"), job_description=F.lit("documents"), total_record_count=F.col("total"),
        load_record_count=F.lit(0), error_record_count=F.lit(0), job_start_time=t0, job_end_time=t0,
        source_path=F.lit("documents"), status=F.lit(STARTED))
    finished = event(
        seq=F.lit(2), job_id=F.col("source"), total_record_count=F.col("total"), load_record_count=F.col("loaded"),
        error_record_count=F.col("total") - F.col("loaded"), job_end_time=t1,
        dq_file_path=F.concat(F.lit("quarantine/job_id="), F.col("source")), status=F.lit(COMPLETED))
    ledger = Ledger(spark, scratch_dir(spark, "ledger"))
    started.unionByName(finished).write.mode("append").parquet(ledger.path)
    cur = ledger.current().drop("seq")
    # ledger times are instants; report them as wall-clock (session zone)
    return cur.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("job_start_time", "job_end_time")})


def q_run_stamp(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", run_stamp("o_orderdate").alias("stamp"))


def q_route_label(spark, sf):
    return T(spark, sf, "documents").select("doc_id", route_label("source", ROUTE_LABELS_SOURCE).alias("route"))


def q_route_counts(spark, sf):
    return route_counts(T(spark, sf, "documents"), "source", ROUTE_LABELS_SOURCE, FIXED_STAMP)


def q_route_target(spark, sf):
    p = with_route(T(spark, sf, "part").select("p_partkey", "p_type"), "p_type", ROUTE_LABELS_PART)
    return route_target(p, "route", ROUTE_TARGETS).select("p_partkey", "route", "target_table")


# ---------------------------------------------------------------------------
# sources and sinks (round trips through the shared scratch folder)
# ---------------------------------------------------------------------------


def q_json_lines_roundtrip(spark, sf):
    nested = FX.orders_nested(spark, sf)
    path = scratch_dir(spark, "jsonl")
    write_json_lines(nested, path)
    back = read_json_lines(spark, path, schema=nested.schema)
    return FL.flatten(back, prefix=True)


def q_json_docs_roundtrip(spark, sf):
    nested = FX.orders_nested(spark, sf)
    path = scratch_dir(spark, "jsondocs")
    write_json_docs(nested, path)
    back = read_json_docs(spark, path, schema=nested.schema)
    return FL.flatten(back, prefix=True)


def q_json_docs_split(spark, sf):
    """The same documents, each file read by as many tasks as it has ranges."""
    nested = FX.orders_nested(spark, sf)
    path = scratch_dir(spark, "jsonsplit")
    write_json_docs(nested, path)
    return FL.flatten(read_json_docs_split(spark, path, nested.schema), prefix=True)


def q_doc_to_csv(spark, sf):
    """Pipeline B: nested orders as JSON documents -> prefixed flatten ->
    CSV (append) -> read back with the flat schema."""
    from flatgate.plans.documents import json_docs_to_csv

    nested = FX.orders_nested(spark, sf)
    docs, out = scratch_dir(spark, "b-docs"), scratch_dir(spark, "b-csv")
    write_json_docs(nested, docs)
    flat = json_docs_to_csv(spark, docs, out, schema=nested.schema)
    return read_csv(spark, out, schema=flat.schema)


def q_corrupt_rows(spark, sf):
    """Events as JSON lines; every 'error' event's line is cut short by one
    character, so it no longer parses."""
    ev = T(spark, sf, "events")
    line = F.to_json(F.struct("event_id", "event_type"))
    text = F.when(F.col("event_type") == "error", F.expr("substring(j, 1, length(j) - 1)")).otherwise(F.col("j"))
    path = scratch_dir(spark, "corrupt")
    ev.select(line.alias("j"), "event_type").select(text.alias("value")).write.text(path)
    back = read_json_lines(spark, path, schema="event_id bigint, event_type string", keep_corrupt=True)
    return corrupt_rows(back)


def q_csv_roundtrip(spark, sf):
    docs = T(spark, sf, "documents")
    path = scratch_dir(spark, "csv")
    write_csv(docs, path, mode="overwrite")
    return read_csv(spark, path, schema=docs.schema)


def q_quarantine_csv_roundtrip(spark, sf):
    bad = Q.null_flag(FX.orders_nulls(spark, sf).select("o_orderkey", "st", "pr"), "st").filter("null_check_result")
    bad = bad.withColumn("job_id", F.lit("job_" + FIXED_STAMP))
    path = scratch_dir(spark, "quarantine")
    write_quarantine(bad, path)
    return read_csv(spark, path, schema="o_orderkey bigint, st string, pr string, null_check_result boolean")


def q_dynamic_overwrite(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = scratch_dir(spark, "dynamic")
    write_good(o, path, partition_by=["o_orderstatus"])
    changed = o.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", -F.col("o_totalprice"))
    write_good(changed, path, partition_by=["o_orderstatus"])  # replaces status=F only
    return spark.read.parquet(path)


def q_ingest_metrics(spark, sf):
    """The flagship pipeline: nested orders -> flatten -> null flag on
    ``st`` -> one parquet write + quarantine CSV; returns the run counts."""
    res = ingest_frame(FX.orders_nested(spark, sf), ["st"], scratch_dir(spark, "ingest"), "job_" + FIXED_STAMP)
    return spark.createDataFrame(
        [(res.total, res.loaded, res.errors)],
        "total_record_count bigint, load_record_count bigint, error_record_count bigint",
    )


def q_rules_after_ingest(spark, sf):
    """Pipelines A then C: ingest nested orders, then run rules of all
    three types over the rows the ingest wrote."""
    from flatgate.plans.quality_report import ingested_rows, quality_report

    root = scratch_dir(spark, "ingest-c")
    ingest_frame(FX.orders_nested(spark, sf), ["st"], root, "job_" + FIXED_STAMP, prefix=True)
    rules = [
        R.Rule(1, "status", R.NOT_NULL, columns=("st",), dq_id=7),
        R.Rule(2, "line key", R.UNIQUE, columns=("o_orderkey", "items_l_linenumber"), dq_id=7),
        R.Rule(3, "big lines", R.QUERY, query="SELECT * FROM temp WHERE items_l_quantity > 45", dq_id=7),
    ]
    res = quality_report(ingested_rows(spark, root, "job_" + FIXED_STAMP), rules, scratch_dir(spark, "report"))
    return res.select(*RESULT_COLS)


def q_ingest_quarantine(spark, sf):
    root = scratch_dir(spark, "ingest")
    nested = FX.orders_nested(spark, sf)
    ingest_frame(nested, ["st"], root, "job_" + FIXED_STAMP, prefix=True)
    schema = Q.null_flag(FL.flatten(nested, prefix=True), ["st"]).schema
    return read_csv(spark, f"{root}/quarantine", schema=schema).select(
        "o_orderkey", "items_l_linenumber", "null_check_result"
    )


# ---------------------------------------------------------------------------
# streaming
# ---------------------------------------------------------------------------


def q_committed_rows(spark, sf):
    """Orders arrive in two jobs; the first fails after its rows are
    written and comes again under a new id. Published are the rows of the
    jobs that finished, so every good order once."""
    o = FX.orders_nulls(spark, sf).select("o_orderkey", "st", "pr")
    halves = [o.filter(F.col("o_orderkey") % 2 == i) for i in (0, 1)]
    root = scratch_dir(spark, "published")
    log = CommitLog(spark, scratch_dir(spark, "log"), every=4)
    log.start("job_a", "orders", None, "orders", "quarantine/")
    ingest_frame(halves[0], ["st"], root, "job_a")
    log.fail("job_a")
    ingest_frame(halves[1], ["st"], root, "job_b", ledger=log)
    ingest_frame(halves[0], ["st"], root, "job_c", ledger=log)
    return committed_rows(spark, root, log)


def q_ledger_snapshots(spark, sf):
    """The published jobs' counts by the log, some of its events in a
    snapshot, some after it: one job per order status."""
    o = FX.orders_nulls(spark, sf).select("o_orderkey", "o_orderstatus", "pr")
    log = CommitLog(spark, scratch_dir(spark, "log"), every=3)
    root = scratch_dir(spark, "published")
    for status in ("F", "O", "P"):
        frame = o.filter(F.col("o_orderstatus") == status).withColumn("pr", F.when(F.trim("pr") != "", F.col("pr")))
        ingest_frame(frame, ["pr"], root, f"job_{status}", ledger=log)
    counts = ("total_record_count", "load_record_count", "error_record_count")
    return log.current().select("seq", "job_id", "status", *counts)


REASON_RULES = [
    R.Rule(11, "status", R.NOT_NULL, columns=("st",)), R.Rule(12, "customer", R.UNIQUE, columns=("o_custkey",)),
    R.Rule(13, "priority", R.NOT_NULL, columns=("pr", "st")), R.Rule(14, "big", R.QUERY, query="SELECT * FROM temp WHERE o_totalprice > 400000"),
    R.Rule(15, "customer, status", R.UNIQUE, columns=("st", "o_custkey")), R.Rule(16, "order", R.UNIQUE, columns=("o_orderkey",)),
]


def q_quarantine_reasons(spark, sf):
    """Orders as an ingest job wrote them: every row that fails a rule, with
    the rules it fails."""
    o = FX.orders_nulls(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", "st", "pr")
    root = scratch_dir(spark, "reasons")
    ingest_frame(o, ["st"], root, "job_" + FIXED_STAMP)
    rows = with_identity(spark.read.schema(o.schema).parquet(f"{root}/rows/job_id=job_{FIXED_STAMP}"))
    bad = quarantine_reasons(rows.drop("null_check_result"), REASON_RULES)
    ids = F.array_join(F.transform("failed_rules", lambda r: r["rule_id"].cast("string")), ",")
    return bad.select("o_orderkey", "st", "pr", ids.alias("failed_rules"))


UNIQUE_RULES = [
    R.Rule(1, "order key", R.UNIQUE, columns=("o_orderkey",)),
    R.Rule(2, "customer", R.UNIQUE, columns=("o_custkey",)),
    R.Rule(3, "customer, status", R.UNIQUE, columns=("st", "o_custkey")),
    R.Rule(4, "customer again", R.UNIQUE, columns=("o_custkey",)),
]


def q_stream_unique_rule(spark, sf):
    """D2 across batches: orders arrive as files, one a batch; the rules
    hold over all of them together."""
    from flatgate.streaming.files import stream_files
    from flatgate.streaming.unique import stream_unique_rules, unique_results

    orders = FX.orders_nulls(spark, sf).select("o_orderkey", "o_custkey", "st")
    arrivals, out = scratch_dir(spark, "arrivals"), scratch_dir(spark, "unique")
    orders.repartition(4).write.parquet(arrivals)
    s = stream_files(spark, arrivals, orders.schema, "parquet", max_files_per_trigger=1)
    stream_unique_rules(s, UNIQUE_RULES, out, scratch_dir(spark, "stream-ckpt")).awaitTermination()
    return unique_results(spark, out, UNIQUE_RULES).select(*RESULT_COLS)


def q_stream_events(spark, sf):
    from flatgate.streaming.files import stream_files, stream_to_parquet

    schema = T(spark, sf, "events").schema
    s = stream_files(spark, sf, schema, "parquet", pathGlobFilter="events.parquet")
    out = scratch_dir(spark, "stream-out")
    q = stream_to_parquet(s, out, scratch_dir(spark, "stream-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out)


def q_stream_quarantine(spark, sf):
    from flatgate.streaming.files import stream_files, stream_ingest

    schema = T(spark, sf, "orders").schema
    s = stream_files(spark, sf, schema, "parquet", pathGlobFilter="orders.parquet").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("st")
    )
    root = scratch_dir(spark, "stream-ingest")
    q = stream_ingest(s, ["st"], root, scratch_dir(spark, "stream-ckpt"))
    q.awaitTermination()
    return bad_rows(spark, root).select("o_orderkey", "st", "null_check_result")


#: Orders and their lines in a file that arrives, about.
ARRIVAL_ROWS = 500_000


def q_stream_json_ledger(spark, sf):
    """T1 and T2 over nested JSON lines: orders arrive as files, each
    micro-batch is flattened, flagged and recorded; returns the ledger's
    totals over all batches."""
    from flatgate.streaming.files import stream_ingest, stream_json

    nested = FX.orders_nested(spark, sf)
    arrivals = scratch_dir(spark, "arrivals")
    # arrivals of bounded size, however large the tables; half of them a batch
    rows = T(spark, sf, "orders").count() + T(spark, sf, "lineitem").count()
    files = max(4, -(-rows // ARRIVAL_ROWS))
    nested.repartition(files).write.json(arrivals)
    ledger = Ledger(spark, scratch_dir(spark, "stream-ledger"))
    s = stream_json(spark, arrivals, nested.schema, maxFilesPerTrigger=-(-files // 2))
    q = stream_ingest(s, ["st"], scratch_dir(spark, "stream-rows"), scratch_dir(spark, "stream-ckpt"), prefix=True, ledger=ledger)
    q.awaitTermination()
    done = ledger.current().filter(F.col("status") == COMPLETED)
    return done.agg(*[F.sum(c).alias(c) for c in ("total_record_count", "load_record_count", "error_record_count")])


QUERIES: dict[str, Query] = {
    "flatten_prefixed": q_flatten_prefixed,
    "flatten_plain": q_flatten_plain,
    "flatten_structs": q_flatten_structs,
    "flatten_positional": q_flatten_positional,
    "flatten_positional_nested": q_flatten_positional_nested,
    "leaf_paths": q_leaf_paths,
    "leaf_paths_nested": q_leaf_paths_nested,
    "leaf_paths_malformed": q_leaf_paths_malformed,
    "leaf_steps": q_leaf_steps,
    "leaf_paths_rebuilt": q_leaf_paths_rebuilt,
    "schema_drift": q_schema_drift,
    "explode_estimate": q_explode_estimate,
    "flatten_zipped": q_flatten_zipped,
    "arrivals_audit": q_arrivals_audit,
    "dedup_incremental": q_dedup_incremental,
    "merge_fingerprint": q_merge_fingerprint,
    "merge_columns": q_merge_columns,
    "dedup_keep_first": q_dedup_keep_first,
    "dedup_null_order": q_dedup_null_order,
    "fingerprint_first_seen": q_fingerprint_first_seen,
    "keep_known": q_keep_known,
    "stamp_job": q_stamp_job,
    "preview_top": q_preview_top,
    "null_flag": q_null_flag,
    "quarantine_rows": q_quarantine_rows,
    "quarantine_reasons": q_quarantine_reasons,
    "good_rows": q_good_rows,
    "run_metrics": q_run_metrics,
    "blank_filter": q_blank_filter,
    "is_blank_count": q_is_blank_count,
    "rule_not_null": q_rule_not_null,
    "rule_unique": q_rule_unique,
    "rule_query": q_rule_query,
    "rules_report": q_rules_report,
    "rules_failed": q_rules_failed,
    "rules_verdict": q_rules_verdict,
    "rules_html": q_rules_html,
    "rules_repeated_ids": q_rules_repeated_ids,
    "rules_fused_queries": q_rules_fused_queries,
    "report_table": q_report_table,
    "report_page": q_report_page,
    "missing_keys": q_missing_keys,
    "missing_files": q_missing_files,
    "sql_union_distinct": q_sql_union_distinct,
    "sql_distinct": q_sql_distinct,
    "sql_split_reverse": q_sql_split_reverse,
    "sql_left_join_null": q_sql_left_join_null,
    "latest_per_key": q_latest_per_key,
    "latest_null_order": q_latest_null_order,
    "ledger_run": q_ledger_run,
    "ledger_events": q_ledger_events,
    "run_stamp": q_run_stamp,
    "route_label": q_route_label,
    "route_counts": q_route_counts,
    "route_target": q_route_target,
    "json_lines_roundtrip": q_json_lines_roundtrip,
    "json_docs_roundtrip": q_json_docs_roundtrip,
    "json_docs_split": q_json_docs_split,
    "doc_to_csv": q_doc_to_csv,
    "corrupt_rows": q_corrupt_rows,
    "corrupt_rows_own_field": q_corrupt_rows_own_field,
    "csv_roundtrip": q_csv_roundtrip,
    "quarantine_csv_roundtrip": q_quarantine_csv_roundtrip,
    "dynamic_overwrite": q_dynamic_overwrite,
    "ingest_metrics": q_ingest_metrics,
    "ingest_quarantine": q_ingest_quarantine,
    "rules_after_ingest": q_rules_after_ingest,
    "stream_events": q_stream_events,
    "stream_quarantine": q_stream_quarantine,
    "stream_json_ledger": q_stream_json_ledger,
    "stream_unique_rule": q_stream_unique_rule,
    "committed_rows": q_committed_rows,
    "ledger_snapshots": q_ledger_snapshots,
}
