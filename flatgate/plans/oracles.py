"""DuckDB oracle SQL for every SQL-expressible registered query.

Tables are the driver's views (region nation customer supplier part orders
lineitem events documents embeddings pages benchmark labels
conversations). Column names equal the Spark query's.
"""

from __future__ import annotations

from flatgate.plans.queries import CONV_PART, EMBEDDING_WIDTH_SF001, FIXED_STAMP

ST = "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END"
PR = "CASE WHEN o_orderpriority LIKE '1%' THEN '  ' ELSE o_orderpriority END"
ORDERS_NULLS = f"(SELECT *, {ST} AS st, {PR} AS pr FROM orders)"

NESTED_JOIN = (
    "FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey "
    "LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"
)

FLATTEN_PREFIXED = (
    f"SELECT o.o_orderkey, CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderstatus END AS st, "
    "c.c_name AS cust_c_name, c.c_mktsegment AS cust_seg_c_mktsegment, c.c_nationkey AS cust_seg_c_nationkey, "
    "l.l_linenumber AS items_l_linenumber, l.l_quantity AS items_l_quantity, l.l_shipdate AS items_l_shipdate "
    + NESTED_JOIN
)

FLATTEN_PLAIN = (
    "SELECT o.o_orderkey, CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderstatus END AS st, "
    "c.c_name, c.c_mktsegment, c.c_nationkey, l.l_linenumber, l.l_quantity, l.l_shipdate " + NESTED_JOIN
)

FLATTEN_STRUCTS = (
    "SELECT o.o_orderkey, CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderstatus END AS st, "
    "c.c_name AS cust_c_name, c.c_mktsegment AS cust_seg_c_mktsegment, c.c_nationkey AS cust_seg_c_nationkey "
    "FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey"
)

FLATTEN_POSITIONAL = (
    "SELECT vec_id, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS embedding_{i}" for i in range(EMBEDDING_WIDTH_SF001))
    + ", label FROM embeddings"
)

CONV_DOCS = (
    f"(SELECT conv_id, CAST(floor(turn / {CONV_PART}) AS BIGINT) AS part, "
    "list(struct_pack(turn := turn, role := role, text := text) ORDER BY turn) AS t FROM conversations GROUP BY ALL)"
)

FLATTEN_POSITIONAL_NESTED = (
    "SELECT conv_id, part, "
    + ", ".join(
        f"t[{i + 1}].turn AS t_{i}_turn, t[{i + 1}].role AS t_{i}_role, t[{i + 1}].text AS t_{i}_text" for i in range(CONV_PART)
    )
    + f" FROM {CONV_DOCS}"
)

LEAF_PATHS = (
    "SELECT event_id, k AS path, json_extract_string(props, '$.\"' || k || '\"') AS value "
    "FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)"
)

LEAF_PATHS_NESTED = """
SELECT o_orderkey, 'o_orderkey' AS path, CAST(o_orderkey AS VARCHAR) AS value FROM orders
UNION ALL
SELECT o.o_orderkey, 'cust_c_name', c.c_name FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
UNION ALL
SELECT o.o_orderkey, 'cust_seg_c_mktsegment', c.c_mktsegment FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
UNION ALL
SELECT o.o_orderkey, 'cust_seg_c_nationkey', CAST(c.c_nationkey AS VARCHAR)
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
UNION ALL
SELECT l_orderkey, 'items_*_l_linenumber', CAST(l_linenumber AS VARCHAR)
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
"""

# path, stored kind, and per arrival the kinds seen ("" for none), the
# status and how many values a document gives
_DRIFT = {
    ".id": ("BIGINT", [("BIGINT", "same", 1)] * 4 + [("STRING", "conflicting", 1)]),
    ".kind": ("STRING", [("STRING", "same", 1)] * 5),
    ".size": ("BIGINT", [("BIGINT", "same", 1)] * 3 + [("DOUBLE", "widened", 1), ("BIGINT", "same", 1)]),
    ".user": ("OBJECT", [("OBJECT", "same", 2)] * 2 + [("", "absent", 0), ("OBJECT", "same", 2), ("BIGINT", "conflicting", 1)]),
    ".user.id": ("BIGINT", [("BIGINT", "same", 1)] * 2 + [("", "absent", 0), ("BIGINT", "same", 1), ("", "absent", 0)]),
    ".user.age": ("DOUBLE", [("DOUBLE", "same", 1)] * 2 + [("", "absent", 0), ("BIGINT", "same", 1), ("", "absent", 0)]),
    ".tags": ("ARRAY", [("ARRAY", "same", 2)] * 4 + [("ARRAY", "same", 1)]),
    ".tags[]": ("STRING", [("STRING", "same", 2)] * 4 + [("BIGINT|OBJECT", "conflicting", 1)]),
    ".tags[].t": (None, [None] * 4 + [("VOID", "added", "(event_id % 2)")]),
    ".extra": (None, [None, ("BOOLEAN", "added", 1), None, None, None]),
    ".more": (None, [None, ("OBJECT", "added", 1), None, None, None]),
    r".more.a\.b": (None, [None, ("BIGINT", "added", 1), None, None, None]),
}
SCHEMA_DRIFT = " UNION ALL ".join(
    f"SELECT {i} AS arrival, '{path}' AS path, '{seen[1]}' AS status, {f"'{stored}'" if stored else 'NULL'} AS stored_type, "
    f"nullif('{seen[0]}', '') AS observed_type, CAST(sum({seen[2]}) AS BIGINT) AS n_values FROM events "
    f"WHERE event_id % 5 = {i} AND NOT (event_id % 5 = 4 AND event_id % 3 = 0)"
    for path, (stored, arrivals) in _DRIFT.items() for i, seen in enumerate(arrivals) if seen
) + (
    " UNION ALL SELECT 4, NULL, 'malformed', NULL, NULL, count(*) FROM events WHERE event_id % 5 = 4 AND event_id % 3 = 0"
)
FLATTEN_ZIPPED = f"""
WITH docs AS (SELECT conv_id, part, t, list_transform(list_filter(t, lambda x: x.role = 'user'), lambda x: x.text) AS said FROM {CONV_DOCS})
SELECT conv_id, part, t[i].role AS d_roles, said[i] AS d_said, t[i].turn AS d_at_turn FROM docs, unnest(range(1, len(t) + 1)) AS u(i)
"""
ARRIVALS_AUDIT = """
WITH n AS (SELECT count(DISTINCT source) AS n FROM documents),
expected AS (SELECT 'source=src' || i AS file_name FROM n, unnest(range(1, n + 5)) AS u(i) UNION ALL SELECT 'source=nothing'),
arrived AS (SELECT DISTINCT 'source=' || source AS file_name, true AS has_content FROM documents UNION ALL SELECT 'source=nothing', false)
SELECT coalesce(e.file_name, a.file_name) AS file_name,
       CASE WHEN a.file_name IS NULL THEN 'missing' WHEN e.file_name IS NULL THEN 'unexpected' WHEN has_content THEN 'present' ELSE 'empty' END AS status,
       a.file_name IS NOT NULL AS arrived, coalesce(has_content, false) AS has_content
FROM expected e FULL JOIN arrived a ON a.file_name = e.file_name
"""
# keys in their order; an order without lines has no items
LEAF_PATHS_REBUILT = """
SELECT 'e' || event_id AS id,
       CASE WHEN event_id % 7 = 0 THEN left(props, length(props) - 1)
            ELSE '{' || array_to_string(list_transform(list_sort(json_keys(props)),
                   lambda k: to_json(k)::VARCHAR || ':' || json_extract(props, '$."' || k || '"')::VARCHAR), ',') || '}' END AS doc
FROM events
UNION ALL
SELECT 'o' || o_orderkey,
       '{"cust":{"c_name":"' || c_name || '","seg":{"c_mktsegment":"' || c_mktsegment || '","c_nationkey":' || c_nationkey || '}},'
       || coalesce('"items":[' || string_agg('{"l_linenumber":' || l_linenumber || '}', ',' ORDER BY l_linenumber) || '],', '')
       || '"o_orderkey":' || o_orderkey || '}'
FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_orderkey, c_name, c_mktsegment, c_nationkey
"""
_STEPS_DOC = (
    "'{\"a\":{\"b\":' || event_id || ',\"0\":[\"' || event_type || '\"]},\"a_b\":\"' || event_type || '\",\"a_0\":{\"0\":{\"0\":' || user_id "
    "|| '}},\"_corrupt_record\":' || user_id || '}'"
)
LEAF_STEPS = (
    " UNION ALL ".join(
        f"SELECT event_id, '{steps}' AS steps, '{kind}' AS kind, CAST({value} AS VARCHAR) AS value FROM events WHERE event_id % 4 <> 0"
        for steps, kind, value in [
            (".a.b", "BIGINT", "event_id"), (".a.0[0]", "STRING", "event_type"), (".a_b", "STRING", "event_type"),
            (".a_0.0.0", "BIGINT", "user_id"), ("._corrupt_record", "BIGINT", "user_id")])
    + f" UNION ALL SELECT event_id, NULL, NULL, left({_STEPS_DOC}, length({_STEPS_DOC}) - 1) FROM events WHERE event_id % 4 = 0"
)
CORRUPT_ROWS_OWN_FIELD = (
    "SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id, "
    "CASE WHEN event_type <> 'error' THEN event_type END AS _corrupt_record, "
    "CASE WHEN event_type = 'error' THEN '{\"event_id\":' || event_id || ',\"_corrupt_record\":\"error\"' END AS broken FROM events"
)
LEAF_PATHS_MALFORMED = f"""
SELECT event_id, '_corrupt_record' AS path, left(props, length(props) - 1) AS value FROM events WHERE event_id % 3 = 0
UNION ALL
SELECT event_id, '_corrupt_record', '{{"k": 0, ' || substr(props, 2) FROM events WHERE event_id % 3 <> 0 AND event_id % 5 = 0
UNION ALL
SELECT * FROM ({LEAF_PATHS}) WHERE event_id % 3 <> 0 AND event_id % 5 <> 0
"""


def _rule_row(rule_id: int, rule_type: str, fail: str, total: str = "(SELECT count(*) FROM orders)",
              extra: str = "") -> str:
    return (
        f"SELECT {extra}{rule_id} AS rule_id, '{rule_type}' AS rule_type, "
        f"CASE WHEN f > 0 THEN 'fail' ELSE 'pass' END AS status, t - f AS pass_count, f AS fail_count, "
        f"t AS total_count FROM (SELECT CAST({fail} AS BIGINT) AS f, CAST({total} AS BIGINT) AS t)"
    )


NN = lambda cols: " OR ".join(f"{c} IS NULL OR trim({c}) = ''" for c in cols)
NO_LINES = "(SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))"


def _dups(cols: str, src: str) -> str:
    return f"(SELECT count(*) FROM (SELECT {cols} FROM {src} GROUP BY {cols} HAVING count(*) > 1))"


RULE_NOT_NULL = _rule_row(1, "not null", f"(SELECT count(*) FROM {ORDERS_NULLS} WHERE {NN(['st', 'pr'])})")
RULE_UNIQUE = _rule_row(1, "unique", _dups("l_orderkey, l_linenumber", "lineitem"), "(SELECT count(*) FROM lineitem)")
RULE_QUERY = _rule_row(1, "query", NO_LINES)

_REPORT_ROWS = [
    (1, "status present", "not null", f"(SELECT count(*) FROM {ORDERS_NULLS} WHERE {NN(['st'])})"),
    (2, "priority present", "not null", f"(SELECT count(*) FROM {ORDERS_NULLS} WHERE {NN(['pr'])})"),
    (3, "status and priority", "not null", f"(SELECT count(*) FROM {ORDERS_NULLS} WHERE {NN(['st', 'pr'])})"),
    (4, "order key", "unique", _dups("o_orderkey", "orders")),
    (5, "customer", "unique", _dups("o_custkey", "orders")),
    (6, "orders have lines", "query", NO_LINES),
    (7, "key and status", "unique", _dups("o_orderkey, st", ORDERS_NULLS)),
]

RULES_REPORT = "\nUNION ALL\n".join(
    f"SELECT 101 AS dq_id, '{name}' AS rule_name, *, pass_count >= 0 AS pass_count_valid FROM ("
    + _rule_row(rid, rtype, fail)
    + ")"
    for rid, name, rtype, fail in _REPORT_ROWS
)
REPORT_TABLE = " UNION ALL ".join(
    f"SELECT 'flatgate' AS app_id, 101 AS dq_id, '{name}' AS rule_name, "
    f"{'NULL' if about is None else repr(about)} AS description, * FROM (" + _rule_row(rid, rtype, fail) + ")"
    for (rid, name, rtype, fail), about in zip(_REPORT_ROWS, [
        "status must be set", "priority must not be blank", None, "primary key", "one order per customer",
        "every order has lineitems", None], strict=True)
)
RULES_FUSED_QUERIES = " UNION ALL ".join(
    f"SELECT {i} AS rule_id, '{name}' AS rule_name, '{kind}' AS rule_type, CASE WHEN f > 0 THEN 'fail' ELSE 'pass' END AS status, "
    f"n - f AS pass_count, f AS fail_count, n AS total_count FROM (SELECT count(*) AS n, {fails} AS f FROM {ORDERS_NULLS} t)"
    for i, name, kind, fails in [
        (1, "big orders", "query", "count(*) FILTER (o_totalprice > 400000)"),
        (2, "late and urgent", "query", "count(*) FILTER (o_orderpriority LIKE '1-%' AND year(o_orderdate) >= 1997)"),
        (3, "no status", "query", "count(*) FILTER (st IS NULL OR trim(pr) = '')"),
        (4, "all orders", "query", "count(*)"),
        (5, "status present", "not null", "count(*) FILTER (st IS NULL OR trim(st) = '')"),
        (6, "customers", "query", "count(DISTINCT o_custkey) FILTER (o_totalprice > 400000)"),
        (7, "orders have lines", "query",
         "count(*) FILTER (st IS NOT NULL AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))"),
        (8, "of known customers", "query", "count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer))"),
        (9, "a third", "query", "count(*) FILTER (o_orderkey % 3 = 0)"),
    ]
)
QUARANTINE_REASONS = f"""
SELECT * FROM (
  SELECT o_orderkey, st, pr, concat_ws(',',
    CASE WHEN coalesce(trim(st), '') = '' THEN '11' END, CASE WHEN count(*) OVER (PARTITION BY o_custkey) > 1 THEN '12' END,
    CASE WHEN coalesce(trim(st), '') = '' OR coalesce(trim(pr), '') = '' THEN '13' END, CASE WHEN o_totalprice > 400000 THEN '14' END,
    CASE WHEN count(*) OVER (PARTITION BY st, o_custkey) > 1 THEN '15' END,
    CASE WHEN count(*) OVER (PARTITION BY o_orderkey) > 1 THEN '16' END) AS failed_rules
  FROM {ORDERS_NULLS}) WHERE failed_rules <> ''
"""
STREAM_UNIQUE_RULE = " UNION ALL ".join(
    f"SELECT {i} AS rule_id, 'unique' AS rule_type, CASE WHEN f > 0 THEN 'fail' ELSE 'pass' END AS status, n - f AS pass_count, "
    f"f AS fail_count, n AS total_count FROM (SELECT (SELECT count(*) FROM orders) AS n, (SELECT count(*) FROM "
    f"(SELECT 1 FROM {ORDERS_NULLS} GROUP BY {keys} HAVING count(*) > 1)) AS f)"
    for i, keys in ((1, "o_orderkey"), (2, "o_custkey"), (3, "st, o_custkey"), (4, "o_custkey"))
)
LEDGER_SNAPSHOTS = " UNION ALL ".join(
    f"SELECT {2 * i} AS seq, 'job_{status}' AS job_id, 'COMPLETED' AS status, count(*) AS total_record_count, "
    f"count(*) FILTER (trim(pr) <> '') AS load_record_count, count(*) FILTER (trim(pr) = '') AS error_record_count "
    f"FROM {ORDERS_NULLS} WHERE o_orderstatus = '{status}'"
    for i, status in enumerate("FOP", 1)
)
RULES_REPEATED_IDS = " UNION ALL ".join(
    f"SELECT {dq} AS dq_id, '{name}' AS rule_name, * FROM (" + _rule_row(1, rtype, fail) + ")"
    for dq, name, rtype, fail in [
        (1, "status present", "not null", f"(SELECT count(*) FROM {ORDERS_NULLS} WHERE {NN(['st'])})"),
        (2, "priority present", "not null", f"(SELECT count(*) FROM {ORDERS_NULLS} WHERE {NN(['pr'])})"),
        (2, "order key", "unique", _dups("o_orderkey", "orders")),
        (1, "customer", "unique", _dups("o_custkey", "orders")),
        (1, "big orders", "query", "(SELECT count(*) FROM orders WHERE o_totalprice > 400000)"),
        (2, "all orders", "query", "(SELECT count(*) FROM orders)"),
    ]
)
RULES_FAILED = f"SELECT rule_id, fail_count FROM ({RULES_REPORT}) WHERE status = 'fail'"
RULES_VERDICT = f"SELECT bool_and(status = 'pass') AS passed FROM ({RULES_REPORT})"

MISSING_KEYS = (
    "SELECT o.o_orderkey FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l "
    "ON l.l_orderkey = o.o_orderkey WHERE l.l_orderkey IS NULL"
)

MISSING_FILES = (
    "SELECT 'source=src' || CAST(i AS VARCHAR) AS file_name "
    "FROM range(0, (SELECT count(DISTINCT source) FROM documents) + 5) t(i) "
    "WHERE 'src' || CAST(i AS VARCHAR) NOT IN (SELECT DISTINCT source FROM documents)"
)

ROUTE_SRC = (
    "CASE WHEN contains(lower(source), 'src1') THEN 'src1' WHEN contains(lower(source), 'src2') THEN 'src2' "
    "ELSE source END"
)
ROUTE_PART = (
    "CASE WHEN contains(lower(p_type), 'promo') THEN 'Promo' WHEN contains(lower(p_type), 'standard') "
    "THEN 'Standard' ELSE p_type END"
)

INGEST_METRICS = (
    "SELECT count(*) AS total_record_count, count(*) FILTER (WHERE o.o_orderstatus <> 'P') AS load_record_count, "
    "count(*) FILTER (WHERE o.o_orderstatus = 'P') AS error_record_count "
    "FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"
)

FLAT_ORDERS = (
    "(SELECT o.o_orderkey, CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderstatus END AS st, "
    "l.l_linenumber AS items_l_linenumber, l.l_quantity AS items_l_quantity " + NESTED_JOIN + ")"
)
RULES_AFTER_INGEST = "\nUNION ALL\n".join(
    _rule_row(rid, rtype, fail, total=f"(SELECT count(*) FROM {FLAT_ORDERS})")
    for rid, rtype, fail in [
        (1, "not null", f"(SELECT count(*) FROM {FLAT_ORDERS} WHERE {NN(['st'])})"),
        (2, "unique", _dups("o_orderkey, items_l_linenumber", FLAT_ORDERS)),
        (3, "query", f"(SELECT count(*) FROM {FLAT_ORDERS} WHERE items_l_quantity > 45)"),
    ]
)

def _html_oracle() -> str:
    """The D10 page built in SQL from the same counts (values HTML-escaped
    by hand: the rule texts are constants of the query). The page's texts
    are stated here once more, so a slip in the report's own shows."""
    # The page's texts, colours and headers.
    page_open = "<html><body><P>Team,<br/><br/>Data Quality check finished successfully for <b>DQ ID = "
    after_id, with_failures, without_failures = "</b>", ", with failures. ", ". "
    intro_close = "Check details in below table of metrics.</P>"
    failed_title, passed_title = "Failed DQ details", "Succeeded DQ details"
    failed_colour, passed_colour = "#FF6347", "#33FFBD"
    executed_on, page_close = "<br/><br/>Executed on ", ",<br/>Thanks</body></html><br/>"
    header = (
        "<th>Spark Application Id</th> <th>DQ ID</th> <th>Rule ID</th> <th>Rule Name</th> <th>Rule type</th> "
        "<th>Description</th> <th>Columns/Query</th> <th>Pass Count</th> <th>Fail Count</th> <th>Total Count</th>"
    )

    def table(title: str, colour: str) -> str:
        return (f'<h3 style="font-family:arial">{title}</h3><table border="3" style="width:100%">'
                f'<tr style="text-align:left;background-color:{colour}">{header}</tr>')

    rules = [  # rule_id, name, type, description, escaped columns/query, fail count
        (1, "status present", "not null", "status must be set", "[&quot;st&quot;]",
         f"(SELECT count(*) FROM {ORDERS_NULLS} WHERE {NN(['st'])})"),
        (2, "order key", "unique", "primary key", "[&quot;o_orderkey&quot;]", _dups("o_orderkey", "orders")),
        (3, "big orders", "query", "no order above 400000", "SELECT * FROM temp WHERE o_totalprice &gt; 400000",
         "(SELECT count(*) FROM orders WHERE o_totalprice > 400000)"),
    ]
    per_rule = "\nUNION ALL\n".join(
        f"SELECT {rid} AS rule_id, '{name}' AS n, '{rtype}' AS ty, '{desc}' AS d, '{target}' AS tg, "
        f"CAST({fail} AS BIGINT) AS f, (SELECT count(*) FROM orders) AS t"
        for rid, name, rtype, desc, target, fail in rules
    )
    row = ("'<tr>' || concat_ws(' ', '<td>flatgate</td>', '<td>101</td>', '<td>' || rule_id || '</td>', "
           "'<td>' || n || '</td>', '<td>' || ty || '</td>', '<td>' || d || '</td>', '<td>' || tg || '</td>', "
           "'<td>' || (t - f) || '</td>', '<td>' || f || '</td>', '<td>' || t || '</td>') || '</tr>'")
    return f"""
WITH r AS ({per_rule}),
h AS (SELECT rule_id, f > 0 AS failed, {row} AS html FROM r),
agg AS (SELECT string_agg(html, ' ' ORDER BY rule_id) FILTER (WHERE failed) AS fr,
               string_agg(html, ' ' ORDER BY rule_id) FILTER (WHERE NOT failed) AS pr FROM h)
SELECT 101 AS dq_id,
  '{page_open}101{after_id}'
  || CASE WHEN fr IS NOT NULL THEN '{with_failures}' ELSE '{without_failures}' END
  || '{intro_close}'
  || CASE WHEN fr IS NOT NULL THEN '{table(failed_title, failed_colour)}' || fr || '</table>' ELSE '' END
  || CASE WHEN pr IS NOT NULL THEN '{table(passed_title, passed_colour)}' || pr || '</table>' ELSE '' END
  || '{executed_on}2024-01-01 00:00:00{page_close}' AS html
FROM agg
"""


ORACLES: dict[str, str] = {
    "flatten_prefixed": FLATTEN_PREFIXED,
    "flatten_plain": FLATTEN_PLAIN,
    "flatten_structs": FLATTEN_STRUCTS,
    "flatten_positional": FLATTEN_POSITIONAL,
    "flatten_positional_nested": FLATTEN_POSITIONAL_NESTED,
    "leaf_paths": LEAF_PATHS,
    "leaf_paths_nested": LEAF_PATHS_NESTED,
    "leaf_paths_malformed": LEAF_PATHS_MALFORMED,
    "leaf_steps": LEAF_STEPS,
    "leaf_paths_rebuilt": LEAF_PATHS_REBUILT,
    "schema_drift": SCHEMA_DRIFT,
    "flatten_zipped": FLATTEN_ZIPPED,
    "arrivals_audit": ARRIVALS_AUDIT,
    "corrupt_rows_own_field": CORRUPT_ROWS_OWN_FIELD,
    "explode_estimate": "SELECT count(*) AS rows FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey",
    "merge_fingerprint": (
        f"SELECT conv_id, CAST(floor(turn / {CONV_PART}) AS BIGINT) AS part, "
        "string_agg(role, ',' ORDER BY turn) AS fingerprint FROM conversations GROUP BY ALL"
    ),
    "merge_columns": (
        f"SELECT conv_id, CAST(floor(turn / {CONV_PART}) AS BIGINT) AS part, "
        "string_agg(role, ',' ORDER BY turn) AS fingerprint FROM conversations GROUP BY ALL"
    ),
    "fingerprint_first_seen": (
        f"SELECT conv_id, part, fingerprint FROM (SELECT conv_id, CAST(floor(turn / {CONV_PART}) AS BIGINT) AS part, "
        "string_agg(role, ',' ORDER BY turn) AS fingerprint FROM conversations GROUP BY ALL) "
        "QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY conv_id, part) = 1"
    ),
    "dedup_keep_first": "SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "dedup_incremental": "SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "dedup_null_order": (
        f"SELECT o_custkey, st, o_orderkey, pr FROM {ORDERS_NULLS} "
        "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY st NULLS FIRST, o_orderkey) = 1"
    ),
    "latest_null_order": (
        f"SELECT o_custkey, CASE WHEN st IS NOT NULL THEN o_totalprice END AS price, o_orderkey, st FROM {ORDERS_NULLS} "
        "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY price DESC NULLS LAST, o_orderkey DESC) = 1"
    ),
    "keep_known": "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders",
    "stamp_job": f"SELECT o_orderkey, 'job_{FIXED_STAMP}' AS job_id FROM orders",
    "preview_top": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100",
    "null_flag": f"SELECT o_orderkey, {ST} AS st, o_orderstatus = 'P' AS null_check_result FROM orders",
    "quarantine_rows": f"SELECT o_orderkey, st, pr, true AS null_check_result FROM {ORDERS_NULLS} WHERE st IS NULL",
    "good_rows": f"SELECT o_orderkey, st, pr FROM {ORDERS_NULLS} WHERE st IS NOT NULL",
    "run_metrics": (
        "SELECT count(*) AS total_record_count, count(*) FILTER (WHERE o_orderstatus <> 'P') AS load_record_count, "
        "count(*) FILTER (WHERE o_orderstatus = 'P') AS error_record_count FROM orders"
    ),
    "blank_filter": f"SELECT o_orderkey, pr FROM {ORDERS_NULLS} WHERE pr IS NULL OR regexp_full_match(pr, '\\s*')",
    "is_blank_count": (
        f"SELECT count(*) FILTER (WHERE pr IS NULL OR regexp_full_match(pr, '\\s*')) AS blank_pr, "
        f"count(*) FILTER (WHERE st IS NULL OR regexp_full_match(st, '\\s*')) AS blank_st FROM {ORDERS_NULLS}"
    ),
    "rule_not_null": RULE_NOT_NULL,
    "rule_unique": RULE_UNIQUE,
    "rule_query": RULE_QUERY,
    "rules_report": RULES_REPORT,
    "rules_failed": RULES_FAILED,
    "rules_html": _html_oracle(),
    "rules_repeated_ids": RULES_REPEATED_IDS,
    "rules_fused_queries": RULES_FUSED_QUERIES,
    "stream_unique_rule": STREAM_UNIQUE_RULE,
    "quarantine_reasons": QUARANTINE_REASONS,
    "committed_rows": f"SELECT o_orderkey, st, pr FROM {ORDERS_NULLS} WHERE st IS NOT NULL",
    "ledger_snapshots": LEDGER_SNAPSHOTS,
    "report_table": REPORT_TABLE,
    "report_page": _html_oracle(),
    "rules_verdict": RULES_VERDICT,
    "missing_keys": MISSING_KEYS,
    "missing_files": MISSING_FILES,
    "sql_union_distinct": "SELECT o_orderstatus AS s FROM orders UNION SELECT o_orderpriority AS s FROM orders",
    "sql_distinct": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "sql_split_reverse": "SELECT p_partkey, list_reverse(string_split(p_name, ' '))[1] AS last_word FROM part",
    "sql_left_join_null": MISSING_KEYS,
    "latest_per_key": "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1",
    "ledger_run": (
        f"SELECT 'job_{FIXED_STAMP}' AS job_id, 'orders' AS job_description, count(*) AS total_record_count, "
        "count(*) FILTER (WHERE o_orderstatus <> 'P') AS load_record_count, "
        "count(*) FILTER (WHERE o_orderstatus = 'P') AS error_record_count, "
        "TIMESTAMP '2024-01-01 00:00:00' AS job_start_time, TIMESTAMP '2024-01-01 01:00:00' AS job_end_time, "
        "'orders' AS source_path, 'quarantine/' AS dq_file_path, 'COMPLETED' AS status FROM orders"
    ),
    "ledger_events": (
        "WITH j AS (SELECT d.source, count(*) AS total, count(l.doc_id) AS loaded FROM documents d "
        "LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source) "
        "SELECT source AS job_id, 'documents' AS job_description, total AS total_record_count, "
        "loaded AS load_record_count, total - loaded AS error_record_count, "
        "TIMESTAMP '2024-01-01 00:00:00' AS job_start_time, TIMESTAMP '2024-01-01 01:00:00' AS job_end_time, "
        "'documents' AS source_path, 'quarantine/job_id=' || source AS dq_file_path, 'COMPLETED' AS status FROM j"
    ),
    "run_stamp": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M%S') AS stamp FROM orders",
    "route_label": f"SELECT doc_id, {ROUTE_SRC} AS route FROM documents",
    "route_counts": (
        f"SELECT {ROUTE_SRC} AS route, count(DISTINCT source) AS names, count(*) AS rows, "
        f"{ROUTE_SRC} || '_{FIXED_STAMP}' AS job_name FROM documents GROUP BY ALL"
    ),
    "route_target": (
        f"SELECT p_partkey, {ROUTE_PART} AS route, CASE {ROUTE_PART} WHEN 'Promo' THEN 'promo_parts' "
        "WHEN 'Standard' THEN 'standard_parts' END AS target_table FROM part"
    ),
    "json_lines_roundtrip": FLATTEN_PREFIXED,
    "json_docs_roundtrip": FLATTEN_PREFIXED,
    "json_docs_split": FLATTEN_PREFIXED,
    "doc_to_csv": FLATTEN_PREFIXED,
    "corrupt_rows": (
        "SELECT NULL::BIGINT AS event_id, NULL::VARCHAR AS event_type, "
        "'{\"event_id\":' || CAST(event_id AS VARCHAR) || ',\"event_type\":\"error\"' AS _corrupt_record "
        "FROM events WHERE event_type = 'error'"
    ),
    "csv_roundtrip": "SELECT * FROM documents",
    "quarantine_csv_roundtrip": (
        f"SELECT o_orderkey, st, pr, true AS null_check_result, 'job_{FIXED_STAMP}' AS job_id "
        f"FROM {ORDERS_NULLS} WHERE st IS NULL"
    ),
    "dynamic_overwrite": (
        "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, "
        "o_orderstatus FROM orders"
    ),
    "ingest_metrics": INGEST_METRICS,
    "rules_after_ingest": RULES_AFTER_INGEST,
    "ingest_quarantine": (
        "SELECT o.o_orderkey, l.l_linenumber AS items_l_linenumber, true AS null_check_result "
        "FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'P'"
    ),
    "stream_json_ledger": INGEST_METRICS,
    "stream_events": "SELECT * FROM events",
    "stream_quarantine": (
        "SELECT o_orderkey, NULL::VARCHAR AS st, true AS null_check_result FROM orders WHERE o_orderstatus = 'P'"
    ),
}
