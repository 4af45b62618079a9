"""DuckDB SQL of the registered queries that SQL can express."""

_URL_PARTS = r"""
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages)
"""

OP10 = f"""
WITH parts AS ({_URL_PARTS}),
rules(r_host, r_path, r_verdict) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
hits AS (
  SELECT page_id, host, path, max_by(struct_pack(rule := r_host || r_path, verdict := r_verdict),
                                     length(r_host) + length(r_path)) AS b
  FROM (SELECT DISTINCT * FROM parts) p
  JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY ALL)
SELECT p.page_id, p.host, p.path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN hits h ON p.page_id IS NOT DISTINCT FROM h.page_id AND p.host = h.host AND p.path = h.path
"""

OP6 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
places AS (SELECT k, i, [w[i], w[i + 1], w[i + 2]] AS win FROM docs, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS c FROM places) WHERE c > 1),
covered AS (SELECT k, count(DISTINCT i + d) AS n FROM twice, unnest([0, 1, 2]) AS v(d) GROUP BY k),
counts AS (
  SELECT docs.k, doc_id, source, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN covered USING (k)),
flags AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
hosts AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM flags GROUP BY source),
m AS (
  SELECT sum(f) AS f, sum(n) AS n, count(*) AS h, least(greatest(sum(f) / sum(n), 1e-6), 1 - 1e-6) AS mu,
         sum(f * f / n) - sum(n) * (sum(f) / sum(n)) ** 2 AS spread, sum(n) - sum(n * n) / sum(n) AS room FROM hosts),
b AS (SELECT *, CASE WHEN room > 0 THEN (spread - (h - 1) * mu * (1 - mu)) / room END AS between_hosts FROM m),
prior AS (
  SELECT mu, least(greatest(CASE WHEN between_hosts > 0 AND mu * (1 - mu) / between_hosts - 1 > 0
                                 THEN mu * (1 - mu) / between_hosts - 1 ELSE n / h END, 1.0), n / h + 1.0) AS strength
  FROM b),
verdicts AS (SELECT source, (f + mu * strength) / (n + strength) > 0.5 AS rejected FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM flags JOIN verdicts ON flags.source IS NOT DISTINCT FROM verdicts.source
"""

OP11 = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

# crc32 of the id's digits: a byte at a time, each in eight steps
_CRC = """xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
                             lambda u, v: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END)), 4294967295)"""

OP12 = rf"""
WITH convs AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations GROUP BY conv_id),
shared AS (SELECT *, {_CRC} % 4 AS h FROM convs),
rebuilt AS (
  SELECT s.conv_id, CASE WHEN h = 0 THEN s.own ELSE list_concat(coalesce(b.own[1:h], []), s.own[h + 1:]) END AS turns
  FROM shared s LEFT JOIN convs b ON b.conv_id = s.conv_id - s.conv_id % 20),
paths AS (SELECT conv_id, d, turns[1:d] AS p, len(turns) = d AS ends FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
own AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children,
         CASE WHEN nodes.d = 0 THEN 0
              ELSE (n_convs - 1) * len(list_filter(regexp_split_to_array(nodes.p[d].t, '[ 	-
]+'), lambda w: w <> '')) END AS saved
  FROM nodes LEFT JOIN kids ON kids.p = nodes.p),
sums AS (
  SELECT p[1:j] AS p, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM own, unnest(range(0, d + 1)) AS u(j) GROUP BY ALL)
SELECT own.conv_id, own.d AS depth, parent.conv_id AS parent_conv_id, own.n_convs, own.n_children, sums.n_leaves, sums.saved_tokens,
       own.ends_sha256
FROM own JOIN sums ON sums.p = own.p LEFT JOIN nodes parent ON own.d > 0 AND parent.p = own.p[1:own.d - 1]
"""

OP13 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
marked AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failures AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (min(docs.doc_id) OVER (PARTITION BY t) < docs.doc_id)::INT AS f
  FROM docs LEFT JOIN marked ON marked.doc_id = docs.doc_id),
counts AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM failures GROUP BY ALL),
letters(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.b | b.b | c.b | d.b | e.b = 31),
steps AS (
  SELECT filter_order, s::INT AS step, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0)::INT AS before
  FROM orders, unnest(range(1, 6)) AS u(s)),
result AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (f & (bit | before) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (f & bit > 0 AND f & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (f & bit > 0 AND f & before > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (f = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(g) FILTER (f & bit > 0 AND f & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(x) FILTER (f & bit > 0 AND f & before = 0), 0)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM result
"""

ORACLES = {"op11_exact_dedup": OP11, "op12_conversation_trie": OP12, "op13_filter_audit": OP13, "op6_quality_rules": OP6, "op10_url_filters": OP10}
