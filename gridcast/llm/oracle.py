"""DuckDB SQL of the training-data queries that SQL can express.

The constants below are written out here on purpose: an oracle that imported
them from the code under test could not tell a wrong one.
"""

_OP3 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS t
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(20)) AS i FROM late),
each AS (SELECT w.doc_id, p.i, ws[p.i] AS word FROM w, LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i) p),
kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS t, count(*) AS n
         FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, len(ws)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_OP4 = r"""
WITH t AS (
  SELECT conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1::BIGINT, 0::BIGINT, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars,
       sum(len(regexp_extract_all(text, '\S+')))::BIGINT AS n_tokens
FROM t GROUP BY conv_id
"""

_OP5 = r"""
WITH RECURSIVE names AS (SELECT DISTINCT coalesce(source, '') AS source FROM documents),
bits AS (  -- crc32 of a name, bit by bit
  SELECT source, 4294967295::BIGINT AS crc, 0 AS i, 0 AS b FROM names
  UNION ALL
  SELECT source,
         CASE WHEN (CASE WHEN b = 0 THEN xor(crc, ascii(source[i + 1])::BIGINT) ELSE crc END) & 1 = 1
              THEN xor((CASE WHEN b = 0 THEN xor(crc, ascii(source[i + 1])::BIGINT) ELSE crc END) >> 1, 3988292384::BIGINT)
              ELSE (CASE WHEN b = 0 THEN xor(crc, ascii(source[i + 1])::BIGINT) ELSE crc END) >> 1 END,
         CASE WHEN b = 7 THEN i + 1 ELSE i END, (b + 1) % 8
  FROM bits WHERE i < length(source)
),
crcs AS (SELECT source, xor(crc, 4294967295::BIGINT) AS crc FROM bits WHERE i = length(source) AND b = 0),
sized AS (
  SELECT doc_id, 'd' || (c.crc % 4)::VARCHAR AS domain, coalesce(lang, '') AS lang, coalesce(d.source, '') AS source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens
  FROM documents d JOIN crcs c ON c.source = coalesce(d.source, '')
),
leaves AS (
  SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, 3 * sum(tokens)::BIGINT AS cap FROM sized GROUP BY ALL
),
d0 AS (
  SELECT domain, sum(cap)::BIGINT AS cap, (SELECT sum(tokens)::BIGINT FROM leaves) AS budget,
         CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 3 WHEN 'd3' THEN 2 ELSE 1 END AS weight
  FROM leaves GROUP BY domain
),
d1 AS (
  SELECT *, budget - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
         sum(weight) OVER (ORDER BY cap::DOUBLE / weight, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM d0
),
d2 AS (SELECT *, max((lft::HUGEINT * weight < cap::HUGEINT * rest)::INT) OVER (ORDER BY cap::DOUBLE / weight, domain ROWS UNBOUNDED PRECEDING) AS op FROM d1),
d3 AS (
  SELECT domain, CASE WHEN op = 0 THEN cap ELSE greatest(0, (max(CASE WHEN op = 1 THEN lft END) OVER ())::HUGEINT * weight
         // (max(CASE WHEN op = 1 THEN rest END) OVER ())::HUGEINT) END AS budget FROM d2
),
l0 AS (
  SELECT domain, lang, sum(cap)::BIGINT AS cap, any_value(budget) AS budget,
         CASE lang WHEN 'de' THEN 3 WHEN 'en' THEN 6 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 ELSE 1 END AS weight
  FROM leaves JOIN d3 USING (domain) GROUP BY domain, lang
),
l1 AS (
  SELECT *, budget - coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / weight, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
         sum(weight) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / weight, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM l0
),
l2 AS (SELECT *, max((lft::HUGEINT * weight < cap::HUGEINT * rest)::INT) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / weight, lang ROWS UNBOUNDED PRECEDING) AS op FROM l1),
l3 AS (
  SELECT domain, lang, CASE WHEN op = 0 THEN cap ELSE greatest(0, (max(CASE WHEN op = 1 THEN lft END) OVER (PARTITION BY domain))::HUGEINT * weight
         // (max(CASE WHEN op = 1 THEN rest END) OVER (PARTITION BY domain))::HUGEINT) END AS budget FROM l2
),
s0 AS (SELECT domain, lang, source, tokens, cap, budget, 1 AS weight FROM leaves JOIN l3 USING (domain, lang)),
s1 AS (
  SELECT *, budget - coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
         sum(weight) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM s0
),
s2 AS (SELECT *, max((lft::HUGEINT * weight < cap::HUGEINT * rest)::INT) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE / weight, source ROWS UNBOUNDED PRECEDING) AS op FROM s1),
plan AS (
  SELECT domain, lang, source, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS full_epochs, CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS part
  FROM (SELECT *, CASE WHEN op = 0 THEN cap ELSE greatest(0, (max(CASE WHEN op = 1 THEN lft END) OVER (PARTITION BY domain, lang))::HUGEINT * weight
         // (max(CASE WHEN op = 1 THEN rest END) OVER (PARTITION BY domain, lang))::HUGEINT) END AS given FROM s2)
),
keyed AS (
  SELECT s.*, full_epochs, part, md5('17:' || full_epochs::BIGINT::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM sized s JOIN plan USING (domain, lang, source)
),
run AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY k RANGE UNBOUNDED PRECEDING) AS upto FROM keyed),
counted AS (SELECT *, full_epochs + CASE WHEN part > 0 AND upto <= part THEN 1 ELSE 0 END AS n FROM run)
SELECT doc_id, unnest(range(n::BIGINT))::BIGINT AS epoch, domain, lang, source, tokens FROM counted
"""

_OP7 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(b) FROM reach r WHERE r.a = w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""

_OP9 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS text FROM documents),
kinds(kind, name, re) AS (VALUES
  (0, 'assign', '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'), (3, 'generic', '[A-Za-z0-9+/_=-]{20,}')),
m AS (
  SELECT r, doc_id, owner, text, 0 AS kind, 'assign' AS name,
         regexp_extract_all(text, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS ms,
         regexp_extract_all(text, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS vs,
         string_split_regex(text, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS ps FROM d
  UNION ALL SELECT r, doc_id, owner, text, 1, 'access', regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
         regexp_extract_all(text, 'AKIA[A-Z0-9]+'), string_split_regex(text, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT r, doc_id, owner, text, 2, 'hex', regexp_extract_all(text, '[0-9a-f]{24,}'),
         regexp_extract_all(text, '[0-9a-f]{24,}'), string_split_regex(text, '[0-9a-f]{24,}') FROM d
  UNION ALL SELECT r, doc_id, owner, text, 3, 'generic', regexp_extract_all(text, '[A-Za-z0-9+/_=-]{20,}'),
         regexp_extract_all(text, '[A-Za-z0-9+/_=-]{20,}'), string_split_regex(text, '[A-Za-z0-9+/_=-]{20,}') FROM d
),
e AS (SELECT r, doc_id, owner, kind, name, unnest(range(1, len(ms) + 1)) AS i, ms, vs, ps FROM m WHERE len(ms) > 0),
o AS (
  SELECT r, doc_id, owner, kind, name, vs[i] AS v,
         sum(length(ps[i]) + length(ms[i])) OVER (PARTITION BY r, kind ORDER BY i) AS en, length(ms[i]) AS n FROM e
),
f AS (
  SELECT r, doc_id, owner, kind, name, v, (en - n)::BIGINT AS st, en::BIGINT AS en FROM o
  WHERE (kind = 0 AND length(v) >= 6) OR (kind = 1 AND length(v) >= 20) OR (kind = 2 AND length(v) >= 24)
     OR (kind = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]'))
),
own AS (
  SELECT v, n_rep, n_own <= 2 AND (n_own = 1 OR n_rep <= 20) AS live FROM (
    SELECT v, count(DISTINCT owner) AS n_own, count(DISTINCT owner || chr(10) || coalesce(doc_id::VARCHAR, '')) AS n_rep FROM f GROUP BY v)),
j AS (
  SELECT f.*, live, n_rep, max(CASE WHEN kind < 3 THEN en END) OVER (PARTITION BY r ORDER BY st, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe,
         min(CASE WHEN kind < 3 THEN st END) OVER (PARTITION BY r ORDER BY st, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ns
  FROM f JOIN own USING (v)
),
s AS (
  SELECT *, name || ':' || st || ':' || en AS said FROM j
  WHERE kind < 3 OR (live AND coalesce(pe <= st, true) AND coalesce(ns >= en, true))
),
g AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         count(*) FILTER (kind = 3) AS n_generic, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
         max(n_rep) AS max_repositories,
         coalesce(string_agg(said, ',' ORDER BY st, kind) FILTER (kind < 3), '') AS base, string_agg(said, ',' ORDER BY st, kind) AS spans
  FROM s GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_generic, 0) AS n_generic, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
       coalesce(max_repositories, 0) AS max_repositories
FROM d LEFT JOIN g USING (r)
"""

_OP10 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
ln AS (SELECT r, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM d),
late AS (
  SELECT r, x FROM (SELECT r, x, row_number() OVER (PARTITION BY r, x ORDER BY i) AS k FROM ln WHERE regexp_matches(x, '[^\x20\x09-\x0D]')) q WHERE k > 1),
lines AS (
  SELECT r, count(*) AS n_dup_lines, sum(length(array_to_string(regexp_extract_all(x, '[^\x20\x09-\x0D]+'), ''))) AS dup_line_chars FROM late GROUP BY r),
g AS (
  SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS t
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT unnest(range(5, 11)) AS n) WHERE len(ws) >= n)),
dup AS (SELECT r, n, i FROM (SELECT r, n, i, count(*) OVER (PARTITION BY r, n, t) AS c FROM g) q WHERE c > 1),
cov AS (SELECT DISTINCT r, n, i + k AS i FROM dup, (SELECT unnest(range(10)) AS k) WHERE k < n),
cc AS (SELECT r, n, count(*) AS nw, sum(length(ws[i])) AS nc FROM cov JOIN d USING (r) GROUP BY r, n),
p AS (
  SELECT r, coalesce(max(nw) FILTER (n = 5), 0)::BIGINT AS n_repeat_words,
         coalesce(max(nc) FILTER (n = 5), 0)::BIGINT AS dup_5gram_chars,
         coalesce(max(nc) FILTER (n = 6), 0)::BIGINT AS dup_6gram_chars,
         coalesce(max(nc) FILTER (n = 7), 0)::BIGINT AS dup_7gram_chars,
         coalesce(max(nc) FILTER (n = 8), 0)::BIGINT AS dup_8gram_chars,
         coalesce(max(nc) FILTER (n = 9), 0)::BIGINT AS dup_9gram_chars,
         coalesce(max(nc) FILTER (n = 10), 0)::BIGINT AS dup_10gram_chars
  FROM cc GROUP BY r),
s AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars, coalesce(dup_5gram_chars, 0) AS dup_5gram_chars, coalesce(dup_6gram_chars, 0) AS dup_6gram_chars, coalesce(dup_7gram_chars, 0) AS dup_7gram_chars, coalesce(dup_8gram_chars, 0) AS dup_8gram_chars, coalesce(dup_9gram_chars, 0) AS dup_9gram_chars, coalesce(dup_10gram_chars, 0) AS dup_10gram_chars
  FROM d LEFT JOIN lines USING (r) LEFT JOIN p USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT *, NOT (base_failed OR 100 * dup_line_chars > 30 * word_chars OR 100 * n_symbols > 20 * n_words OR 100 * dup_5gram_chars > 30 * word_chars OR 100 * dup_6gram_chars > 29 * word_chars OR 100 * dup_7gram_chars > 28 * word_chars OR 100 * dup_8gram_chars > 27 * word_chars OR 100 * dup_9gram_chars > 26 * word_chars OR 100 * dup_10gram_chars > 25 * word_chars) AS kept FROM f
"""



def _rounds(n: int, first: str, codes: str) -> str:
    """n rounds of integer k-means over part vectors x(vec_id, p, v), each round two materialized tables."""
    nearest = """a{r} AS MATERIALIZED (
  SELECT vec_id, label, p, any_value(v) AS v, min({{'d': list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c), 'k': k}}) AS near
  FROM x JOIN c{r} USING (p) GROUP BY vec_id, label, p)"""
    update = """c{s} AS MATERIALIZED (
  SELECT p, k, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN (
    SELECT p, k, list(floor(s / n) ORDER BY i) AS c FROM (
      SELECT p, near.k AS k, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, LATERAL (SELECT unnest(range(1, len(v) + 1)) AS i) GROUP BY ALL)
    GROUP BY p, k) m USING (p, k))"""
    steps = [first]
    for r in range(n):
        steps += [nearest.format(r=r), update.format(r=r, s=r + 1)]
    return "WITH " + ",\n".join([*steps, nearest.format(r=n)]) + codes.replace("@", str(n))


_OP11 = _rounds(10, """x AS MATERIALIZED (
  SELECT vec_id, 0 AS label, 0 AS p, [floor(1024 * e::DOUBLE) FOR e IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e)]) = 64),
c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (ORDER BY h) - 1 AS k, v AS c FROM (SELECT *, sha256('3:' || vec_id) AS h FROM x ORDER BY h LIMIT 8))""", """,
g AS (SELECT near.k AS k, sum(near.d)::BIGINT AS inertia FROM a@ GROUP BY near.k)
SELECT vec_id, near.k::INT AS cluster, near.d::BIGINT AS distance, g.inertia AS cluster_inertia, (SELECT sum(inertia) FROM g)::BIGINT AS inertia,
       sha256(array_to_string([e::BIGINT::VARCHAR FOR e IN c.c], ',')) AS centroid_sha256
FROM a@ JOIN g ON g.k = near.k JOIN c@ c ON c.k = near.k
""")

_OP12 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, octet_length(h)::BIGINT AS n, sha256(h) AS s FROM p),
f AS (SELECT s, min(page_id) AS lead FROM d WHERE n >= 100 GROUP BY s)
SELECT page_id, n AS payload_bytes, s AS payload_digest, CASE WHEN page_id > lead THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > lead THEN lead END AS refers_to
FROM d LEFT JOIN f USING (s)
"""

_OP13 = _rounds(4, """v AS MATERIALIZED (
  SELECT vec_id, label, [floor(1024 * e::DOUBLE) FOR e IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0),
x AS MATERIALIZED (SELECT vec_id, label, p, v[len(v) // 4 * p + 1:len(v) // 4 * (p + 1)] AS v FROM v, (SELECT unnest(range(4)) AS p)),
c0 AS MATERIALIZED (
  SELECT p, k, v AS c FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k FROM x) WHERE k < 256)""", """,
e AS (SELECT vec_id, label, string_agg(printf('%02x', near.k), '' ORDER BY p) AS code, sum(near.d)::BIGINT AS error FROM a@ GROUP BY vec_id, label),
b AS (SELECT sha256(string_agg(array_to_string([i::BIGINT::VARCHAR FOR i IN c], ','), ',' ORDER BY p, k)) AS s FROM c@)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT s FROM b) AS codebooks_sha256 FROM e
""")

ORACLE: dict[str, str] = {
    "op3_substring_dedup": _OP3,
    "op4_format_chat": _OP4,
    "op5_mix_sources": _OP5,
    "op7_ngram_jaccard": _OP7,
    "op9_secret_ownership": _OP9,
    "op10_repetition_quality": _OP10,
    "op11_centroid_clusters": _OP11,
    "op12_warc_index": _OP12,
    "op13_vector_codes": _OP13,
}
