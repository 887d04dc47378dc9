"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import quality_rules as Q

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _rules() -> str:
    out = []
    for r in Q.RULES:
        out += [f"{r.measure} >= {r.low}"] if r.low is not None else []
        out += [f"{r.measure} <= {r.high}"] if r.high is not None else []
    return " AND ".join(out)


_STOP = ", ".join(f"'{w}'" for w in sorted({w for words in Q.STOP_WORDS.values() for w in words}))

OP1 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, hash(w[i : i + 19]) AS k, w[i : i + 19] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k, s ORDER BY doc_id, i) AS n FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE n > 1),
e AS (SELECT doc_id, count(*) AS n_removed, list(p) AS ps FROM c GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN n_removed IS NULL THEN array_to_string(w, ' ') ELSE coalesce((SELECT string_agg(x, ' ' ORDER BY j) FROM (SELECT unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j) WHERE NOT list_contains(ps, j)), '') END) AS kept_sha256
FROM d LEFT JOIN e USING (doc_id)
"""

OP4 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
k AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS k FROM g),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM k),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r WHERE n > 1) GROUP BY doc_id),
b AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, greatest(len(w), 1)::DOUBLE AS n, w
  FROM d LEFT JOIN c USING (doc_id)),
m AS (
  SELECT *, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, word_chars / n AS mean_word_chars, n_symbols / n AS symbol_ratio,
    n_repeat_words / n AS repeat_ratio, (len(l) - len(list_distinct(l))) / greatest(len(l), 1) AS dup_line_ratio,
    len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) / n AS stop_ratio,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed
  FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND {_rules()}) AS kept FROM m
"""

OP6 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
e AS (SELECT doc_id, q, substr(h, 2 * q + 1, 498) AS h FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49, 200)) AS q FROM d WHERE len(h) >= 100)),
g AS (SELECT doc_id, q + s AS s, substr(h, 2 * s + 1, 100) AS k FROM (SELECT doc_id, q, h, unnest(range(0, len(h) // 2 - 49)) AS s FROM e)),
m AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY k) AS f FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM m WHERE f < doc_id),
l AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS step FROM c),
n AS (SELECT doc_id, count(*) AS n_removed, count_if(step IS NULL OR step > 1) AS n_spans FROM l GROUP BY doc_id),
b AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS p FROM d JOIN n USING (doc_id))),
k AS (SELECT doc_id, string_agg(x, '' ORDER BY p) AS h FROM b ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, (len(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n_removed IS NULL THEN d.h ELSE coalesce(k.h, '') END)) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""

OP8 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
s AS (SELECT DISTINCT doc_id, s FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM w UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d AND r.c < e.b)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.c)::BIGINT AS component_id, w.doc_id = min(r.c) AS kept
FROM w JOIN r ON r.d = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id, n.n
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, {ALNUM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {ALNUM_WORDS} AS w FROM benchmark),
bm AS (SELECT item_id, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM bm)),
g AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS k
      FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bm) WHERE len(w) >= m)),
h AS (SELECT doc_id, item_id, i, g.m FROM g JOIN p ON g.k = p.k AND g.m = p.m),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS q FROM h) GROUP BY doc_id),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN x USING (doc_id)
"""

OP10 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS kept FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM k
"""

OP11 = rf"""
WITH t AS (SELECT doc_id, unnest({ALNUM_WORDS}) AS t FROM documents),
f AS (SELECT doc_id, t, count(*) AS tf FROM t GROUP BY doc_id, t),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
c AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM n),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM f GROUP BY t), c),
q AS (SELECT DISTINCT item_id, unnest({ALNUM_WORDS}) AS t FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN f USING (t) JOIN w USING (t) JOIN n USING (doc_id), c GROUP BY item_id, doc_id),
r AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

RUNS = rf"regexp_extract_all({LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')"
# The checksum is folded over half bytes; T is its table for these.
_STEP = "lambda c, b: xor(c >> 4, T[(xor(c, b) & 15) + 1])"
OP12 = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(16), lambda i: list_reduce([i::BIGINT, 1, 1, 1, 1], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS T),
o AS (SELECT doc_id, r, count(*) AS k FROM (SELECT doc_id, unnest({RUNS}) AS r FROM documents) WHERE length(r) >= 7 GROUP BY doc_id, r),
x AS (SELECT r, k, hex(encode(doc_id::VARCHAR || ':' || r)) AS x FROM o),
y AS (SELECT r, k, list_transform(range(len(x)), lambda i: (strpos('0123456789ABCDEF', x[(i // 2) * 2 + 2 - i % 2]) - 1)::BIGINT) AS b FROM x),
h AS (SELECT r, k, xor(list_reduce(list_prepend(4294967295::BIGINT, b), {_STEP}), 4294967295::BIGINT)::BIGINT AS h FROM y, crc),
v AS (SELECT word, sum(k)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, k FROM h)
      WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
d AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS z FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
p AS (SELECT x.word AS a, y.word AS b FROM d x JOIN d y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
      UNION SELECT v.word, d.word FROM v JOIN d ON v.word = d.a || d.z UNION SELECT d.word, v.word FROM v JOIN d ON v.word = d.a || d.z),
m AS (SELECT p.a AS word, p.b AS other, v.n AS m, row_number() OVER (PARTITION BY p.a ORDER BY v.n DESC, encode(p.b)) AS k, count(*) OVER (PARTITION BY p.a) AS n_near FROM p JOIN v ON v.word = p.b),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 10 * v.n THEN other END AS form, (CASE WHEN m >= 10 * v.n THEN m END)::BIGINT AS form_n FROM v LEFT JOIN m ON m.word = v.word AND k = 1),
c AS (SELECT word, word AS root, 0 AS step FROM f UNION ALL SELECT c.word, f.form, step + 1 FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, g.root FROM f JOIN (SELECT word, arg_max(root, step) AS root FROM c GROUP BY word) g USING (word)
"""

ORACLES = {"op1_substring_dedup": OP1, "op4_quality_rules": OP4, "op6_suffix_dedup": OP6, "op8_near_dedup": OP8, "op9_decontamination": OP9, "op10_warc": OP10, "op11_lexical_search": OP11, "op12_spelling_groups": OP12}
