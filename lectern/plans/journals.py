"""Registered queries of keyword hits, publishing, corrections, replays and clocks over the driver's tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock, hits, urls
from ..functions import text as T
from ..operators import alerts, corrections, dims, mail, publish, replay, rows, sequence
from .registry import CONFIG, alert_sql, english, query, table

_NEAR = r"[\p{L}\p{N}\p{M}_]"


def _found(source: str, text: str, keywords) -> str:
    """CTE o: rows of source with keyword, i, hit and start of every whole-word match (by Unicode letters, which DuckDB's \\b does not know)."""
    pattern = r"'(?i)\b' || replace(keyword, ' ', '\s+') || '\b'"
    return rf"""k AS (SELECT unnest({list(keywords)}) AS keyword, unnest(range({len(keywords)})) AS no),
m AS (SELECT s.*, keyword, no, regexp_extract_all({text}, {pattern}) AS h, regexp_split_to_array({text}, {pattern}) AS g FROM {source} s, k WHERE regexp_matches({text}, {pattern})),
a AS (SELECT * EXCLUDE (h, g), h[i] AS hit, (list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda y: length(y))), 0))::BIGINT AS start FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM m)),
o AS (SELECT * FROM a WHERE NOT regexp_matches(substr({text}, start, 1), '{_NEAR}') AND NOT regexp_matches(substr({text}, start + length(hit) + 1, 1), '{_NEAR}'))
"""


_WORDS = "list_filter(regexp_split_to_array({0}, '\\s+'), lambda y: y <> '')"
_BEFORE, _AFTER = _WORDS.format("left(chunk_text, start)"), _WORDS.format("substr(chunk_text, start + length(hit) + 1)")


# --- keyword hits ------------------------------------------------------------------------------------------


@query(
    alert_sql().rstrip().rstrip(",")
    + ", "
    + _found("x", "chunk_text", CONFIG.keywords)
    + rf"""SELECT day, slug, chunk, keyword, start, '"' || CASE WHEN len({_BEFORE}) > 3 THEN '...' ELSE '' END || array_to_string(list_concat({_BEFORE}[-3:], [hit], {_AFTER}[1:3]), ' ') || CASE WHEN len({_AFTER}) > 3 THEN '...' ELSE '' END || '"' AS context FROM o"""
)
def keyword_hits(spark, sf_dir):
    windows = alerts.word_windows(english(spark, sf_dir).select("day", "slug", "text"), CONFIG.window, CONFIG.hop)
    return hits.keyword_hits(windows, "chunk_text", CONFIG.keywords, 3).select("day", "slug", "chunk", "keyword", F.col("start").cast("long").alias("start"), "context")


_TALK = ["the", "que", "of the", "und"]


@query(
    r"""WITH c AS (SELECT DISTINCT ON (conv_id, turn) conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM conversations ORDER BY conv_id, turn, role, text),
p AS (SELECT *, sum(length(t) + 1) OVER (PARTITION BY conv_id ORDER BY turn) - length(t) - 1 AS f FROM c WHERE t <> ''),
j AS (SELECT conv_id, string_agg(t, ' ' ORDER BY turn) AS body FROM p GROUP BY conv_id), """
    + _found("j", "body", _TALK)
    + "SELECT o.conv_id, keyword, start, 100 + 4.0 * max(turn) AS seconds FROM o JOIN p ON p.conv_id = o.conv_id AND f <= start GROUP BY o.conv_id, keyword, start"
)
def segment_hits(spark, sf_dir):
    c = rows.keep_first(table(spark, sf_dir, "conversations"), ["conv_id", "turn"], [F.col("role"), F.col("text")])
    segment = F.struct((F.col("turn") * 4.0).alias("start"), (F.col("turn") * 4.0 + 4).alias("end"), F.col("text").alias("text"))
    joined = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(segment)).alias("s")).select("conv_id", hits.joined_segments(F.col("s")).alias("j")).select("conv_id", "j.text", "j.spans")
    found = hits.keyword_hits(joined, "text", _TALK, 0, "spans", F.lit(100.0))
    return found.select("conv_id", "keyword", F.col("start").cast("long").alias("start"), "seconds")


@query(
    "WITH s AS (SELECT item_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM benchmark), "
    + _found("s", "t", ["that", "heron"])
    + r"""SELECT item_id, keyword, n AS word, n * 60.0 / 140 AS seconds, array_to_string(string_split(t, ' ')[greatest(n - 5, 0) + 1 : n + 3], ' ') AS passage
FROM (SELECT *, length(left(t, start)) - length(replace(left(t, start), ' ', '')) AS n FROM o WHERE start = 0 OR substr(t, start, 1) = ' ')"""
)
def replay_passages(spark, sf_dir):
    b = replay.quote_passages(table(spark, sf_dir, "benchmark").select("item_id", "text"), "text", ["that", "heron"], 2.2, 0.9)
    return b.select("item_id", "keyword", "word", "seconds", "passage")


@query("""WITH r AS (SELECT 'd' || c_custkey % 4 AS day, c_custkey AS position, 'Land ' || c_nationkey AS country, 'land-' || c_nationkey % 7 AS slug FROM customer),
w AS (SELECT DISTINCT 'land ' || n_nationkey AS wish, 'land ' || n_nationkey AS k FROM nation UNION SELECT 'LAND-' || n_nationkey, 'land-' || n_nationkey FROM nation),
f AS (SELECT DISTINCT wish, day, position FROM w JOIN r ON k = lower(country) OR k = slug)
SELECT f.*, (SELECT count(DISTINCT day) FROM f g WHERE g.wish = f.wish) AS days FROM f""")
def country_entries(spark, sf_dir):
    k = F.col("c_nationkey")
    r = table(spark, sf_dir, "customer").select(F.concat(F.lit("d"), F.col("c_custkey") % 4).alias("day"), F.col("c_custkey").alias("position"), F.concat(F.lit("Land "), k).alias("country"), F.concat(F.lit("land-"), k % 7).alias("slug"))
    n = table(spark, sf_dir, "nation")
    w = n.select(F.concat(F.lit("land "), "n_nationkey").alias("wish")).unionByName(n.select(F.concat(F.lit("LAND-"), "n_nationkey").alias("wish")))
    return replay.find_country(r, w)


@query("""WITH f AS (SELECT 'out/' || c_mktsegment || '/' || lpad(c_custkey::VARCHAR, 6, '0') AS path, CASE WHEN c_custkey % 3 = 0 THEN 'land-' || c_nationkey ELSE 'M_' || c_custkey END AS stem, 'land-' || c_nationkey AS slug, c_mktsegment AS day FROM customer),
s AS (SELECT 'land-' || n_nationkey AS slug, CASE WHEN n_nationkey % 2 = 0 THEN 'BUILDING' ELSE 'none' END AS d FROM nation)
SELECT slug, path FROM (SELECT s.slug, path, row_number() OVER (PARTITION BY s.slug ORDER BY day <> d, CASE WHEN day = d THEN stem <> s.slug ELSE false END, path) AS n FROM s JOIN f ON f.slug = s.slug OR f.stem = s.slug) WHERE n = 1""")
def stored_speeches(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    slug = F.concat(F.lit("land-"), "c_nationkey")
    files = c.select(F.concat(F.lit("out/"), "c_mktsegment", F.lit("/"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("path"), F.when(F.col("c_custkey") % 3 == 0, slug).otherwise(T.format_id("c_custkey")).alias("stem"), slug.alias("slug"), F.col("c_mktsegment").alias("day"))
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("land-"), "n_nationkey").alias("slug"), F.when(F.col("n_nationkey") % 2 == 0, "BUILDING").otherwise("none").alias("day"))
    return replay.find_speeches(files, n, n)


# --- publishing --------------------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN o_orderkey IS NULL OR o_orderkey % 5 = 0 THEN '2025-09-22' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date, coalesce(o_orderstatus, '') AS country, CASE WHEN o_custkey % 2 = 0 THEN 'link-' || o_custkey END AS link
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') ON l_orderkey = o_orderkey""")
def coding_sheet(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'")
    key = F.col("o_orderkey").cast("string")
    s = o.select(key.alias("id_speech"), F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"), F.col("o_orderstatus").alias("country"), F.col("o_orderkey").alias("position"))
    links = o.where("o_custkey % 2 = 0").select(key.alias("id_speech"), F.concat(F.lit("link-"), "o_custkey").alias("link"))
    codes = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("id_speech"))
    return publish.coding_sheet_rows(codes, s, "2025-09-22", links).select("l_orderkey", "l_linenumber", "date", "country", "link")


@query("""WITH s AS (SELECT 'u' || o_custkey AS url, max_by(o_orderkey, o_orderkey) AS n FROM orders WHERE o_orderkey > 0 AND o_orderpriority <> '1-URGENT' GROUP BY 1)
SELECT c_custkey, CASE WHEN c_custkey % 4 = 1 THEN c_custkey + 7 WHEN c_custkey % 4 = 2 THEN c_custkey + 9 ELSE n END AS kept FROM customer LEFT JOIN s ON url = 'u' || c_custkey""")
def kept_numbers(spark, sf_dir):
    k = F.col("c_custkey")
    items = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("u"), k).alias("url"), F.when(k % 4 == 1, T.format_id(k + 7)).otherwise("").alias("id_speech"), F.when(k % 4 == 2, T.format_id(k + 9)).otherwise(F.concat(F.lit("slug"), k)).alias("stem"))
    sheet = table(spark, sf_dir, "orders").select(F.concat(F.lit("u"), "o_custkey").alias("url"), F.when(F.col("o_orderpriority") == "1-URGENT", "none").otherwise(T.format_id("o_orderkey")).alias("id_speech"), F.col("o_orderkey").alias("position"))
    return publish.kept_numbers(items, sheet, "url", "position").select("c_custkey", "kept")


@query("SELECT c_custkey, coalesce(r, 10000)::BIGINT AS rank FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS r FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey")
def journal_rank(spark, sf_dir):
    j = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("position"))
    return publish.journal_rank(table(spark, sf_dir, "customer").select("c_custkey"), j, "c_custkey").select("c_custkey", "rank")


@query("""WITH o AS (SELECT o_custkey % 50 AS day, o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderstatus END AS part FROM orders),
l AS (SELECT *, last_value(nullif(part, '') IGNORE NULLS) OVER (PARTITION BY day ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM o)
SELECT day, o_orderkey, '# ' || part AS line FROM l WHERE part <> '' AND part IS DISTINCT FROM seen UNION ALL SELECT day, o_orderkey, 's' || o_orderkey FROM l""")
def journal_lines(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("day"), k.alias("position"), F.when(k % 7 == 0, "").otherwise(F.col("o_orderstatus")).alias("part"), F.concat(F.lit("s"), k).alias("slug"))
    return publish.journal_lines(o).select("day", F.col("position").alias("o_orderkey"), "line")


@query(r"""WITH g AS (SELECT trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') AS slug, min(p_partkey) AS pos FROM part GROUP BY 1),
l AS (SELECT p_partkey, 'The ' || CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_name END AS title FROM part),
k AS (SELECT *, trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') AS a FROM l),
w AS (SELECT *, array_to_string(list_filter(string_split(a, '-'), lambda x: x NOT IN ('of', 'the', 'and', 'de', 'la', 'a')), '-') AS b FROM k)
SELECT p_partkey, coalesce(x.slug, y.slug, nullif(a, ''), b) AS slug FROM w LEFT JOIN g x ON x.slug = a LEFT JOIN g y ON y.slug = b""")
def listing_slugs(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    slugs = p.groupBy(T.ascii_slug("p_type").alias("slug")).agg(F.min("p_partkey").alias("position"))
    l = p.select("p_partkey", F.concat(F.lit("The "), F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.col("p_name"))).alias("title"))
    return publish.resolve_listings(l, "p_partkey", "title", slugs).select("p_partkey", "slug")


@query("""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'N' || c_custkey % 100 END AS name, 'L' || c_nationkey AS country, CASE WHEN c_custkey % 3 = 0 THEN 'Minister' ELSE '' END AS rank, CASE WHEN c_custkey % 2 = 0 THEN 'His Excellency' ELSE 'President' END AS title FROM customer),
b AS (SELECT lower(name) AS n FROM r WHERE name <> '' GROUP BY 1 HAVING count(DISTINCT lower(country)) >= 3),
s AS (SELECT *, CASE WHEN name = '' OR lower(name) IN (SELECT n FROM b) THEN country ELSE name END AS who FROM r),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(who), lower(country) ORDER BY c_custkey) AS n FROM s) WHERE n = 1)
SELECT c_custkey, rtrim(who || ' | ' || country || ' | ' || CASE WHEN rank <> '' THEN rank WHEN title = 'His Excellency' THEN '' ELSE title END, ' |') AS line FROM f""")
def speaker_lines(spark, sf_dir):
    k = F.col("c_custkey")
    r = table(spark, sf_dir, "customer").select(k.alias("position"), F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("N"), k % 100)).alias("name"), F.concat(F.lit("L"), "c_nationkey").alias("country"), F.when(k % 3 == 0, "Minister").otherwise("").alias("rank"), F.when(k % 2 == 0, "His Excellency").otherwise("President").alias("speaker_title"))
    leaked = dims.leaked_names(r.where("name <> ''"))
    return publish.speaker_lines(r, leaked).select(F.col("position").alias("c_custkey"), "line")


@query("SELECT coalesce(nullif(lang, 'fr'), '?') AS day, count(*) AS speakers, min(doc_id) AS first FROM documents GROUP BY 1")
def available_days(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.when(F.col("lang") != "fr", F.col("lang")).otherwise("").alias("day"), F.col("doc_id").alias("position"))
    return publish.available_days(d)


@query("""SELECT count(*) AS fetched, count_if(k = 'ok') AS ok, count_if(k = 'skipped') AS skipped, count_if(k = 'error') AS errors FROM (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'error' WHEN o_orderstatus = 'F' THEN 'skipped' WHEN o_custkey % 2 = 0 THEN 'ok' WHEN o_orderstatus = 'P' THEN 'skipped' ELSE 'other' END AS k FROM orders)""")
def extract_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    skip = F.when(F.col("o_orderstatus") == "F", "already extracted").when(F.col("o_orderstatus") == "P", "too short")
    return publish.extract_summary(o, publish.outcome(F.when(F.col("o_orderkey") % 13 == 0, "404"), F.coalesce(skip, F.lit("")), F.col("o_custkey") % 2 == 0))


@query("SELECT 's' || user_id % 30 AS speaker, count(*) AS quotes FROM events WHERE user_id % 30 <> 0 GROUP BY 1")
def pending_quotes(spark, sf_dir):
    who = F.col("user_id") % 30
    e = table(spark, sf_dir, "events").select(F.when(who == 0, "Unknown").otherwise(F.concat(F.lit("s"), who)).alias("speaker"))
    return publish.pending_quotes(e)


@query("SELECT lang, source, count(*) AS rows, CASE WHEN min(doc_id) = max(doc_id) THEN 'M_' || min(doc_id) ELSE 'M_' || min(doc_id) || '..M_' || max(doc_id) END AS ids FROM documents GROUP BY ALL")
def id_summary(spark, sf_dir):
    return publish.id_summary(table(spark, sf_dir, "documents").select("lang", "source", F.col("doc_id").alias("number")), ["lang", "source"])


@query("SELECT o_orderkey FROM orders WHERE (o_orderkey % 7 = 0 OR strftime(o_orderdate, '%Y-%m') = '1995-03') AND o_orderstatus = 'F'")
def day_filter(spark, sf_dir):
    day = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    return publish.of_day(table(spark, sf_dir, "orders").withColumn("day", day), "1995-03", "F", slug_column="o_orderstatus").select("o_orderkey")


@query("""WITH o AS (SELECT c_mktsegment || '-' || o_orderkey % 5 AS slug FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F' AND o_orderkey % 40 = 0)
SELECT c_custkey FROM (SELECT c_custkey, c_mktsegment || '-' || c_custkey % 5 AS slug FROM customer) WHERE slug IN ('BUILDING-1', 'MACHINERY-2', 'FURNITURE-0') OR slug NOT IN (SELECT slug FROM o)""")
def to_extract(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    slug = lambda number: F.concat_ws("-", "c_mktsegment", number % 5)
    stored = o.where("o_orderkey % 40 = 0").join(c, F.col("c_custkey") == F.col("o_custkey")).select(slug(F.col("o_orderkey")).alias("slug"), F.when(F.col("o_orderstatus") == "F", " EN ").otherwise("fr").alias("language"))
    return publish.to_extract(c.select(slug(F.col("c_custkey")).alias("slug"), "c_custkey"), stored, ["BUILDING-1", "MACHINERY-2", "FURNITURE-0"]).select("c_custkey")


@query("SELECT DISTINCT 'M_' || doc_id AS id_speech FROM documents UNION SELECT 'M_' || doc_id FROM labels")
def coded_ids(spark, sf_dir):
    ids = lambda t: table(spark, sf_dir, t).select(T.format_id("doc_id").alias("id_speech"))
    return publish.coded_ids(ids("documents"), ids("labels"))


@query("""WITH k AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 'given-' || l_orderkey % 100 WHEN l_linenumber % 5 = 0 THEN '' ELSE 'M_' || l_orderkey || '_' || l_returnflag END AS key FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY l_orderkey, l_linenumber) AS r FROM k WHERE key <> '')
SELECT l_orderkey, l_linenumber FROM n WHERE r = 1 AND key NOT IN (SELECT 'M_' || o_orderkey || '_R' FROM orders)""")
def coding_append(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.format_id("l_orderkey").alias("id_speech"), F.when(F.col("l_linenumber") % 5 == 0, "").otherwise(F.col("l_returnflag")).alias("indicator"), F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("given-"), F.col("l_orderkey") % 100)).otherwise("").alias("extract_id"))
    old = table(spark, sf_dir, "orders").select(T.format_id("o_orderkey").alias("id_speech"), F.lit("R").alias("indicator"), F.lit("").alias("extract_id"))
    key = F.coalesce(publish.extract_key(F.col("id_speech"), F.col("indicator"), F.col("extract_id")), F.lit(""))
    return rows.append_missing(old, l, key, [F.col("l_orderkey"), F.col("l_linenumber")]).select("l_orderkey", "l_linenumber")


@query(alert_sql() + "SELECT day, t, string_agg(DISTINCT keyword, ', ' ORDER BY keyword) AS keywords FROM p GROUP BY day, t ORDER BY day, t LIMIT 50")
def sample_messages(spark, sf_dir):
    return publish.sample_messages(alerts.simulate(english(spark, sf_dir), CONFIG)["picks"])


# --- corrections -------------------------------------------------------------------------------------------

_FIX = """WITH f AS (SELECT event_id AS position, ts AS f_start, ts + INTERVAL 5 MINUTE AS f_end, 'fixed-' || user_id AS name, CASE WHEN event_id % 2 = 0 THEN '' ELSE 'Chair' END AS title FROM events WHERE event_type = 'signup'),
e AS (SELECT event_id, ts, 'fixed-' || user_id AS speaker, 'Guest' AS speaker_title FROM events),
j AS (SELECT e.event_id, min_by({'n': name, 't': title}, position) AS h FROM e JOIN f ON e.ts >= f_start AND e.ts < f_end GROUP BY 1),
c AS (SELECT e.*, h, h IS NOT NULL AND NOT (speaker = h.n AND (h.t = '' OR speaker_title = h.t)) AS changed FROM e LEFT JOIN j USING (event_id)) """


def _fixed(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    name = F.concat(F.lit("fixed-"), "user_id")
    f = e.where("event_type = 'signup'").select(F.col("event_id").alias("position"), F.col("ts").alias("start"), (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("end"), name.alias("name"), F.when(F.col("event_id") % 2 == 0, "").otherwise("Chair").alias("title"))
    out = corrections.fixed_events(e.select("event_id", F.col("ts").alias("timestamp"), name.alias("speaker"), F.lit("Guest").alias("speaker_title")), f, "event_id")
    return out, f


@query(_FIX + "SELECT event_id, changed, CASE WHEN changed THEN h.n ELSE speaker END AS speaker, CASE WHEN changed AND h.t <> '' THEN h.t ELSE speaker_title END AS speaker_title FROM c")
def fixed_events(spark, sf_dir):
    return _fixed(spark, sf_dir)[0].select("event_id", "changed", "speaker", "speaker_title")


@query(_FIX + "SELECT position, (SELECT count(*) FROM c WHERE changed AND ts >= f_start AND ts < f_end) AS changes FROM f")
def changes_of_fixes(spark, sf_dir):
    out, f = _fixed(spark, sf_dir)
    return corrections.changes_by_fix(out.where("changed"), f)


_CUTS = [(40.0, "Bea", "Peru", "Minister"), (70.0, "ana", "", ""), (90.0, "Cai", "", "Envoy")]
_SPLIT = """WITH e AS (SELECT event_id, nullif(value, 0) AS seconds, CASE WHEN event_type = 'error' OR value = 0 THEN 'Ana' WHEN value >= 90 THEN 'Cai' WHEN value >= 70 THEN 'Ana' WHEN value >= 40 THEN 'Bea' ELSE 'Ana' END AS owner FROM events) """


@query(_SPLIT + "SELECT event_id, owner AS speaker, CASE owner WHEN 'Bea' THEN 'Minister, Peru' WHEN 'Cai' THEN 'Envoy' ELSE 'old' END AS speaker_title FROM e")
def split_speech(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.nullif("value", F.lit(0.0)).alias("seconds"), F.lit("Ana").alias("speaker"), F.lit("old").alias("speaker_title"))
    return corrections.retagged(corrections.split_rows(e, _CUTS, "Ana", movable=F.col("event_type") != "error"), "Ana").select("event_id", "speaker", "speaker_title")


@query(_SPLIT + "SELECT owner, count(*) AS rows, min(seconds) AS first, max(seconds) AS last FROM e GROUP BY owner")
def split_plan(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", F.nullif("value", F.lit(0.0)).alias("seconds"))
    return corrections.split_plan(corrections.split_rows(e, _CUTS, "Ana", movable=F.col("event_type") != "error"))


@query("""SELECT speaker, row_number() OVER (PARTITION BY lower(speaker) ORDER BY late, event_id) AS place, quote FROM (SELECT CASE WHEN event_type = 'error' THEN 'S' ELSE 's' END || user_id AS speaker, event_id, event_type <> 'error' AS late, props AS quote FROM events)""")
def quotes_put_back(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    part = lambda cond, s: e.where(cond).select(F.concat(F.lit(s), "user_id").alias("speaker"), F.col("event_id").alias("position"), F.col("props").alias("quote"))
    return corrections.quotes_put_back(part("event_type <> 'error'", "s"), part("event_type = 'error'", "S"))


@query("""WITH a AS (SELECT user_id, event_id, floor(value)::BIGINT AS line FROM events WHERE event_type <> 'error'), b AS (SELECT user_id, event_id, floor(value)::BIGINT AS line FROM events WHERE event_type = 'error'),
u AS (SELECT *, 0 AS late FROM b UNION ALL SELECT *, 1 FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = a.user_id AND b.line = a.line))
SELECT 's' || user_id AS speaker, line, row_number() OVER (PARTITION BY user_id ORDER BY late, event_id) AS place FROM u""")
def lines_put_back(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", F.concat(F.lit("s"), "user_id").alias("speaker"), F.col("event_id").alias("position"), F.floor("value").cast("long").alias("line"))
    part = lambda cond: e.where(cond).drop("event_type")
    return corrections.lines_put_back(part("event_type <> 'error'"), part("event_type = 'error'"), ["line"])


@query("""WITH g AS (SELECT *, CASE WHEN value < lag(value) OVER w - 30 THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM g) SELECT user_id, event_id FROM r WHERE run = (SELECT max(run) FROM r q WHERE q.user_id = r.user_id)""")
def last_run(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    r = sequence.long_runs(e, ["user_id"], F.to_date("ts"), [F.col("ts"), F.col("event_id")], "value", lambda before, now: now < before - 30)
    return publish.select_run(r, "user_id", -1).select("user_id", "event_id")


# --- rows with one key -------------------------------------------------------------------------------------


@query("""WITH o AS (SELECT c_custkey AS k, 'old-' || c_nationkey AS v FROM customer WHERE c_custkey % 3 > 0), n AS (SELECT o_custkey AS k, max_by(o_orderpriority, o_orderkey) AS v, min(o_orderkey) AS p FROM orders GROUP BY 1)
SELECT coalesce(o.k, n.k) AS slug, coalesce(n.v, o.v) AS v, CASE WHEN o.k IS NOT NULL THEN o.k ELSE (SELECT max(k) FROM o) + 1 + p END AS position FROM o FULL JOIN n ON o.k = n.k""")
def upserted(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_custkey % 3 > 0")
    old = c.select(F.col("c_custkey").cast("string").alias("slug"), F.col("c_custkey").alias("position"), F.concat(F.lit("old-"), "c_nationkey").alias("v"))
    new = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("slug"), F.col("o_orderkey").alias("position"), F.col("o_orderpriority").alias("v"))
    return rows.upsert(old, new, "slug", "position").select(F.col("slug").cast("long").alias("slug"), "v", "position")


@query("""WITH l AS (SELECT c_custkey AS slug, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS name, c_mktsegment AS country FROM customer WHERE c_custkey % 2 = 0)
SELECT o_orderkey, coalesce(nullif(l.name, ''), 'page') AS name, CASE WHEN o_orderstatus = 'F' THEN coalesce(l.country, 'Unknown') ELSE 'Own' END AS country FROM orders LEFT JOIN l ON slug = o_custkey""")
def listing_overlay(spark, sf_dir):
    pages = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("slug"), F.lit("page").alias("name"), F.when(F.col("o_orderstatus") == "F", "Unknown").otherwise("Own").alias("country"))
    c = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0")
    listing = c.select(F.col("c_custkey").alias("slug"), F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("country"))
    return mail.overlay(pages, listing).select("o_orderkey", "name", "country")


@query("""WITH s AS (SELECT l_orderkey, l_linenumber, l_discount * 10 AS s FROM lineitem), r AS (SELECT *, row_number() OVER w AS n, lead(s) OVER w AS second FROM s WINDOW w AS (PARTITION BY l_orderkey ORDER BY s DESC, l_linenumber))
SELECT l_orderkey, l_linenumber FROM r WHERE n = 1 AND s >= 0.62 AND (second IS NULL OR second < 0.62 OR s - second >= 0.08)""")
def best_with_margin(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("s"))
    return dims.best_with_margin(l, "l_orderkey", "s", 0.62, 0.08, [F.col("l_linenumber")]).select("l_orderkey", "l_linenumber")


@query("""WITH RECURSIVE s AS (SELECT l_orderkey AS k, l_quantity AS a, l_quantity + l_linenumber * 2 AS b, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_quantity + l_linenumber * 2, l_linenumber) AS n, 't' || l_linenumber AS t FROM lineitem),
f AS (SELECT k, n, CASE WHEN a < 40 AND b > 10 THEN greatest(b, 10.0) ELSE 10.0 END AS c, CASE WHEN a < 40 AND b > 10 THEN [t] ELSE [] END AS g FROM s WHERE n = 1
UNION ALL SELECT f.k, s.n, CASE WHEN s.a < 40 AND s.b > 10 AND (len(g) = 0 OR s.b > c + 0.3) THEN greatest(c, s.b) ELSE c END, CASE WHEN s.a < 40 AND s.b > 10 AND (len(g) = 0 OR s.b > c + 0.3) THEN list_append(g, s.t) ELSE g END FROM f JOIN s ON s.k = f.k AND s.n = f.n + 1)
SELECT k AS l_orderkey, array_to_string(max_by(g, n), ' ') AS passage FROM f GROUP BY k""")
def covered_passages(spark, sf_dir):
    q, n = F.col("l_quantity").cast("double"), F.col("l_linenumber")
    line = F.struct(q.alias("start"), (q + n * 2).alias("end"), F.concat(F.lit("t"), n.cast("string")).alias("text"))
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("s"))
    return l.select("l_orderkey", sequence.covered_text(F.col("s"), F.lit(10.0), F.lit(40.0)).alias("passage"))


@query("""WITH RECURSIVE s AS (SELECT l_orderkey AS k, l_quantity::INTEGER AS a, l_quantity::INTEGER + l_linenumber AS b, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity::INTEGER, -l_linenumber) AS n FROM lineitem),
f AS (SELECT k, n, b AS last, a || '-' || b AS kept FROM s WHERE n = 1 UNION ALL SELECT f.k, s.n, CASE WHEN s.a < last THEN last ELSE s.b END, CASE WHEN s.a < last THEN kept ELSE kept || ' ' || s.a || '-' || s.b END FROM f JOIN s ON s.k = f.k AND s.n = f.n + 1)
SELECT k AS l_orderkey, arg_max(kept, n) AS spans FROM f GROUP BY k""")
def merged_spans(spark, sf_dir):
    a = F.col("l_quantity").cast("int")
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(a.alias("start"), (a + F.col("l_linenumber")).cast("int").alias("end"))).alias("s"))
    return l.select("l_orderkey", F.array_join(F.transform(sequence.merge_spans(F.col("s")), lambda x: F.concat_ws("-", x["start"], x["end"])), " ").alias("spans"))


@query(r"""WITH RECURSIVE s AS (SELECT conv_id AS k, text AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM conversations WHERE text <> ''),
r AS (SELECT k, n, 0 AS j, left(t, 600) AS piece, regexp_replace(substr(t, 601), '^\s+', '') AS rest FROM s UNION ALL SELECT k, n, j + 1, left(rest, 600), regexp_replace(substr(rest, 601), '^\s+', '') FROM r WHERE rest <> ''),
m AS (SELECT k, j, piece, row_number() OVER (PARTITION BY k ORDER BY n, j) AS n FROM r),
f AS (SELECT k, n, 1 AS chunk, piece AS open FROM m WHERE n = 1 UNION ALL SELECT f.k, m.n, chunk + CASE WHEN m.j = 0 AND length(open) + 2 + length(piece) <= 600 THEN 0 ELSE 1 END, CASE WHEN m.j = 0 AND length(open) + 2 + length(piece) <= 600 THEN open || chr(10) || chr(10) || piece ELSE piece END FROM f JOIN m ON m.k = f.k AND m.n = f.n + 1)
SELECT k AS conv_id, chunk::INTEGER AS chunk, arg_max(open, n) AS text FROM f GROUP BY k, chunk""")
def packed_chunks(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: x["text"]).alias("p"))
    return c.select("conv_id", F.posexplode(sequence.pack(F.col("p"), 600)).alias("at", "text")).select("conv_id", (F.col("at") + 1).alias("chunk"), "text")


# --- clocks and addresses ----------------------------------------------------------------------------------


@query("""WITH e AS (SELECT event_id, ts, floor(epoch(ts))::BIGINT AS s, value FROM events)
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' || chr(10) || strftime(timezone('America/New_York', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch(timezone('America/New_York', timezone('UTC', ts))) - epoch(ts) = -14400 THEN ' EDT' ELSE ' EST' END || chr(10)
|| strftime(timezone('Europe/Madrid', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch(timezone('Europe/Madrid', timezone('UTC', ts))) - epoch(ts) = 7200 THEN ' CEST' ELSE ' CET' END AS lines,
CASE WHEN (s - 1704067200) % 200000 <= 129600 THEN ((s - 1704067200) % 200000)::DOUBLE ELSE 0.0 END AS origin, (s - 1704067200) % 200000 <= 129600 AS reliable, s % 500 < 360 AS fresh, CASE WHEN hour(ts) % 2 = 1 THEN 'B' ELSE 'A' END AS slot,
round(greatest(0.0, 100.0 + 64000 * value / 32000.0 - 20.0 + 3.0), 6) AS video FROM e""")
def clock_columns(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    s = F.unix_timestamp(ts)
    live = clock.live_origin(s - (s - 1704067200) % 200000, s)
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", clock.when_lines(ts).alias("lines"), live["seconds"].alias("origin"), live["reliable"].alias("reliable"), clock.is_fresh(s - s % 500, s, 180).alias("fresh"), clock.account_slot(F.hour(ts), True).alias("slot"),
        F.round(clock.video_seconds(F.lit(100.0), 64000 * F.col("value"), F.lit(640000), F.lit(3.0), 16000), 6).alias("video"),
    )


@query("""WITH d AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN '' WHEN 2 THEN ' 2020-' || strftime(o_orderdate, '%m-%d') ELSE 'soon' END AS day FROM orders)
SELECT o_orderkey, CASE WHEN regexp_full_match(trim(day), '\\d{4}-\\d\\d-\\d\\d') AND substr(trim(day), 6) IN ('09-22', '09-23') THEN '2026-' || substr(trim(day), 6) ELSE trim(day) END AS day,
CASE WHEN regexp_full_match(trim(day), '\\d{4}-\\d\\d-\\d\\d') THEN epoch(trim(day)::TIMESTAMP)::BIGINT END AS moment FROM d""")
def session_days(spark, sf_dir):
    k, iso = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd")
    day = F.when(k == 0, iso).when(k == 1, "").when(k == 2, F.concat(F.lit(" 2020-"), F.substring(iso, 6, 5))).otherwise("soon")
    o = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"))
    return o.select("o_orderkey", clock.session_day("day", ["2026-09-22", "2026-09-23"]).alias("day"), F.unix_timestamp(clock.parse_utc("day")).alias("moment"))


@query(r"""WITH u AS (SELECT page_id, url, trim(url) AS u FROM pages),
x AS (SELECT *, regexp_extract(u, '^([^?#]*)', 1) AS base, regexp_extract(u, '(#.*)$', 1) AS fragment, list_filter(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: p <> '' AND split_part(p, '=', 1) <> 'page') AS pairs FROM u)
SELECT page_id, CASE WHEN regexp_matches(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+') THEN base || '?' || array_to_string(list_append(pairs, 'page=7'), '&') || fragment END AS paged, regexp_extract(url, '([^/?#]+)/*(?:[?#].*)?$', 1) AS tail, contains(url, '/en/8/') AS of_session FROM x""")
def page_addresses(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.with_query("url", "page", F.lit(7)).alias("paged"), urls.tail_segment("url").alias("tail"), urls.of_session("url", 8).alias("of_session"))


@query("""WITH g AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT user_id, event_type AS speaker, min(value) AS first, max(value) AS last, count(*) AS chunks FROM r WHERE event_type <> 'error' GROUP BY user_id, run, event_type""")
def speaker_ranges(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "value", F.when(F.col("event_type") == "error", "Unknown").otherwise(F.col("event_type")).alias("speaker"))
    return replay.speaker_ranges(e, "user_id", "event_id", "value", "value", F.floor(F.col("event_id") / 10_000))


@query(r"""WITH e AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, event_type AS keyword, CASE WHEN user_id % 3 = 0 THEN 'unknown' ELSE 'S' || event_id % 2 END AS speaker, ts,
CASE WHEN event_id % 2 = 0 THEN 'H. E.' END AS title, 'A <' || event_type || '> & a passage: ' || event_id || ', ' || upper(event_type) AS passage, CASE WHEN event_id % 3 = 0 THEN 'about ' || event_type END AS context, CASE WHEN event_id % 5 = 0 THEN 'https://x.example/?a=1&b=' || event_id END AS url FROM events),
k AS (SELECT user_id, day, string_agg(keyword, ', ' ORDER BY f) AS words, string_agg(keyword, '|' ORDER BY length(keyword) DESC, keyword) AS pattern FROM (SELECT user_id, day, keyword, min(event_id) AS f FROM e GROUP BY ALL) GROUP BY ALL),
s AS (SELECT user_id, day, string_agg(speaker, ', ' ORDER BY f) AS names FROM (SELECT user_id, day, speaker, min(event_id) AS f FROM e WHERE speaker <> 'unknown' GROUP BY ALL) GROUP BY ALL),
t AS (SELECT DISTINCT user_id, day, title AS titles FROM e WHERE title IS NOT NULL),
m AS (SELECT e.* FROM e WHERE event_id = (SELECT min(x.event_id) FROM e x WHERE x.user_id = e.user_id AND x.day = e.day)),
z AS (SELECT user_id, day, words, pattern, names, titles, url, coalesce(context, passage) AS p, CASE WHEN context IS NULL THEN 'Chunk' ELSE 'Context' END AS label, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS utc,
strftime(timezone('America/New_York', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') || ' EST' AS ny, strftime(timezone('Europe/Madrid', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') || ' CET' AS madrid FROM m JOIN k USING (user_id, day) LEFT JOIN s USING (user_id, day) LEFT JOIN t USING (user_id, day)),
h AS (SELECT *, replace(replace(replace(p, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS hp, replace(url, '&', '&amp;') AS hu FROM z)
SELECT user_id, day, 'KEYWORD_DETECTED | ' || words || coalesce(' | ' || names, '') AS subject,
'Keyword(s): ' || words || chr(10) || 'When: ' || utc || chr(10) || 'New York: ' || ny || chr(10) || 'Madrid: ' || madrid || coalesce(chr(10) || 'YouTube: ' || url, '') || coalesce(chr(10) || 'Speaker: ' || names, '') || CASE WHEN names IS NOT NULL AND titles IS NOT NULL THEN chr(10) || 'Title: ' || titles ELSE '' END
|| chr(10) || chr(10) || label || ':' || chr(10) || regexp_replace(p, '\b(' || pattern || ')\b', '**\1**', 'gi') AS text,
'<div style="font-family:sans-serif;max-width:40em;line-height:1.45"><p><b>Keyword(s):</b> ' || words || '</p><p><b>When:</b> ' || utc || '<br><b>New York:</b> ' || ny || '<br><b>Madrid:</b> ' || madrid || '</p>' || coalesce('<p><b>YouTube:</b> <a href="' || hu || '">' || hu || '</a></p>', '')
|| coalesce('<p><b>Speaker:</b> ' || names || '</p>', '') || CASE WHEN names IS NOT NULL AND titles IS NOT NULL THEN '<p><b>Title:</b> ' || titles || '</p>' ELSE '' END || '<p><b>' || label || ':</b></p><blockquote style="margin:0;border-left:3px solid #222;padding:0.4em 0.8em">'
|| regexp_replace(hp, '\b(' || pattern || ')\b', '<strong>\1</strong>', 'gi') || '</blockquote></div>' AS html FROM h""")
def alert_emails_text(spark, sf_dir):
    u, k, e = F.col("user_id"), F.col("event_id"), F.col("event_type")
    d = table(spark, sf_dir, "events").select(
        u, F.date_format("ts", "yyyy-MM-dd").alias("day"), k.alias("position"), e.alias("keyword"), F.when(u % 3 == 0, "unknown").otherwise(F.concat(F.lit("S"), k % 2)).alias("speaker"),
        F.when(k % 2 == 0, "H. E.").alias("speaker_title"), F.col("ts").cast("timestamp").alias("timestamp"), F.concat(F.lit("A <"), e, F.lit("> & a passage: "), k, F.lit(", "), F.upper(e)).alias("transcript"),
        F.when(k % 3 == 0, F.concat(F.lit("about "), e)).alias("mail_context"), F.when(k % 5 == 0, F.concat(F.lit("https://x.example/?a=1&b="), k)).alias("watch_url"),
    )
    return mail.alert_emails(d, ["user_id", "day"], "position")


