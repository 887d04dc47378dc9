"""The registered queries of the speech-analytics operators over the driver's tables, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import text as T
from ..operators import alerts, codebook, cooldown, corrections, dims, rollup, rows, sequence

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows of short columns from which much is made, dealt over all tasks by key: a small file or row group is else one task, whatever is made of its rows."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


# --- alert simulation --------------------------------------------------------------------------------------

CONFIG = alerts.AlertConfig({"reform": ("the", "of the", "and"), "peace": ("for", "this", "Is"), "again": ("the", "with")})
DAYS = [f"2025-09-{20 + i}" for i in range(6)]


def speeches(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    day = F.concat(F.lit("2025-09-"), (F.col("doc_id") % 6 + 20).cast("string"))
    return d.select(day.alias("day"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("slug"), "text", F.col("lang").alias("language"), "source")


def english(spark, sf_dir) -> DataFrame:
    return alerts.english_only(speeches(spark, sf_dir))


def expected(spark, sf_dir) -> DataFrame:
    return speeches(spark, sf_dir).groupBy("day").agg(F.count(F.lit(1)).alias("expected"))


def _hit(k: str) -> str:
    needle = " " + "  ".join(k.lower().split()) + " "
    return f"SELECT '{k}' AS keyword, ((length(x) - length(replace(x, '{needle}', ''))) // {len(needle)})::BIGINT AS hits"


def alert_sql(config=CONFIG) -> str:
    union = " UNION ALL ".join(_hit(k) for k in config.keywords)
    return rf"""
WITH RECURSIVE s AS (SELECT '2025-09-' || (doc_id % 6 + 20) AS day, lpad(doc_id::VARCHAR, 12, '0') AS slug, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents WHERE lang = 'en'),
n AS (SELECT *, CASE WHEN len(w) > 0 THEN 1 + ceil(greatest(len(w) - {config.window}, 0) / {config.hop}.0)::BIGINT ELSE 0 END AS n FROM s),
b AS (SELECT *, coalesce(sum(n * {config.hop} + {config.gap}) OVER (PARTITION BY day ORDER BY slug ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM n),
c AS (SELECT day, slug, start, unnest(range(n)) AS chunk, w FROM b WHERE n > 0),
x AS (SELECT day, slug, chunk, start + chunk * {config.hop} AS t, array_to_string(w[chunk * {config.hop} + 1 : chunk * {config.hop} + {config.window}], ' ') AS chunk_text FROM c),
y AS (SELECT *, '  ' || regexp_replace(regexp_replace(lower(chunk_text), '[^\p{{L}}\p{{N}}_\s]', ' | ', 'g'), '\s+', '  ', 'g') || '  ' AS x FROM x),
h AS (SELECT day, slug, chunk, t, k.keyword, k.hits FROM y, LATERAL ({union}) k WHERE k.hits > 0),
p AS (SELECT day, keyword, min(t) AS t FROM h GROUP BY day, keyword UNION ALL SELECT p.day, p.keyword, min(h.t) FROM p JOIN h ON h.day = p.day AND h.keyword = p.keyword AND h.t >= p.t + {config.cooldown} GROUP BY p.day, p.keyword)
"""


EXPECTED_SQL = ", e AS (SELECT '2025-09-' || (doc_id % 6 + 20) AS day, count(*) AS expected FROM documents GROUP BY 1)"


@query(alert_sql() + "SELECT day, slug, chunk, chunk_text FROM x")
def word_windows(spark, sf_dir):
    return alerts.word_windows(english(spark, sf_dir).select("day", "slug", "text"), CONFIG.window, CONFIG.hop).withColumn("chunk", F.col("chunk").cast("long"))


@query(alert_sql() + "SELECT keyword, sum(hits)::BIGINT AS hits FROM h GROUP BY keyword")
def alert_hits_by_keyword(spark, sf_dir):
    return alerts.hits_by(alerts.window_hits(english(spark, sf_dir), CONFIG), "keyword")


@query(alert_sql() + "SELECT day, sum(hits)::BIGINT AS hits, count(*) AS windows FROM h GROUP BY day")
def alert_hits_by_day(spark, sf_dir):
    return alerts.window_hits(english(spark, sf_dir), CONFIG).groupBy("day").agg(F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("windows"))


@query(alert_sql() + "SELECT day, count(DISTINCT t) AS emails FROM p GROUP BY day")
def alert_emails_by_day(spark, sf_dir):
    return alerts.emails_by_day(alerts.simulate(english(spark, sf_dir), CONFIG)["picks"])


@query(alert_sql() + "SELECT keyword, day, count(*) AS emails FROM p GROUP BY keyword, day")
def alert_emails_by_keyword_day(spark, sf_dir):
    return alerts.emails_by_keyword_day(alerts.simulate(english(spark, sf_dir), CONFIG)["picks"])


_GROUPS = " ".join(f"WHEN '{k}' THEN '{CONFIG.group_of(k)}'" for k in CONFIG.keywords)


@query(alert_sql() + f'SELECT "group", count(*) AS emails FROM (SELECT DISTINCT CASE keyword {_GROUPS} END AS "group", day, t FROM p) GROUP BY 1')
def alert_emails_by_group(spark, sf_dir):
    return alerts.emails_by_group(alerts.simulate(english(spark, sf_dir), CONFIG)["picks"], CONFIG)


@query(alert_sql() + ", k AS (SELECT unnest(" + str(CONFIG.keywords) + ") AS keyword) SELECT keyword, " + ", ".join(f"count(*) FILTER (day = '{d}') AS \"{d}\"" for d in DAYS) + ", count(day) AS total FROM k LEFT JOIN p USING (keyword) GROUP BY keyword")
def alert_keyword_matrix(spark, sf_dir):
    return alerts.keyword_matrix(alerts.simulate(english(spark, sf_dir), CONFIG)["picks"], CONFIG, DAYS).drop("position")


_PROJECTION = alert_sql() + EXPECTED_SQL + """, a AS (SELECT day, count(*) AS analysed FROM s GROUP BY day), m AS (SELECT day, count(DISTINCT t) AS emails FROM p GROUP BY day),
r AS (SELECT (SELECT sum(emails) FROM m) / (SELECT sum(analysed) FROM a) AS rate),
d AS (SELECT coalesce(a.day, e.day) AS day, coalesce(analysed, 0) AS analysed, coalesce(expected, 0) AS expected, coalesce(emails, 0) AS emails FROM a FULL JOIN e ON a.day = e.day LEFT JOIN m ON m.day = coalesce(a.day, e.day)),
q AS (SELECT d.*, CASE WHEN expected > 0 THEN analysed / expected ELSE 0 END AS coverage, rate FROM d, r),
z AS (SELECT *, analysed >= 8 OR coverage >= 0.4 AS sample_ok FROM q),
o AS (SELECT day, analysed, expected, emails, round(coverage, 6) AS coverage, sample_ok, round(CASE WHEN expected > 0 AND rate > 0 THEN CASE WHEN sample_ok AND analysed > 0 THEN emails * expected / analysed ELSE rate * expected END WHEN analysed > 0 AND expected > 0 THEN emails * expected / analysed END, 6) AS projected FROM z)
"""


def _projected(spark, sf_dir):
    e = english(spark, sf_dir)
    p = alerts.projection(e, alerts.simulate(e, CONFIG)["picks"], expected(spark, sf_dir))
    return p.withColumn("coverage", F.round("coverage", 6)).withColumn("projected", F.round("projected", 6))


@query(_PROJECTION + "SELECT * FROM o")
def alert_projection(spark, sf_dir):
    return _projected(spark, sf_dir)


@query(_PROJECTION + "SELECT min(projected) AS least, max(projected) AS greatest, median(projected) AS middle FROM o")
def alert_projection_spread(spark, sf_dir):
    return alerts.spread(_projected(spark, sf_dir))


@query(alert_sql(CONFIG.without("the")) + "SELECT day, count(DISTINCT t) AS emails FROM p GROUP BY day")
def alert_scenario_exclude(spark, sf_dir):
    return alerts.emails_by_day(alerts.simulate(english(spark, sf_dir), CONFIG.without("the"))["picks"])


@query("SELECT lang, count(*) AS speeches, count_if(lang <> 'en') AS skipped FROM documents GROUP BY lang")
def language_gate(spark, sf_dir):
    return speeches(spark, sf_dir).groupBy(F.col("language").alias("lang")).agg(F.count(F.lit(1)).alias("speeches"), F.count_if(F.col("language") != "en").alias("skipped"))


@query(r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents), i AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)
SELECT doc_id, i - 1 AS position, '"' || CASE WHEN i - 1 > 3 THEN '...' ELSE '' END || array_to_string(list_concat(w[greatest(i - 3, 1) : i - 1], [w[i]], w[i + 1 : i + 3]), ' ') || CASE WHEN len(w) - i > 3 THEN '...' ELSE '' END || '"' AS context FROM i WHERE w[i] = 'with'""")
def keyword_context_snippet(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", T.words("text").alias("w")).select("doc_id", "w", F.posexplode("w").alias("position", "word")).where("word = 'with'")
    before, after = F.slice("w", F.lit(1), F.col("position")), F.slice(F.col("w"), F.col("position") + 2, F.size("w"))
    return d.select("doc_id", F.col("position").cast("long").alias("position"), T.snippet(before, F.col("word"), after, 3).alias("context"))


@query()  # whole words by Unicode rules, which DuckDB's expressions lack; tests/test_sources.py has small cases
def keyword_marking(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.mark_plain("text", CONFIG.keywords).alias("marked"), T.mark_html("text", CONFIG.keywords).alias("html"))


# --- event journal -----------------------------------------------------------------------------------------


@query("""WITH RECURSIVE e AS (SELECT DISTINCT event_type, user_id, epoch_us(ts) AS t FROM events), p AS (SELECT event_type, user_id, min(t) AS t FROM e GROUP BY ALL UNION ALL
SELECT p.event_type, p.user_id, min(e.t) FROM p JOIN e ON e.event_type = p.event_type AND e.user_id = p.user_id AND e.t >= p.t + 86400000000 GROUP BY p.event_type, p.user_id)
SELECT event_type, user_id, t FROM p""")
def cooldown_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return cooldown.take_with_cooldown(e, ["event_type", "user_id"], "t", 86_400_000_000)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT event_type, props, epoch_us(ts) AS t FROM events), p AS (SELECT event_type, props, min(t) AS t FROM e GROUP BY ALL UNION ALL
SELECT p.event_type, p.props, min(e.t) FROM p JOIN e ON e.event_type = p.event_type AND e.props = p.props AND e.t >= p.t + 3600000000 GROUP BY p.event_type, p.props)
SELECT e.event_type, e.props, min(e.event_id) AS event_id, p.t FROM p JOIN events e ON e.event_type = p.event_type AND e.props = p.props AND epoch_us(e.ts) = p.t GROUP BY ALL""")
def dedup_ttl_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "props", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return cooldown.first_in_window(e, ["event_type", "props"], "t", 3_600_000_000)


@query("""WITH u AS (SELECT event_id, ts, user_id, event_type, value, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 THEN 1 ELSE 2 END AS source FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), event_type, user_id ORDER BY source, ts, event_id) AS n FROM u)
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, event_type, user_id FROM r WHERE n = 1""")
def journal_union_dedup(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    parts = [e.where(F.col("event_id") % 3 == i) for i in range(3)]
    return rows.union_first(parts, ["day", "event_type", "user_id"], [F.col("ts"), F.col("event_id")]).select("event_id", "day", "event_type", "user_id")


@query("""WITH f AS (SELECT event_id AS ord, ts AS f_start, ts + INTERVAL 20 MINUTE AS f_end, 'fixed-' || user_id AS fixed FROM events WHERE event_type = 'signup'),
j AS (SELECT e.event_id, min_by(fixed, ord) AS fixed FROM events e JOIN f ON e.ts >= f_start AND e.ts < f_end GROUP BY e.event_id)
SELECT e.event_id, e.user_id, j.fixed FROM events e LEFT JOIN j USING (event_id)""")
def interval_fix(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    f = e.where(F.col("event_type") == "signup")
    f = f.select(F.col("event_id").alias("ord"), F.col("ts").alias("f_start"), (F.col("ts") + F.expr("INTERVAL 20 MINUTES")).alias("f_end"), F.concat(F.lit("fixed-"), F.col("user_id")).alias("fixed"))
    return sequence.first_interval(e, f, "ts", "f_start", "f_end", "ord", ["fixed"], "event_id").select("event_id", "user_id", "fixed")


@query("""WITH f AS (SELECT event_id AS ord, ts AS f_start, ts + INTERVAL 20 MINUTE AS f_end FROM events WHERE event_type = 'signup')
SELECT ord, count(*) AS events, count(DISTINCT user_id) AS users FROM events e JOIN f ON e.ts >= f_start AND e.ts < f_end GROUP BY ord""")
def changes_by_fix(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    f = e.where(F.col("event_type") == "signup").select(F.col("event_id").alias("ord"), F.col("ts").alias("f_start"))
    f = f.select(F.col("ord").alias("position"), F.col("f_start").alias("start"), (F.col("f_start") + F.expr("INTERVAL 20 MINUTES")).alias("end"))
    return sequence.totals_inside(e, f, "ts", "start", "end", "position", distinct="user_id").toDF("ord", "events", "users")


@query("""WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type <> 'purchase'), r AS (SELECT user_id, ts, max(event_id) AS cut FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT l.event_id, l.user_id, r.cut FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def asof_cut(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    r = e.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("at")).agg(F.max("event_id").alias("cut"))
    return sequence.as_of(e.where("event_type <> 'purchase'").select("event_id", "user_id", "ts"), r, ["user_id"], "ts", "at", ["cut"]).select("event_id", "user_id", "cut")


@query("""SELECT h.event_id, count(*) AS lines, min(l.event_id) AS first_line, max(l.event_id) AS last_line FROM events h JOIN events l ON l.ts > h.ts - INTERVAL 30 MINUTE AND l.ts < h.ts + INTERVAL 10 MINUTE
WHERE h.event_type = 'error' GROUP BY h.event_id""")
def context_range_join(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return sequence.totals_around(e.where("event_type = 'error'"), e, "ts", "ts", 1800, 600, "event_id", "event_id").toDF("event_id", "lines", "first_line", "last_line")


@query("""WITH g AS (SELECT event_id, user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM g)
SELECT user_id, run, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM r GROUP BY user_id, run""")
def run_detection(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    order = [F.col("ts"), F.col("event_id")]
    late = lambda before, ts: ts > before + F.expr("INTERVAL 12 HOURS")
    return sequence.long_runs(e, ["user_id"], F.to_date("ts"), order, "ts", late).groupBy("user_id", "run").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("""WITH s AS (SELECT conv_id, turn, text, (sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT AS before, length(text) AS n FROM (SELECT DISTINCT ON (conv_id, turn) * FROM conversations ORDER BY conv_id, turn, text)),
g AS (SELECT *, CASE WHEN lag(n) OVER (PARTITION BY conv_id ORDER BY turn) > 120 THEN 1 ELSE 0 END AS b FROM s),
r AS (SELECT *, sum(b) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS paragraph FROM g)
SELECT conv_id, paragraph, string_agg(text, ' ' ORDER BY turn) AS text FROM r GROUP BY conv_id, paragraph""")
def gap_paragraphs(spark, sf_dir):
    c = rows.keep_first(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), ["conv_id", "turn"], [F.col("text")])
    order = [F.col("turn")]
    c = sequence.runs(c.withColumn("n", F.length("text")), ["conv_id"], order, sequence.previous("n", ["conv_id"], order) > 120, "paragraph")
    lines = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return c.groupBy("conv_id", "paragraph").agg(F.array_join(F.transform(lines, lambda x: x["text"]), " ").alias("text"))


@query("""WITH c AS (SELECT DISTINCT ON (conv_id, turn) * FROM conversations ORDER BY conv_id, turn, role, text), l AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM c)
SELECT conv_id, turn, role FROM l WHERE role <> '' AND role IS DISTINCT FROM p""")
def speaker_changes(spark, sf_dir):
    c = rows.keep_first(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), ["conv_id", "turn"], [F.col("role"), F.col("text")])
    return c.withColumn("_new", sequence.changed("role", ["conv_id"], [F.col("turn")])).where("_new").select("conv_id", "turn", "role")


@query("""SELECT event_id, strftime(timezone('America/New_York', timezone('UTC', ts)), '%Y-%m-%d') AS day, printf('%d:%02d:%02d', floor(value)::BIGINT // 3600, floor(value)::BIGINT % 3600 // 60, floor(value)::BIGINT % 60) AS code, json_extract_string(props, '$.k') AS k FROM events""")
def journal_projection(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", T.new_york_day(F.col("ts").cast("timestamp")).alias("day"), T.timecode("value").alias("code"), F.get_json_object("props", "$.k").alias("k"))


@query("""WITH h AS (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id % 40 AS speaker, count(*) AS n FROM events WHERE event_type IN ('error', 'signup') GROUP BY ALL),
s AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, user_id % 40 AS speaker FROM events WHERE event_type = 'view'),
b AS (SELECT coalesce(s.day, h.day) AS day, n FROM s FULL JOIN h ON s.day = h.day AND s.speaker = h.speaker)
SELECT day, count(*) AS speakers, count_if(n > 0) AS with_hits, coalesce(sum(n), 0)::BIGINT AS hits, CASE WHEN coalesce(sum(n), 0) > 0 THEN 'con_hits' ELSE 'sin_hits' END AS status FROM b GROUP BY day""")
def alert_dashboard(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.col("user_id") % 40).alias("speaker"), "event_type")
    d = rollup.alert_days(e.where("event_type = 'view'"), e.where("event_type IN ('error', 'signup')"))
    return d.withColumn("hits", F.col("hits").cast("long"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, string_agg(event_type, ',' ORDER BY first) AS kinds FROM (SELECT date_trunc('day', ts) AS ts, event_type, min(event_id) AS first FROM events GROUP BY ALL) GROUP BY ts""")
def distinct_in_order(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.min("event_id").alias("first"))
    return e.groupBy("day").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "event_type"))), lambda x: x["event_type"]), ",").alias("kinds"))


@query("""SELECT event_type, count(*) AS calls, count_if(user_id % 7 > 0) AS cache_hits, sum(event_id)::BIGINT AS input_tokens, sum(user_id)::BIGINT AS output_tokens, sum(user_id % 7)::BIGINT AS cache_read, sum(event_id % 11)::BIGINT AS cache_write,
sum(event_id % 3)::BIGINT AS write_5m, sum(event_id % 2)::BIGINT AS write_1h,
round((sum(event_id) * 1.0::DOUBLE + sum(user_id) * 5.0::DOUBLE + sum(user_id % 7) * 0.10::DOUBLE + (sum(event_id % 3) + greatest(sum(event_id % 11) - sum(event_id % 3) - sum(event_id % 2), 0)) * 1.25::DOUBLE + sum(event_id % 2) * 2.0::DOUBLE) / 1000000, 6) AS cost FROM events GROUP BY event_type""")
def usage_cost(spark, sf_dir):
    i, u = F.col("event_id"), F.col("user_id")
    calls = table(spark, sf_dir, "events").select("event_type", i.alias("input_tokens"), u.alias("output_tokens"), (u % 7).alias("cache_read"), (i % 11).alias("cache_write"), (i % 3).alias("write_5m"), (i % 2).alias("write_1h"))
    return rollup.usage(calls, ["event_type"])


# --- codebook ----------------------------------------------------------------------------------------------


def _payload(spark, sf_dir) -> DataFrame:
    """Eight coded rows for a labelled document, with gaps, wrong codes and a second answer."""
    names = F.array(*[F.lit(n) for n in codebook.INDICATORS])
    l = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.posexplode(names).alias("k", "indicator_name"))
    code = F.when(F.col("indicator_name") == codebook.FUTURE_NAME, F.when(F.col("quality") == 1, 5).otherwise(2)).otherwise((F.col("doc_id") + F.col("k") * F.col("quality")) % 4)
    code = F.when((F.col("doc_id") + F.col("k")) % 23 == 0, 9).otherwise(code)
    p = l.where((F.col("doc_id") * 3 + F.col("k")) % 17 != 0).select(F.concat(F.lit("M_"), "doc_id").alias("id_speech"), "indicator_name", code.cast("int").alias("code"), F.concat(F.lit("x"), "k").alias("extract"), (F.col("doc_id") * 16 + F.col("k")).alias("pos"), "doc_id", "k")
    again = p.where((F.col("doc_id") + F.col("k")) % 5 == 0).withColumn("code", F.lit(1)).withColumn("pos", F.col("pos") + 8)
    return p.unionByName(again).drop("doc_id", "k")


_CODES = f"""WITH n AS (SELECT unnest({codebook.INDICATORS}) AS indicator_name, unnest(range(8)) AS k),
l AS (SELECT doc_id, k, indicator_name, CASE WHEN (doc_id + k) % 23 = 0 THEN 9 WHEN indicator_name = 'future_multilateralism_position' THEN CASE WHEN quality = 1 THEN 5 ELSE 2 END ELSE (doc_id + k * quality) % 4 END::INTEGER AS code FROM labels, n WHERE (doc_id * 3 + k) % 17 <> 0),
c AS (SELECT 'M_' || doc_id AS id_speech, indicator_name, CASE WHEN (doc_id + k) % 5 = 0 THEN 1 ELSE code END AS code, 'x' || k AS extract, k FROM l),
s AS (SELECT DISTINCT 'M_' || doc_id AS id_speech FROM labels),
v AS (SELECT *, CASE WHEN indicator_name = 'future_multilateralism_position' THEN code IN (0, 5, 2, 6) ELSE code IN (0, 1, 2, 3) END AS ok FROM c),
f AS (SELECT id_speech FROM v WHERE ok GROUP BY id_speech HAVING count(*) = 8),
r AS (SELECT id_speech, indicator_name, code, CASE WHEN code = 0 THEN '' ELSE extract END AS extract FROM v JOIN f USING (id_speech)),
a AS (SELECT id_speech, indicator_name, CASE WHEN reform = 1 AND indicator_name = 'future_multilateralism_position' AND code <> 6 THEN 6 ELSE code END AS code, extract, CASE WHEN reform = 1 AND indicator_name = 'future_multilateralism_position' AND code <> 6 THEN 'aligned with un_reform' ELSE '' END AS note
  FROM (SELECT *, max(CASE WHEN indicator_name = 'un_reform_position' AND code = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY id_speech) AS reform FROM r))
"""


def _speech_ids(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(F.concat(F.lit("M_"), "doc_id").alias("id_speech")).distinct()


@query(_CODES + """SELECT s.id_speech, string_agg(n.indicator_name, ',' ORDER BY n.k) AS missing FROM s CROSS JOIN n LEFT JOIN v ON v.id_speech = s.id_speech AND v.indicator_name = n.indicator_name WHERE v.code IS NULL OR NOT v.ok GROUP BY s.id_speech""")
def codebook_completeness(spark, sf_dir):
    return codebook.incomplete(_speech_ids(spark, sf_dir), codebook.last_codes(_payload(spark, sf_dir)))


@query(_CODES + "SELECT * FROM a")
def codebook_repair(spark, sf_dir):
    return codebook.aligned(codebook.complete_rows(_speech_ids(spark, sf_dir), codebook.last_codes(_payload(spark, sf_dir))))


@query(_CODES + """, w AS (SELECT id_speech, max(code) FILTER (indicator_name = 'sg_selection_position_gender') AS sg_gender, max(code) FILTER (indicator_name = 'sg_selection_position') AS sg, max(code) FILTER (indicator_name = 'gender_equality_position') AS ge,
max(code) FILTER (indicator_name = 'women_multilateral_leadership_position') AS ml, max(code) FILTER (indicator_name = 'women_leadership_position') AS le, max(code) FILTER (indicator_name = 'un_reform_position') AS re, max(code) FILTER (indicator_name = 'future_multilateralism_position') AS fu FROM r GROUP BY id_speech)
SELECT id_speech, 'sg_selection_position_gender without sg_selection_position' AS message FROM w WHERE coalesce(sg_gender, 0) <> 0 AND coalesce(sg, 0) = 0 UNION ALL SELECT id_speech, 'sg_selection_position_gender without gender_equality_position' FROM w WHERE coalesce(sg_gender, 0) <> 0 AND coalesce(ge, 0) = 0
UNION ALL SELECT id_speech, 'women_multilateral_leadership_position without women_leadership_position' FROM w WHERE coalesce(ml, 0) <> 0 AND coalesce(le, 0) = 0 UNION ALL SELECT id_speech, 'un_reform with another future' FROM w WHERE re = 1 AND fu <> 6""")
def codebook_consistency(spark, sf_dir):
    return codebook.warnings(codebook.complete_rows(_speech_ids(spark, sf_dir), codebook.last_codes(_payload(spark, sf_dir))))


@query("""WITH i AS (SELECT 'M_' || doc_id AS id_speech, doc_id AS pos, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'model-' || quality END AS model FROM labels),
e AS (SELECT 'M_' || doc_id AS id_speech FROM documents)
SELECT coalesce(a.id_speech, b.id_speech) AS id_speech, coalesce(x, 0) AS indicators, coalesce(y, 0) AS emerging, coalesce(m, '') AS model FROM
(SELECT id_speech, count(*) AS x, min_by(model, pos) FILTER (model <> '') AS m FROM i GROUP BY 1) a FULL JOIN (SELECT id_speech, count(*) AS y FROM e GROUP BY 1) b ON a.id_speech = b.id_speech""")
def coding_status(spark, sf_dir):
    i = table(spark, sf_dir, "labels").select(F.concat(F.lit("M_"), "doc_id").alias("id_speech"), F.col("doc_id").alias("pos"), F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.concat(F.lit("model-"), "quality")).alias("model"))
    e = table(spark, sf_dir, "documents").select(F.concat(F.lit("M_"), "doc_id").alias("id_speech"))
    return codebook.status(i, e)


_PAIRS = "SELECT 'quality' AS indicator_name, quality AS human, (doc_id % 3 > 0)::INTEGER AS machine FROM labels UNION ALL SELECT 'toxic', toxic, (doc_id % 4 = 0)::INTEGER FROM labels"


def _pairs(spark, sf_dir):
    l = table(spark, sf_dir, "labels")
    q = l.select(F.lit("quality").alias("indicator_name"), F.col("quality").alias("human"), (F.col("doc_id") % 3 > 0).cast("int").alias("machine"))
    return q.unionByName(l.select(F.lit("toxic").alias("indicator_name"), F.col("toxic").alias("human"), (F.col("doc_id") % 4 == 0).cast("int").alias("machine")))


@query(f"SELECT indicator_name, human, machine, count(*) AS n FROM ({_PAIRS}) GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return codebook.confusion(_pairs(spark, sf_dir))


@query(f"SELECT indicator_name, count(*) AS n, round(avg((human = machine)::INTEGER), 6) AS agreement FROM ({_PAIRS}) GROUP BY ALL")
def validator_agreement(spark, sf_dir):
    return codebook.agreement(_pairs(spark, sf_dir)).withColumn("agreement", F.round("agreement", 6))


@query("SELECT lang, doc_id, ((row_number() OVER (PARTITION BY lang ORDER BY doc_id)) - 1) // 3 AS batch FROM documents")
def batch_of_three(spark, sf_dir):
    return rows.in_batches(table(spark, sf_dir, "documents").select("lang", "doc_id"), [F.col("doc_id")], 3, ["lang"], F.floor(F.col("doc_id") / 10_000))


@query("SELECT d.doc_id, d.lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def pending_antijoin(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_anti")


@query("""WITH o AS (SELECT 'd' || doc_id AS a FROM labels UNION SELECT 'q' || (doc_id // 10) FROM labels WHERE doc_id % 2 = 1 UNION SELECT 'd' || (item_id * 10 + 1) FROM benchmark UNION SELECT 'q' || item_id FROM benchmark),
n AS (SELECT doc_id, unnest(list_filter(['d' || doc_id, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'q' || (doc_id // 10) END, lower(source)], lambda x: x IS NOT NULL AND x <> '')) AS a FROM documents)
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM n WHERE a IN (SELECT a FROM o))""")
def alias_antijoin(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    ten = F.floor(F.col("doc_id") / 10).cast("long")
    aliases = [F.concat(F.lit("d"), "doc_id"), F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.concat(F.lit("q"), ten)), F.lower("source")]
    old = table(spark, sf_dir, "labels").select("doc_id", F.lit("").alias("source"))
    items = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 10 + 1).alias("doc_id"), F.lit("").alias("source"))
    return rows.append_missing_aliases(old.unionByName(items), d, aliases, "doc_id").select("doc_id")


@query("""WITH k AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_custkey || '|' || o_orderpriority END AS key FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY o_orderkey) AS r FROM k WHERE key <> '')
SELECT o_orderkey, o_custkey FROM n WHERE r = 1 AND key NOT IN (SELECT key FROM k WHERE o_orderkey % 4 = 0 AND key <> '')""")
def idempotent_append(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    key = F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(F.concat_ws("|", F.col("o_custkey").cast("string"), "o_orderpriority"))
    return rows.append_missing(o.where("o_orderkey % 4 = 0"), o, key, [F.col("o_orderkey")]).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def drop_by_key(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return rows.drop_keys(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), c, "o_custkey")


# --- dimensions and numbering ------------------------------------------------------------------------------


@query("""WITH d AS (SELECT n_nationkey, n_regionkey, unnest([lower(n_name), left(lower(n_name), 3), left(lower(n_name), 1)]) AS key, unnest([0, 1, 2]) AS kp FROM nation),
i AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n_nationkey, kp) AS r FROM d) WHERE r = 1),
f AS (SELECT c_custkey, unnest(['nation ' || c_nationkey, left(lower(c_mktsegment), 3), left(lower(c_mktsegment), 1)]) AS key, unnest([0, 1, 2]) AS pos FROM customer),
b AS (SELECT c_custkey, min_by(i.n_nationkey, pos) AS n_nationkey, min_by(i.n_regionkey, pos) AS n_regionkey FROM f JOIN i USING (key) GROUP BY c_custkey)
SELECT c.c_custkey, b.n_nationkey, b.n_regionkey FROM customer c LEFT JOIN b USING (c_custkey)""")
def country_fallback_join(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), table(spark, sf_dir, "nation")
    seg, name = F.lower("c_mktsegment"), F.lower("n_name")
    n = n.withColumn("nation", F.col("n_nationkey"))
    found = dims.fallback_lookup(c, "c_custkey", [F.concat(F.lit("nation "), "c_nationkey"), F.left(seg, F.lit(3)), F.left(seg, F.lit(1))], n, [name, F.left(name, F.lit(3)), F.left(name, F.lit(1))], "n_nationkey", ["nation", "n_regionkey"])
    return found.select("c_custkey", F.col("nation").alias("n_nationkey"), "n_regionkey")


@query("""SELECT lower(trim(o_orderpriority)) || o_custkey % 50 AS name, count(DISTINCT c_nationkey) AS countries FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 HAVING count(DISTINCT c_nationkey) >= 3""")
def leaked_names(spark, sf_dir):
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    r = o.select(F.concat(F.lower(F.trim("o_orderpriority")), (F.col("o_custkey") % 50).cast("string")).alias("name"), F.col("c_nationkey").cast("string").alias("country"))
    return dims.leaked_names(r)


@query("""SELECT c_custkey, c_name, c_nationkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS n FROM customer) WHERE n = 1""")
def keep_first_roster(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return rows.keep_first(c, ["c_nationkey", "c_mktsegment"], [F.col("c_custkey")]).select("c_custkey", "c_name", "c_nationkey")


@query("""SELECT o_custkey, min(o_orderkey) AS position, max_by(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey""")
def last_wins_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("position"), "o_orderpriority")
    return rows.last_wins(o, ["o_custkey"], "position", ["o_orderpriority"])


@query("""WITH k AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey // 2 + 5 END AS kept FROM orders), u AS (SELECT DISTINCT kept FROM k WHERE kept >= 1),
n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS k FROM k WHERE kept IS NULL),
f AS (SELECT g, row_number() OVER (ORDER BY g) AS k FROM (SELECT unnest(range(1, (SELECT count(*) FROM k) + (SELECT max(kept) FROM u) + 2)) AS g) WHERE g NOT IN (SELECT kept FROM u))
SELECT o_orderkey, kept::BIGINT AS id FROM k WHERE kept IS NOT NULL UNION ALL SELECT o_orderkey, g FROM n JOIN f USING (k)""")
def surrogate_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    kept = F.when(F.col("o_orderkey") % 3 == 0, F.floor(F.col("o_orderkey") / 2).cast("long") + 5)
    return rows.assign_ids(o, kept, F.floor(F.col("o_orderkey") / 10_000), [F.col("o_orderkey")]).select("o_orderkey", "id")


@query("SELECT coalesce(max(regexp_extract('M_' || o_orderkey, '^M_([0-9]+)$', 1)::BIGINT), 0) + 1 AS next_id FROM orders")
def next_id(spark, sf_dir):
    n = T.id_number(F.concat(F.lit("M_"), F.col("o_orderkey").cast("string")))
    return table(spark, sf_dir, "orders").agg((F.coalesce(F.max(n), F.lit(0)) + 1).alias("next_id"))


@query("""WITH n AS (SELECT c_custkey, lower(c_mktsegment) || '-' || c_nationkey AS needle FROM customer), r AS (SELECT DISTINCT ON (name) name, pos FROM (SELECT lower(c_mktsegment) || '-' || c_nationkey || CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE '0' END AS name, c_custkey AS pos FROM customer) ORDER BY name, pos),
e AS (SELECT c_custkey, min(pos) AS pos FROM n JOIN r ON needle = name GROUP BY 1), c AS (SELECT c_custkey, min(pos) AS pos FROM n JOIN r ON contains(name, needle) OR contains(needle, name) WHERE length(needle) >= 8 AND c_custkey NOT IN (SELECT c_custkey FROM e) GROUP BY 1)
SELECT * FROM e UNION ALL SELECT * FROM c""")
def roster_match_contains(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    base = F.concat(F.lower("c_mktsegment"), F.lit("-"), F.col("c_nationkey").cast("string"))
    roster = c.select(F.concat(base, F.when(F.col("c_nationkey") % 2 == 0, "").otherwise("0")).alias("name"), F.col("c_custkey").alias("pos")).groupBy("name").agg(F.min("pos").alias("pos"))
    return dims.exact_or_contained(c.select("c_custkey", base.alias("needle")), "c_custkey", "needle", roster, "name", "pos")


@query("""WITH t AS (SELECT p_partkey, list_filter(regexp_split_to_array(lower(p_name), '[^a-z0-9]+'), lambda x: x <> '') AS a, list_filter(regexp_split_to_array(lower(p_type), '[^a-z0-9]+'), lambda x: x <> '') AS b FROM part)
SELECT p_partkey, regexp_replace(regexp_replace(lower(p.p_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, round(CASE WHEN least(len(list_distinct(a)), len(list_distinct(b))) > 0 THEN len(list_intersect(a, b)) / least(len(list_distinct(a)), len(list_distinct(b))) ELSE 0 END, 6) AS overlap FROM t JOIN part p USING (p_partkey)""")
def slugs_and_overlap(spark, sf_dir):
    tokens = lambda c: F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: x != "")
    return table(spark, sf_dir, "part").select("p_partkey", T.ascii_slug("p_name").alias("slug"), F.round(dims.overlap_share(tokens("p_name"), tokens("p_type")), 6).alias("overlap"))


# --- roll-ups ----------------------------------------------------------------------------------------------

_ENTRIES = """WITH e AS (SELECT o_orderkey AS slug, strftime(o_orderdate, '%Y-%m') AS day, o_orderkey % 97 = 0 AS error, o_orderkey % 2 = 0 AS has_source,
EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber >= 2) AS has_text, o_orderstatus = 'F' AS coded FROM orders),
p AS (SELECT slug, day, error, CASE WHEN has_text THEN 'ok' WHEN error AND NOT has_source THEN 'error' ELSE 'pending' END AS speech, CASE WHEN coded THEN 'ok' ELSE 'pending' END AS analysis FROM e),
d AS (SELECT day, count(*) AS speakers, count_if(speech = 'ok') AS speeches, count_if(analysis = 'ok') AS analyses, count_if(error OR speech = 'error') AS errors FROM p GROUP BY day),
q AS (SELECT *, CASE WHEN errors > 0 THEN 'con_errores' WHEN speakers = 0 OR speeches = 0 THEN 'solo_roster' WHEN speeches >= speakers AND analyses >= speakers THEN 'completo' ELSE 'en_progreso' END AS status FROM d)
"""


def _progress(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    r = o.select(F.col("o_orderkey").alias("slug"), F.date_format("o_orderdate", "yyyy-MM").alias("day"), (F.col("o_orderkey") % 97 == 0).alias("error"), (F.col("o_orderkey") % 2 == 0).alias("has_source"))
    texts = table(spark, sf_dir, "lineitem").where("l_linenumber >= 2").select(F.col("l_orderkey").alias("slug"))
    return rollup.progress(r, texts, o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("slug")))


@query(_ENTRIES + "SELECT slug, day, speech, analysis FROM p")
def progress_entries(spark, sf_dir):
    return _progress(spark, sf_dir).select("slug", "day", "speech", "analysis")


@query(_ENTRIES + "SELECT * FROM q")
def progress_day_rollup(spark, sf_dir):
    return rollup.progress_by_day(_progress(spark, sf_dir))


@query(_ENTRIES + "SELECT left(day, 4) AS session, (row_number() OVER (PARTITION BY left(day, 4) ORDER BY day DESC) - 1)::INTEGER AS position, day, speakers, speeches, analyses, errors, status FROM q")
def session_payload(spark, sf_dir):
    days = rollup.progress_by_day(_progress(spark, sf_dir)).withColumn("session", F.left("day", F.lit(4)))
    kind = "array<struct<day:string,speakers:bigint,speeches:bigint,analyses:bigint,errors:bigint,status:string>>"
    p = rollup.session_payload(days).select("session", F.posexplode(F.from_json("payload", kind)).alias("position", "d"))
    return p.select("session", "position", "d.*")


@query("""SELECT c_custkey, row_number() OVER (ORDER BY coalesce(nullif(CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '2025-09-' || (10 + c_custkey % 15) END, ''), '9999'), CASE WHEN c_custkey % 5 = 0 THEN 1000000000 ELSE c_custkey END, c_name, c_custkey) AS position FROM customer""")
def merge_order(spark, sf_dir):
    date = F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit("2025-09-"), (F.col("c_custkey") % 15 + 10).cast("string")))
    number = F.when(F.col("c_custkey") % 5 == 0, F.lit(1_000_000_000)).otherwise(F.col("c_custkey"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.coalesce(date, F.lit("9999")).alias("date"), number.alias("number"))
    return rows.row_numbers_at_scale(c, F.col("date"), [F.col(c).asc_nulls_last() for c in ("number", "c_name", "c_custkey")], "position").select("c_custkey", "position")


@query("""SELECT c_nationkey, c_mktsegment, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer) WHERE n <= 2""")
def top_two(spark, sf_dir):
    w = Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc(), "c_custkey")
    return table(spark, sf_dir, "customer").withColumn("n", F.row_number().over(w)).where("n <= 2").select("c_nationkey", "c_mktsegment", "c_custkey", "c_acctbal")


# --- pages and text ----------------------------------------------------------------------------------------


@query(r"""SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, len(regexp_extract_all(html, '<a href="[^"]*"'))::BIGINT AS links, regexp_extract(html, '<a href="([^"]*)"', 1) AS first_link FROM pages""")
def page_fields(spark, sf_dir):
    h = F.col("html")
    links = F.regexp_count(h, F.lit('<a href="[^"]*"')).cast("long")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract(h, '<html lang="([a-z]+)"', 1).alias("lang"), F.trim(F.regexp_extract(h, "<title>([^<]*)</title>", 1)).alias("title"), links.alias("links"), F.regexp_extract(h, '<a href="([^"]*)"', 1).alias("first_link"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM pages""")
def html_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.strip_tags("html").alias("text"))


@query(r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"?#/]+)(?:[?#][^"]*)?"', 1)) AS slug, unnest(range(len(regexp_extract_all(html, 'href="/([^"?#/]+)(?:[?#][^"]*)?"', 1)))) AS pos FROM pages)
SELECT page_id, slug, min(pos) AS pos FROM a GROUP BY page_id, slug""")
def archive_slugs(spark, sf_dir):
    from ..sources import pages

    return pages.archive_slugs(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id", "").select("page_id", "slug", F.col("position").cast("long").alias("pos"))


@query("SELECT doc_id, (length(text) + 3) // 4 AS tokens, left(sha256(text), 24) AS key, CASE WHEN length(text) > 120 THEN left(text, 117) || '...' ELSE text END AS clip, length(text) >= 200 AS long_enough FROM documents")
def text_projection(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.estimated_tokens("text").alias("tokens"), T.cache_key("text").alias("key"), T.clip("text", 120).alias("clip"), (F.length("text") >= 200).alias("long_enough"))


# --- cleaning, metadata, messages --------------------------------------------------------------------------

def _dropped(x: str) -> str:
    rules = " OR ".join(f"regexp_matches({x}, '(?i){p}')" for p in [*C.LINE_RULES.values()])
    letters, capitals = rf"length(regexp_replace({x}, '\P{{L}}', '', 'g'))", rf"length(regexp_replace({x}, '\P{{Lu}}', '', 'g'))"
    slashes = f"(length({x}) - length(replace({x}, '/', '')))"
    return rf"({rules} OR regexp_matches({x}, '{C.SPACED_LETTERS}') OR ({letters} >= 12 AND length({x}) < 120 AND 100 * {capitals} > 85 * {letters}) OR ({slashes} >= 8 AND len(regexp_extract_all({x}, '/\d+')) >= 6) OR ({slashes} >= 4 AND regexp_full_match({x}, '[\d/i\s]+')))"


_LINES = r"list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(replace(x, chr(173), ''), '[ \t\x{00A0}\x{2009}\x{202F}]+', ' ', 'g'))), lambda x: x = '' OR NOT " + _dropped("x") + ")"
_REFLOW = r"""list_reduce(list_filter(l, lambda x: x <> ''), lambda a, x: CASE WHEN NOT regexp_matches(x, '^(?:\d+\.\s|-+\s)') AND (regexp_matches(x, '^[\p{Ll},;:)\]—–-]') OR (NOT regexp_matches(a, '[.!?…؟۔]["''”’»)]*$') AND NOT (regexp_matches(a, '[,:]$') AND regexp_matches(x, '^\p{Lu}'))))
THEN CASE WHEN regexp_matches(a, '(^|[^-])-$') THEN left(a, length(a) - 1) || x ELSE a || ' ' || x END ELSE a || chr(10) || chr(10) || x END)"""


@query(rf"SELECT doc_id, sha256(regexp_replace(regexp_replace(coalesce({_REFLOW}, ''), ' +', ' ', 'g'), ' +([,.;:!?])', '\1', 'g')) AS digest FROM (SELECT doc_id, {_LINES} AS l FROM (SELECT doc_id, regexp_replace(text, '\r\n|\r', chr(10), 'g') AS t FROM documents))")
def paragraphs(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", C.reflow(C.clean_lines("text")).alias("p"))
    return d.select("doc_id", F.sha2("p", 256).alias("digest"))


@query(rf"SELECT doc_id, len(l)::BIGINT AS lines, len(string_split(t, chr(10))) - len(l) AS dropped, sha256(array_to_string(l, chr(10))) AS digest FROM (SELECT doc_id, t, {_LINES} AS l FROM (SELECT doc_id, regexp_replace(text, '\r\n|\r', chr(10), 'g') AS t FROM documents))")
def clean_lines(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", C.one_newline("text").alias("text"), C.clean_lines("text").alias("l"))
    n = F.size("l").cast("long")
    return d.select("doc_id", n.alias("lines"), (F.size(F.split("text", "\n")) - n).cast("long").alias("dropped"), F.sha2(F.array_join("l", "\n"), 256).alias("digest"))


_TITLES = ["Prime Minister of", "President of the Republic of", "Minister for Foreign Affairs of", "Vice-President of", "Her Majesty the Queen of", "Secretary-General, for"]


@query(
    "WITH t AS (SELECT c_custkey AS speech_id, '2025-09-' || (10 + c_custkey % 15) AS day, c_name AS name, (" + str(_TITLES) + ")[c_custkey % 6 + 1] || ' N' || c_nationkey AS title, (['en', 'fr', 'xx', 'Klingon'])[c_custkey % 4 + 1] AS language FROM customer) "
    """SELECT speech_id, row_number() OVER (PARTITION BY day ORDER BY speech_id) AS num_of_appearance, substr(day, 9, 2) || '/' || substr(day, 6, 2) || '/' || substr(day, 1, 4) AS date, name || chr(10) || title AS speaker,
CASE WHEN title LIKE 'Secretary-General%' THEN 'SG' WHEN title LIKE 'President%' OR title LIKE '%Queen%' THEN 'HS' WHEN title LIKE 'Prime%' THEN 'HG' ELSE 'CD' END AS level,
CASE WHEN title LIKE 'Her %' THEN 'F' ELSE '' END AS gender, CASE WHEN title LIKE 'Her %' THEN 'she/her' ELSE '' END AS pronouns, CASE language WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'Klingon' THEN 'Klingon' ELSE '' END AS "original language" FROM t"""
)
def metadata_rows(spark, sf_dir):
    from ..operators import metadata

    k = F.col("c_custkey")
    pick = lambda names, n: F.element_at(F.array(*[F.lit(x) for x in names]), (k % n + 1).cast("int"))
    s = table(spark, sf_dir, "customer").select(
        k.alias("speech_id"), F.concat(F.lit("2025-09-"), (k % 15 + 10).cast("string")).alias("day"), F.col("c_name").alias("name"),
        F.concat(pick(_TITLES, 6), F.lit(" N"), F.col("c_nationkey").cast("string")).alias("title"), pick(["en", "fr", "xx", "Klingon"], 4).alias("language"),
    )
    return metadata.metadata_rows(s, [F.col("speech_id")])


@query("""WITH p AS (SELECT s_suppkey AS position, s_nationkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 'HS' ELSE 'HG' END AS p_level, 'person ' || s_suppkey % 9 AS person FROM supplier),
s AS (SELECT c_custkey AS speech_id, c_nationkey AS k, 'customer ' || c_custkey % 9 AS name, CASE WHEN c_custkey % 3 = 0 THEN 'HS' ELSE 'CD' END AS level FROM customer),
b AS (SELECT speech_id, position, person, p_level, level, CASE WHEN split_part(name, ' ', 2) = split_part(person, ' ', 2) THEN 1 ELSE 0 END AS hit FROM s JOIN p USING (k)),
n AS (SELECT speech_id, min_by(person, position) AS person FROM b WHERE hit = 1 GROUP BY 1), l AS (SELECT speech_id, max_by(person, position) AS person FROM b WHERE level = p_level GROUP BY 1)
SELECT s.speech_id, coalesce(n.person, l.person) AS person FROM s LEFT JOIN n USING (speech_id) LEFT JOIN l USING (speech_id)""")
def protocol_match(spark, sf_dir):
    from ..operators import metadata

    n = F.col("s_suppkey")
    people = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), n.alias("position"), F.when(n % 2 == 0, "HS").otherwise("HG").alias("level"), F.concat(F.lit("person "), (n % 9).cast("string")).alias("person"), F.lit("").alias("gender"), F.lit("").alias("honorific"))
    c = F.col("c_custkey")
    s = table(spark, sf_dir, "customer").select(c.alias("speech_id"), F.col("c_nationkey").alias("k"), F.concat(F.lit("customer "), (c % 9).cast("string")).alias("name"), F.when(c % 3 == 0, "HS").otherwise("CD").alias("level"))
    return metadata.protocol_match(s, people, "k").select("speech_id", "person")


@query("""WITH e AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, floor(value)::BIGINT AS t, event_type AS keyword, CASE WHEN user_id % 2 = 0 THEN 'speaker ' || user_id % 3 ELSE '' END AS speaker, props AS context FROM events),
w AS (SELECT user_id, day, string_agg(keyword, ', ' ORDER BY f) AS words FROM (SELECT user_id, day, keyword, min((t, keyword, speaker, context)) AS f FROM e GROUP BY ALL) GROUP BY ALL),
x AS (SELECT user_id, day, max(speaker) AS speaker, count(*)::INTEGER AS events, string_agg(printf('%d:%02d:%02d', t // 3600, t % 3600 // 60, t % 60) || '  ' || keyword || ': ' || context, chr(10) ORDER BY t, keyword, speaker, context) AS body FROM e GROUP BY ALL)
SELECT user_id, day, words || CASE WHEN speaker <> '' THEN ' - ' || speaker ELSE '' END AS subject, body, events FROM x JOIN w USING (user_id, day)""")
def alert_messages(spark, sf_dir):
    from ..operators import mail

    u = F.col("user_id")
    e = table(spark, sf_dir, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.floor("value").cast("long").alias("t"), F.col("event_type").alias("keyword"), F.when(u % 2 == 0, F.concat(F.lit("speaker "), (u % 3).cast("string"))).otherwise("").alias("speaker"), F.col("props").alias("context"))
    return mail.messages(e, ["user_id", "day"])


@query("""WITH e AS (SELECT o_custkey AS slug, min(o_orderkey) AS position FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), l AS (SELECT o_custkey AS slug, min(o_orderkey) AS position FROM orders GROUP BY 1)
SELECT slug, position FROM e UNION ALL SELECT slug, position + (SELECT max(o_orderkey) + 1 FROM orders WHERE o_orderkey % 2 = 0) FROM l WHERE slug NOT IN (SELECT slug FROM e)""")
def ordered_union(spark, sf_dir):
    from ..operators import mail

    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("slug"), F.col("o_orderkey").alias("position"))
    return mail.ordered_union(o.where("position % 2 = 0"), o, "slug", "position")


@query("""SELECT session, day, '{"session":"' || session || '","day":"' || day || '","items":[' || string_agg('{"id":' || id || ',"price":"' || price || '"}', ',' ORDER BY id) || ']}' AS value
FROM (SELECT o_orderstatus AS session, strftime(o_orderdate, '%Y-%m') AS day, o_orderkey AS id, o_totalprice::DECIMAL(18, 2)::VARCHAR AS price FROM orders) GROUP BY session, day""")
def day_documents(spark, sf_dir):
    from ..sources import sinks

    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("session"), F.date_format("o_orderdate", "yyyy-MM").alias("day"), F.col("o_orderkey").alias("id"), price.alias("price"))
    found = sinks.day_documents(o, ["session", "day"], "items")
    return found.select(F.get_json_object("value", "$.session").alias("session"), F.get_json_object("value", "$.day").alias("day"), "value")


from . import journals, parsing, streams  # noqa: E402, F401  register their queries here
