"""Registered queries of the source parsers over texts that are made from the driver's tables, each beside its SQL.

The SQL gives the fields from which a text was made: what a parser must find in it again.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import labels
from ..functions import text as T
from ..operators import codebook, mail, publish
from ..sources import files, pages, sinks, store
from .registry import _PAIRS, _pairs, dealt, query, table

_BODY = "trim(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g'))"


@query(rf"""SELECT 'M_' || (doc_id + 1) AS id_speech, 's' || doc_id AS slug, lang AS language, source AS country, {_BODY} AS text FROM documents""")
def front_matter(spark, sf_dir):
    path = F.concat(F.lit("out/80/2025-09-23/"), T.format_id(F.col("doc_id") + 1), F.lit(".txt")).alias("path")
    d = table(spark, sf_dir, "documents").select(path, F.concat(F.lit("s"), "doc_id").alias("slug"), F.col("lang").alias("language"), F.col("source").alias("country"), "text")
    return files.parse_front_matter(sinks.speech_text(d, ["slug", "language", "country"], ["path"])).select("id_speech", "slug", "language", "country", "text")


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, event_type AS keyword, CASE WHEN user_id % 3 = 0 THEN '' ELSE 'S. ' || user_id END AS speaker, CASE WHEN user_id % 2 = 0 THEN floor(value) END::DOUBLE AS video_seconds, user_id % 4 = 0 AS timestamp_reliable FROM events""")
def log_lines(spark, sf_dir):
    u = F.col("user_id")
    at = F.when(u % 2 == 0, F.concat(F.lit(" | t="), F.floor("value").cast("string"), F.when(u % 4 == 0, "s").otherwise("s?"))).otherwise("")
    who = F.when(u % 3 == 0, "").otherwise(F.concat(F.lit(" | S. "), u.cast("string")))
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" | KEYWORD_DETECTED | "), "event_type", who, at, F.lit(" | id "), F.col("event_id").cast("string"))
    e = table(spark, sf_dir, "events")
    noise = e.select(F.concat(F.lit("INFO | "), "event_type").alias("value"))
    got = files.parse_log_lines(e.select(line.alias("value")).unionByName(noise))
    return got.select(F.regexp_extract("context", r"(\d+)", 1).cast("long").alias("event_id"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "keyword", "speaker", "video_seconds", "timestamp_reliable")


@query("""SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'L' || c_nationkey END AS country, CASE WHEN c_custkey % 2 = 0 THEN 'Minister' ELSE '' END AS title FROM customer""")
def agenda_lines(spark, sf_dir):
    k = F.col("c_custkey")
    line = F.concat(F.col("c_name"), F.when(k % 3 == 0, " | ").otherwise(F.concat(F.lit(" | L"), "c_nationkey")), F.when(k % 2 == 0, " | Minister").otherwise(""))
    c = table(spark, sf_dir, "customer")
    lines = c.select(k.alias("position"), F.concat(line, F.lit(";# no; "), F.lower(line)).alias("value"))
    return files.parse_agenda(lines).select(F.col("position").alias("c_custkey"), "name", "country", "title")


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, l_linenumber AS slot, 'N' || l_partkey || ' F' || l_suppkey AS name, l_returnflag AS country FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 4""")
def listing_documents(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    s = F.struct(
        F.col("l_linenumber").cast("string").alias("SP_slotNo"), (F.col("l_linenumber") == 4).alias("SP_isSkip"), F.lit(True).alias("SP_LS_nameFormat"), F.concat(F.lit("F"), "l_suppkey").alias("SP_LS_fname"),
        F.concat(F.lit("N"), "l_partkey").alias("SP_LS_lname"), F.struct(F.col("l_returnflag").alias("SP_entity")).alias("SP_entity"),
    )
    m = l.groupBy("o_orderkey", "o_orderdate").agg(F.collect_list(s).alias("MT_speakers"))
    item = F.struct(F.concat(F.lit("3rd meeting, "), F.date_format("o_orderdate", "d MMMM yyyy")).alias("MT_AG_title"))
    doc = F.to_json(F.struct(F.array(F.struct(item.alias("MT_agendaitem"), "MT_speakers")).alias("sampleData")))
    return files.parse_listing(m.select(doc.alias("value"))).select("day", "slot", "name", "country")


@query("""SELECT c_custkey, 'L' || c_nationkey AS country, CASE WHEN c_custkey % 3 = 0 THEN 'Ld ' || c_custkey ELSE 'N & ' || c_custkey END AS name, 'Minister' AS title, '2025-09-' || (10 + c_custkey % 15) AS date,
CASE WHEN c_custkey % 2 = 0 THEN '/f/' || c_custkey || '_en.pdf' ELSE '/f/' || c_custkey || '_fr.pdf' END AS english, (1 + c_custkey % 2)::INTEGER AS audios FROM customer""")
def speaker_pages(spark, sf_dir):
    k = F.col("c_custkey").cast("string")
    field = lambda n, v: F.concat(F.lit(f'<div class="x field--name-{n} y"><b>'), v, F.lit("</b></div>"))
    ld = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('<script type="application/ld+json">{"@graph":[{"name":"Ld '), k, F.lit('"}]}</script>'))).otherwise("")
    link = lambda name: F.concat(F.lit('<a class="z" href="/f/'), k, F.lit(f'{name}">file</a>'))
    pdfs = F.concat(link("_fr.pdf"), F.when(F.col("c_custkey") % 2 == 0, link("_en.pdf")).otherwise(""))
    audios = F.concat(link("_fl.mp3"), F.when(F.col("c_custkey") % 2 == 1, link("_en.mp3")).otherwise(""))
    html = F.concat(ld, field("country", F.concat(F.lit("L"), "c_nationkey")), field("speaker", F.concat(F.lit("N &amp; "), k)), field("title", F.lit("Minister")), F.lit('<time datetime="2025-09-'), (F.col("c_custkey") % 15 + 10).cast("string"), F.lit('T10:00:00Z">'), pdfs, audios)
    c = dealt(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
    p = pages.speaker_pages(c.select("c_custkey", html.alias("html")))
    return p.select("c_custkey", "country", "name", "title", "date", F.col("english_pdf.url").alias("english"), F.size("audios").alias("audios"))


@query("""SELECT o_custkey % 20 AS day, CASE WHEN min(o_orderkey) % 2 = 0 THEN 'morning' ELSE 'afternoon' END AS part, 's' || o_custkey AS slug FROM orders GROUP BY o_custkey % 20, o_custkey""")
def day_schedule(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg((F.min("o_orderkey") % 2).alias("half"))
    link = F.concat(F.lit('<a href="/en/80/s'), F.col("o_custkey").cast("string"), F.lit('">speech</a>'))
    parts = o.groupBy((F.col("o_custkey") % 20).alias("day"), "half").agg(F.concat_ws("", F.array_sort(F.collect_list(link))).alias("links"))
    block = F.concat(F.lit('<section class="block '), F.when(F.col("half") == 0, "morning").otherwise("afternoon"), F.lit('">'), "links", F.lit("</section>"))
    html = parts.groupBy("day").agg(F.concat_ws("", F.reverse(F.array_sort(F.collect_list(block)))).alias("html"))
    return pages.schedule(html, "day").select("day", "part", "slug")


@query("SELECT n_nationkey AS k, array_to_string(list_transform(string_split(lower(n_name), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS country, unnest(['HS', 'HG', 'MFA']) AS level, unnest(['Ann ' || n_nationkey, 'Bo ' || n_regionkey, 'Ann ' || n_nationkey]) AS person FROM nation")
def protocol_lists(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    head = "          Head of State           Head of Government      Minister for Foreign Affairs\n"
    cell = lambda c, width: F.rpad(c, width, " ")
    row = F.concat(F.lit(" " * 10), cell(F.concat(F.lit("Ann "), "n_nationkey"), 24), cell(F.concat(F.lit("Bo "), "n_regionkey"), 24), F.lit("Same as Head of State"))
    text = F.concat(F.lit(head), F.upper("n_name"), F.lit("\n"), row, F.lit("\n"))
    return pages.protocol_people(n.select(F.col("n_nationkey").alias("k"), text.alias("t")), "k", "t").select("k", "country", "level", "person")


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY event_id) - 1 AS position, event_type AS keyword, 'u' || user_id AS speaker, value AS video_seconds FROM events""")
def day_snapshots(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_type").alias("keyword"), F.concat(F.lit("u"), "user_id").alias("speaker"), F.col("value").alias("video_seconds"))
    docs = e.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("event_id", "keyword", "speaker", "video_seconds"))).alias("hits"))
    value = F.when(F.dayofmonth(F.to_date("day")) % 2 == 0, F.to_json("hits")).otherwise(F.to_json(F.struct("hits")))
    return store.parse_snapshots(docs.select("day", value.alias("value"))).select("day", F.col("position").cast("long").alias("position"), "keyword", "speaker", "video_seconds")


@query("SELECT 's' || c_custkey AS slug, '2025-09-' || (10 + c_custkey % 15) AS day FROM customer WHERE c_custkey % 4 > 0")
def date_indexes(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    day = F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.concat(F.lit("2025-09-"), (F.col("c_custkey") % 15 + 10).cast("string"), F.lit("T09:00")))
    entry = F.struct(F.concat(F.lit("s"), "c_custkey").alias("key"), day.alias("value"))
    docs = c.groupBy("c_nationkey").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    return store.date_index(docs)


@query("SELECT c_mktsegment AS day, c_custkey::VARCHAR AS stem FROM customer WHERE c_nationkey % 2 = 0")
def speech_paths(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = F.concat(F.lit("file:/out/"), F.when(F.col("c_nationkey") % 2 == 0, "80/").otherwise("180x/"), "c_mktsegment", F.lit("/"), F.col("c_custkey").cast("string"), F.lit(".txt"))
    return store.speech_files(c.select(path.alias("path")), 80).select("day", "stem")


@query("""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'Név ' || c_custkey % 100 END AS name, 'L' || c_nationkey AS country FROM customer),
b AS (SELECT lower(name) AS n FROM r WHERE name <> '' GROUP BY 1 HAVING count(DISTINCT country) >= 3), s AS (SELECT c_custkey, CASE WHEN name = '' OR lower(name) IN (SELECT n FROM b) THEN country ELSE name END AS name, country FROM r)
SELECT position, name, country FROM (SELECT c_custkey AS position, name, country, row_number() OVER (PARTITION BY lower(strip_accents(name)) ORDER BY c_custkey) AS n FROM s) WHERE n = 1""")
def roster_agenda(spark, sf_dir):
    k = F.col("c_custkey")
    r = table(spark, sf_dir, "customer").select(k.alias("position"), F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("Név "), k % 100)).alias("name"), F.concat(F.lit("L"), "c_nationkey").alias("country"), F.lit("").alias("rank"), F.lit("").alias("speaker_title"))
    return store.agenda_of_roster(r).select("position", "name", "country")


@query("""WITH c AS (SELECT doc_id, t, coalesce(p, s, w, length(t) // 2) AS cut FROM (SELECT doc_id, t, CASE WHEN p0 >= 400 THEN p0 + 2 END AS p, CASE WHEN s0 >= 400 THEN s0 + 2 END AS s, CASE WHEN w0 >= 400 THEN w0 + 1 END AS w FROM (
SELECT doc_id, t, CASE WHEN contains(h, chr(10) || chr(10)) THEN length(h) - strpos(reverse(h), chr(10) || chr(10)) - 1 ELSE -1 END AS p0, CASE WHEN contains(h, '. ') THEN length(h) - strpos(reverse(h), ' .') - 1 ELSE -1 END AS s0, CASE WHEN contains(h, ' ') THEN length(h) - strpos(reverse(h), ' ') ELSE -1 END AS w0
FROM (SELECT doc_id, text AS t, left(text, (length(text) // 2 + 200)::INTEGER) AS h FROM documents))))
SELECT doc_id, 0 AS part, CASE WHEN length(t) < 800 THEN t ELSE trim(left(t, cut::INTEGER)) END AS text FROM c UNION ALL SELECT doc_id, 1, trim(substr(t, cut::INTEGER + 1)) FROM c WHERE length(t) >= 800""")
def chunk_halves(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(labels.halves("text")).alias("part", "text"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 OR source = 'pdf_other' THEN 'translate' WHEN doc_id % 2 = 0 THEN 'whisper' ELSE 'none' END AS transformation, CASE WHEN doc_id % 3 = 0 THEN 'en' WHEN doc_id % 4 = 0 THEN 'und' ELSE lang END AS language,
(length(trim(text)) > 0 AND text <> lang AND length(trim(text)) * 4 >= length(trim(lang)) AND length(trim(text)) <= length(trim(lang)) * 4 + 40) AS translated FROM documents""")
def source_labels(spark, sf_dir):
    k = F.col("doc_id")
    file = F.when(k % 4 == 0, "x_fl.mp3").otherwise(F.concat(F.lit("x_"), "lang", F.lit(".pdf")))
    return table(spark, sf_dir, "documents").select(
        "doc_id", labels.transformation(F.when(k % 2 == 0, "video").otherwise(F.col("source")), k % 5 == 0).alias("transformation"),
        labels.file_language(F.when(k % 3 == 0, "pdf_en").otherwise("pdf_other"), F.lit(""), file).alias("language"), C.looks_translated("lang", "text").alias("translated"),
    )


@query("""WITH t AS (SELECT doc_id, ['climate change', ' HUMAN RIGHTS ', 'Development / SDGs', 'cats'][1 + doc_id % 4] AS topic, doc_id % 40 AS s FROM documents),
n AS (SELECT s, CASE trim(lower(topic)) WHEN 'climate change' THEN 'Climate change' WHEN 'human rights' THEN 'Human rights' WHEN 'development / sdgs' THEN 'Development / SDGs' END AS topic, doc_id FROM t)
SELECT 'M_' || s AS id_speech, topic, 'M_' || s || '_' || trim(regexp_replace(lower(topic), '[^a-z0-9]+', '_', 'g'), '_') AS extract_id, 'x' || min(doc_id) AS extract FROM n WHERE topic IS NOT NULL AND s <> 7 GROUP BY s, topic""")
def emerging_topics(spark, sf_dir):
    k = F.col("doc_id")
    names = F.array(*[F.lit(x) for x in ("climate change", " HUMAN RIGHTS ", "Development / SDGs", "cats")])
    d = table(spark, sf_dir, "documents").select(T.format_id(k % 40).alias("id_speech"), F.element_at(names, (k % 4 + 1).cast("int")).alias("topic"), F.concat(F.lit("x"), k).alias("extract"), k.alias("pos"))
    return codebook.emerging_rows(d, d.where("id_speech <> 'M_7'"))


@query(f"""WITH c AS (SELECT indicator_name AS i, human AS h, machine AS m FROM ({_PAIRS})), o AS (SELECT i, avg((h <> m)::INTEGER) AS d, 2 * count(*) AS n FROM c GROUP BY i),
v AS (SELECT i, x, count(*) AS k FROM (SELECT i, h AS x FROM c UNION ALL SELECT i, m FROM c) GROUP BY ALL), e AS (SELECT i, sum(k * (k - 1)) AS same FROM v GROUP BY i)
SELECT i AS indicator_name, round(1 - d / (1 - same / (n * (n - 1))), 6) AS alpha FROM o JOIN e USING (i)""")
def coder_alpha(spark, sf_dir):
    return codebook.krippendorff_alpha(_pairs(spark, sf_dir)).select("indicator_name", F.round("alpha", 6).alias("alpha"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'c' || c_custkey ELSE '' END AS id, '["a", 1]' AS list, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS note FROM customer""")
def analysis_rows(spark, sf_dir):
    k = F.col("c_custkey")
    answer = F.concat(F.lit('{"id": "wrong", "list": ["a", 1], "note": '), F.when(k % 3 == 0, "null").otherwise(F.concat(F.lit('" '), "c_name", F.lit(' "'))), F.lit("}"))
    row = codebook.analysis_row({"id": F.when(k % 2 == 0, F.concat(F.lit("c"), k))}, answer, ["id", "list", "note"])
    out = table(spark, sf_dir, "customer").select("c_custkey", row.alias("r")).select("c_custkey", "r.*")
    return out.withColumn("list", F.regexp_replace("list", ",", ", "))


@query("""WITH w AS (SELECT DISTINCT lower(p_type) AS wish FROM part UNION SELECT 'NAME ' || p_partkey % 7 FROM part UNION SELECT 'none ' || p_partkey % 3 FROM part), s AS (SELECT 'Name ' || p_partkey || ' ' || p_type AS name, p_brand AS country FROM part),
e AS (SELECT wish, count(*) AS n FROM w JOIN s ON contains(lower(name), lower(wish)) GROUP BY 1) SELECT wish, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'ok' ELSE 'ambiguous' END AS state FROM w LEFT JOIN e USING (wish)""")
def saved_selection(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    saved = p.select(F.concat_ws(" ", F.lit("Name"), F.col("p_partkey").cast("string"), "p_type").alias("name"), F.col("p_brand").alias("country"))
    number = lambda word, n: p.select(F.concat(F.lit(word), (F.col("p_partkey") % n).cast("string")).alias("wish"))
    wanted = p.select(F.lower("p_type").alias("wish")).unionByName(number("NAME ", 7)).unionByName(number("none ", 3))
    return mail.select_saved(saved, wanted).select("wish", "state")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Minister' ELSE '' END || CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 > 0 THEN ', ' ELSE '' END || CASE WHEN c_custkey % 3 > 0 THEN 'L' || c_nationkey ELSE '' END AS title FROM customer")
def display_titles(spark, sf_dir):
    k = F.col("c_custkey")
    title, country = F.when(k % 2 == 0, "Minister").otherwise(""), F.when(k % 3 > 0, F.concat(F.lit("L"), "c_nationkey")).otherwise("")
    return table(spark, sf_dir, "customer").select("c_custkey", publish.joined_title(title, country).alias("title"))


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'pdf' WHEN doc_id % 3 = 0 THEN 'audio' WHEN doc_id % 5 = 0 THEN 'video' END AS source, CASE WHEN doc_id % 3 = 0 THEN 'audio' WHEN doc_id % 2 = 0 THEN 'pdf' END AS heard FROM documents""")
def chosen_sources(spark, sf_dir):
    k, text = F.col("doc_id"), F.lit("x")
    have = {"pdf": F.when(k % 2 == 0, text), "audio": F.when(k % 3 == 0, text), "video": F.when(k % 5 == 0, text)}
    sources = F.map_filter(F.create_map(*[x for n, c in have.items() for x in (F.lit(n), c)]), lambda _, v: v.isNotNull())
    first = {"audio": have["audio"], "pdf": have["pdf"]}
    return table(spark, sf_dir, "documents").select("doc_id", files.choose_source(sources, ["pdf", "audio", "video"]).alias("source"), T.first_available(first).alias("heard"))


@query("SELECT event_id FROM events WHERE event_type IN ('error', 'signup') OR contains(props, '7')")
def highlight_lines(spark, sf_dir):
    logs = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("level"), F.col("props").alias("message"))
    return sinks.highlight_lines(logs, ["error", "signup"], ["7"]).select("event_id")


@query(r"""WITH p AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN repeat('/i12 ', 30) || left(url, 9) WHEN 1 THEN repeat('/7', 19) WHEN 2 THEN repeat('/3 ', 25) || url || url || url || url ELSE url END AS t FROM pages)
SELECT page_id, len(regexp_extract_all(t, '/i?\d+')) >= 20 AND length(regexp_replace(regexp_replace(t, '/i?\d+', ' ', 'g'), '\P{L}', '', 'g')) < greatest(20, len(regexp_extract_all(t, '/i?\d+')) // 5) AS garbage, page_id % 7 = 0 AS challenge FROM p""")
def page_states(spark, sf_dir):
    k, url = F.col("page_id"), F.col("url")
    t = F.when(k % 5 == 0, F.concat(F.lit("/i12 " * 30), F.left(url, F.lit(9)))).when(k % 5 == 1, F.lit("/7" * 19)).when(k % 5 == 2, F.concat(F.lit("/3 " * 25), url, url, url, url)).otherwise(url)
    body = F.when(k % 14 == 0, "<html>AwsWaf challenge").when(k % 7 == 0, "wait").otherwise("a page")
    p = table(spark, sf_dir, "pages").select("page_id", t.alias("t"), body.alias("b"), F.when(k % 7 == 0, 202).otherwise(200).alias("s"))
    return p.select("page_id", C.is_glyph_garbage("t").alias("garbage"), pages.is_waf_page(F.col("s"), F.col("b")).alias("challenge"))


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN c_custkey WHEN 1 THEN -c_custkey WHEN 2 THEN 7 END::INTEGER AS code, CASE WHEN c_custkey % 2 = 0 THEN '["a", ' || c_custkey || ']' END AS codes FROM customer""")
def model_answers(spark, sf_dir):
    k = F.col("c_custkey")
    s = k.cast("string")
    raw = F.when(k % 6 == 0, s).when(k % 6 == 1, F.concat(F.lit("-"), s)).when(k % 6 == 2, " 7 ").when(k % 6 == 3, "1.5").when(k % 6 == 4, "")
    answer = F.when(k % 2 == 0, F.concat(F.lit('Sure: ```json\n{"codes": ["a"], "x": 1}\n``` and {"codes": ['), s, F.lit(']} {broken'))).otherwise("nothing")
    merged = F.get_json_object(C.lenient_json(answer), "$.codes")
    return table(spark, sf_dir, "customer").select("c_custkey", T.strict_code(raw).alias("code"), F.regexp_replace(merged, ",", ", ").alias("codes"))
