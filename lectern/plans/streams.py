"""Registered queries of speaker rules, name matching and streams over the driver's tables, each beside its SQL.

A stream runs over the files of a table until all are read, and its rows are read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fuzzy
from ..functions import text as T
from ..operators import codebook, corrections, likeness, publish
from ..session import work_folder
from ..sources import versions
from ..streaming import attribution, loop, processors, speaker, windows
from ..streaming.monitor import Monitor, stream_monitor
from .registry import _CODES, _PROJECTION, ORACLES, _payload, _projected, query, table


def run_stream(stream: DataFrame, path: str | None = None) -> DataFrame:
    """All rows of a stream over files that are there; transformWithState keeps its state in RocksDB, below path."""
    spark, path = stream.sparkSession, path or work_folder(stream.sparkSession)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    q = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def streamed(spark, sf_dir, name) -> DataFrame:
    """A table as a stream; a table may be one file or a folder of files."""
    stored = table(spark, sf_dir, name)
    one = any(f.endswith(f"/{name}.parquet") for f in stored.inputFiles())
    folder, files = (sf_dir, f"{name}.parquet") if one else (f"{sf_dir}/{name}.parquet", "*.parquet")
    return spark.readStream.schema(stored.schema).option("pathGlobFilter", files).parquet(folder)


def closed(stream: DataFrame, *times: str, **values) -> DataFrame:
    """The stream with a last row far ahead in the named times, of these values and else nulls, so that the watermark passes all that is open.

    A join needs a key in it: rows with null keys go before the watermark sees them.
    """
    spark, path = stream.sparkSession, work_folder(stream.sparkSession)
    far = [F.lit("2199-01-01" if c in times else values.get(c)).cast(k).alias(c) for c, k in stream.dtypes]
    spark.range(1).select(*far).write.parquet(path)
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(path))


@query(ORACLES["cooldown_events"])
def stream_cooldown(spark, sf_dir):
    e = streamed(spark, sf_dir, "events").select("event_type", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return run_stream(processors.stream_cooldown(e, ["event_type", "user_id"], "t", 86_400_000_000))


@query("""WITH RECURSIVE e AS (SELECT event_type, props, epoch_us(ts) AS t, min(event_id) AS event_id FROM events GROUP BY ALL), p AS (SELECT event_type, props, min(t) AS t FROM e GROUP BY ALL UNION ALL
SELECT p.event_type, p.props, min(e.t) FROM p JOIN e ON e.event_type = p.event_type AND e.props = p.props AND e.t >= p.t + 3600000000 GROUP BY p.event_type, p.props)
SELECT e.event_type, e.props, e.t, e.event_id FROM e JOIN p USING (event_type, props, t)""")
def stream_dedup(spark, sf_dir):
    e = streamed(spark, sf_dir, "events").select("event_type", "props", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_id")
    return run_stream(processors.stream_dedup(e, ["event_type", "props"], "t", 3_600_000_000))


@query(r"""WITH c AS (SELECT conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) AS f FROM conversations),
w AS (SELECT conv_id, turn, f, len(l) AS many, unnest(l) AS hit, unnest(range(len(l))) AS i FROM (SELECT *, regexp_extract_all(f, '[\p{L}\p{N}_]+') AS l FROM c)),
h AS (SELECT conv_id, turn, i, lower(hit) AS keyword, '"' || CASE WHEN i = 0 AND starts_with(f, hit) THEN '' ELSE '...' END || hit || CASE WHEN i = many - 1 AND ends_with(f, hit) THEN '' ELSE '...' END || '"' AS context FROM w WHERE lower(hit) IN ('que', 'the')),
g AS (SELECT conv_id, turn, keyword, context, min(i) AS i FROM h GROUP BY ALL)
SELECT conv_id, turn::BIGINT AS seq, turn * 1000.0::DOUBLE + 1790000000 AS seconds, 'unknown' AS speaker, keyword, context, row_number() OVER (PARTITION BY conv_id, turn, keyword ORDER BY i) = 1 AS send FROM g""")
def stream_journal(spark, sf_dir):
    """Turns lie 1,000 seconds apart, so a hit is new unless its own window has it already, and the first of a keyword is sent."""
    c = streamed(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("seq"), (F.col("turn") * 1000.0 + 1_790_000_000.0).alias("seconds"), "text")
    return run_stream(stream_monitor(c, "conv_id", Monitor(["que", "the"], speaker.SpeakerRules([]), 0, 8, 120)))


#: What is put into a text, and whether a chair introduces or thanks somebody with it.
_SAID = [
    ("I now give the floor to the President of Peru.", True), ("The Assembly will here an address", True), ("We shall now hear Mr. X", True), ("the distinguished representative", True),
    ("We give thanks", False), ("I wish to thank the President of Chad.", True), ("The meeting is adjourned", False), ("floor plans", False),
]


@query(
    f"""WITH p AS (SELECT {[t for t, _ in _SAID]} AS said), d AS (SELECT doc_id, left(text, 200) || ' ' || said[length(text) % 9] || ' ' || substr(text, 201) AS text FROM documents, p WHERE length(text) % 9 > 0 UNION ALL SELECT doc_id, text FROM documents WHERE length(text) % 9 = 0)
SELECT doc_id FROM d WHERE regexp_matches(text, '(?i)give\\s+the\\s+floor|the assembly will here|we shall now hear|the distinguished representative|i wish to thank the ')"""
)
def introduction_lines(spark, sf_dir):
    """Phrases stand inside the documents' texts, chosen by their length; one in nine has none."""
    n = F.length("text") % 9
    said = F.element_at(F.array(*[F.lit(t) for t, _ in _SAID]), F.when(n > 0, n).otherwise(1).cast("int"))
    text = F.when(n == 0, F.col("text")).otherwise(F.concat_ws(" ", F.left("text", F.lit(200)), said, F.substring("text", F.lit(201), F.length("text"))))
    java = lambda p: "(?i)" + p.pattern.replace("(?i)", "")
    return corrections.introductions(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")), java(speaker.CUE), java(speaker.THANKS)).select("doc_id")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN c_nationkey ELSE 1000 + s_suppkey END::BIGINT AS position,
CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 'country' ELSE 'name' END AS found_by
FROM customer JOIN supplier ON s_suppkey = c_custkey % (SELECT count(*) FROM supplier) + (SELECT min(s_suppkey) FROM supplier)""")
def roster_match(spark, sf_dir):
    """Every supplier has a made-up name of two words; customers are heard to say one with a letter lost, one doubled and one replaced, or only a country."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier").select("s_suppkey")
    word = lambda salt, size: F.initcap(F.substring(F.translate(F.sha2(F.concat(F.lit(salt), F.col("s_suppkey").cast("string")), 256), "0123456789", "ghijklmnop"), 1, size))
    names = s.select("s_suppkey", word("a", 8).alias("first"), word("b", 10).alias("last"))
    people = names.select((F.col("s_suppkey") + 1000).cast("long").alias("position"), F.concat_ws(" ", "first", "last").alias("name"), F.lit("").alias("country"), F.lit("").alias("title"))
    heads = n.select(F.col("n_nationkey").cast("long").alias("position"), F.lit("").alias("name"), F.initcap("n_name").alias("country"), F.lit("President").alias("title"))
    of = s.agg(F.count(F.lit(1)).alias("many"), F.min("s_suppkey").alias("low"))
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).crossJoin(F.broadcast(of)).withColumn("s_suppkey", k % F.col("many") + F.col("low"))
    first = F.concat(F.substring("first", 1, 3), F.substring("first", 5, 9))
    last = F.concat(F.substring("last", 1, 4), F.substring("last", 4, 3), F.lit("z"), F.substring("last", 8, 9))
    heard = c.join(names, "s_suppkey").select(
        k, F.when(k % 7 == 0, "unknown").when(k % 5 == 0, "").otherwise(F.upper(F.concat_ws(" ", first, last))).alias("name"),
        F.when(k % 7 == 0, "President").when(k % 5 == 0, F.concat(F.lit("Minister of the Republic of "), F.initcap("n_name"))).alias("title"), F.lit("").alias("country"),
    )
    return likeness.match_roster(heard, people.unionByName(heads)).select("c_custkey", "position", "found_by")


@query("SELECT c_custkey, lower(strip_accents(c_name)) || ' ecole d abord ' || c_nationkey AS folded, 'ecole-d-abord-' || c_nationkey AS slug, 'L' || c_nationkey AS country FROM customer".replace("lower(strip_accents(c_name))", "replace(lower(c_name), '#', ' ')"))
def folded_names(spark, sf_dir):
    k = F.col("c_nationkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", fuzzy.fold_name(F.concat("c_name", F.lit(" École d’Abord-"), k)).alias("folded"), T.country_slug(F.concat(F.lit("École d’Abord "), k, F.lit(" (the)"))).alias("slug"),
        F.regexp_extract(F.concat(F.lit("Minister of State of the L"), k), r"(?i).*\bof\s+(?:the\s+)?(.*)$", 1).alias("country"),
    )


@query(
    _CODES
    + """SELECT id_speech, indicator_name, coalesce(CASE WHEN indicator_name = 'future_multilateralism_position' THEN CASE code WHEN 0 THEN 'No Mention' WHEN 5 THEN 'Preservation / Strengthening' WHEN 2 THEN 'Mixed / Ambiguous' WHEN 6 THEN 'Transformation' END
ELSE CASE code WHEN 0 THEN 'No Mention' WHEN 1 THEN 'Positive / Supportive' WHEN 2 THEN 'Mixed / Ambiguous' WHEN 3 THEN 'Negative / Pushback' END END, '') AS option, CASE WHEN indicator_name LIKE 'sg%' THEN 'SG election' WHEN indicator_name LIKE 'un%' THEN 'UN reform' WHEN indicator_name LIKE '%multilateralism%' THEN 'Multilateralism' ELSE 'Gender and women''s leadership' END AS cluster FROM c"""
)
def codebook_labels(spark, sf_dir):
    last = codebook.last_codes(_payload(spark, sf_dir))
    return last.select("id_speech", "indicator_name", codebook.option(F.col("indicator_name"), F.col("code")).alias("option"), codebook.cluster(F.col("indicator_name")).alias("cluster"))


@query(_PROJECTION + "SELECT day, printf('%s  %d of %d speeches  %d e-mails  projected %s', day, analysed::BIGINT, expected::BIGINT, emails::BIGINT, coalesce(printf('%.1f', floor(projected::DECIMAL(28, 6) * 10 + 0.5)::DOUBLE / 10), '-')) AS line FROM o")
def report_lines(spark, sf_dir):
    return publish.report_lines(_projected(spark, sf_dir))


# --- windows, surroundings, agendas and states handed over -------------------------------------------------

_START = 1_790_000_000  # on 2026-09-21


def _spoken(spark, sf_dir, seconds: int) -> DataFrame:
    """The conversations as a stream of lines: each turn so many seconds after the one before."""
    at = F.timestamp_seconds(F.lit(_START) + F.col("turn") * seconds)
    return streamed(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), at.alias("ts"), "text")


@query("""WITH l AS (SELECT conv_id, turn, 1790000000 + turn * 7 AS t, coalesce(text, '') AS text FROM conversations),
w AS (SELECT *, unnest(range(((t - 20) // 16) * 16 + 16, t + 1, 16)) AS s FROM l)
SELECT conv_id, s::BIGINT AS start, s::BIGINT + 20 AS "end", count(*) AS lines, coalesce(string_agg(text, ' ' ORDER BY t, turn, text) FILTER (text <> ''), '') AS text FROM w GROUP BY conv_id, s""")
def stream_windows(spark, sf_dir):
    found = run_stream(windows.hopping_text(closed(_spoken(spark, sf_dir, 7), "ts"), "conv_id", "ts", ["turn"], "text")).where("conv_id IS NOT NULL")
    return found.select("conv_id", F.unix_timestamp("start").alias("start"), F.unix_timestamp("end").alias("end"), "lines", "text")


@query("""WITH l AS (SELECT user_id % 4 AS k, epoch_us(ts) AS s, epoch_us(ts) + (event_id % 5000) * 1000000 AS e, 'e' || event_id AS text FROM events),
h AS (SELECT event_id, user_id % 4 AS k, epoch_us(ts) AS a FROM events WHERE event_type = 'error'),
j AS (SELECT h.event_id, h.a, l.* FROM h JOIN l ON l.k = h.k AND l.s <= h.a + 3600000000 AND l.s >= h.a - 12600000000 AND l.e >= h.a - 7200000000),
o AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY s, e, text) AS n, max(e) OVER (PARTITION BY event_id ORDER BY s, e, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM j WHERE s < a + 3600000000 AND e > a - 7200000000),
p AS (SELECT event_id, string_agg(text, ' ' ORDER BY s, e, text) AS passage FROM o WHERE n = 1 OR e > before + 300000 GROUP BY event_id)
SELECT DISTINCT j.event_id, coalesce(p.passage, '') AS passage FROM j LEFT JOIN p USING (event_id)""")
def stream_context_join(spark, sf_dir):
    e = streamed(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 4).alias("k"), F.col("ts").cast("timestamp").alias("at"), "event_type")
    length = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("event_id") % 5000)
    lines = e.select("k", F.col("at").alias("start"), (F.col("at") + length).alias("end"), F.concat(F.lit("e"), F.col("event_id")).alias("text"))
    hits = e.where("event_type = 'error'").select("k", "at", "event_id")
    reach = {"before": 7200, "after": 3600, "longest": 5400}
    held = windows.context_windows(closed(hits, "at", k=-1), closed(lines, "start", "end", k=-1), "k", "at", ["event_id"], "start", "end", "text", **reach)
    # A line stands in the passages of all hits around it, so the stream's windows are stored, and passages are made as they are read.
    return windows.passages(run_stream(held), "k", "at", ["event_id"], **reach).where("event_id IS NOT NULL").select("event_id", "passage")


def _letters(number) -> Column:
    return F.translate(number.cast("string"), "0123456789", "bcdfghjklm")


def _introducing(lines: DataFrame) -> DataFrame:
    """In the second turn of each conversation a chair gives the floor to the president of the conversation's own country."""
    says = F.concat(F.lit("I now give the floor to the President of Land"), _letters(F.col("conv_id")), F.lit("."))
    return lines.withColumn("text", F.when(F.col("turn") == 1, says).otherwise(F.col("text")))


def _entries() -> Column:
    one = F.struct(F.concat(F.lit("Head "), _letters(F.col("conv_id"))).alias("name"), F.concat(F.lit("Land"), _letters(F.col("conv_id"))).alias("country"), F.lit("President").alias("title"))
    return F.array(one)


_DAY = "2026-09-21"


@query("""WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, translate(conv_id::VARCHAR, '0123456789', 'bcdfghjklm') AS l FROM conversations)
SELECT conv_id, 'line' AS kind, turn::BIGINT AS seq, CASE WHEN turn > 1 AND conv_id % 2 = 1 THEN 'Head ' || l ELSE 'unknown' END AS speaker, NULL AS message FROM c
UNION ALL SELECT conv_id, 'status', NULL, NULL, 'no agenda of 2026-09-21; 0 speakers of another agenda are used' FROM c WHERE n = 1 AND conv_id % 2 = 0""")
def stream_agendas(spark, sf_dir):
    """Agendas come in the stream: of odd conversations before the introduction, of even ones after it."""
    lines = _spoken(spark, sf_dir, 20)
    when = F.timestamp_seconds(F.lit(_START) + F.when(F.col("conv_id") % 2 == 1, 0).otherwise(50))
    plan = lines.where("turn = 1").select("conv_id", when.alias("at"), F.lit(_DAY).alias("day"), _entries().alias("entries"))
    both = attribution.lines_of(_introducing(lines), "conv_id", "turn", "ts", "text").unionByName(attribution.agendas_of(plan, "conv_id", "at", "day", "entries"))
    return run_stream(attribution.attribute(both, "conv_id", speaker.SpeakerRules([]))).select("conv_id", "kind", "seq", "speaker", "message")


@query("""SELECT conv_id, turn::BIGINT AS seq, CASE WHEN turn > 1 AND conv_id % 3 <> 0 THEN 'Head ' || translate(conv_id::VARCHAR, '0123456789', 'bcdfghjklm') ELSE 'unknown' END AS speaker FROM conversations
WHERE turn > 2 AND conv_id IN (SELECT conv_id FROM conversations WHERE turn = 1)""")
def stream_taken_over(spark, sf_dir):
    """One query reads the first three turns, another one the rest: from the first one's state, ten minutes or (every third conversation) two hours later."""
    rules, lines = speaker.SpeakerRules([]), _introducing(_spoken(spark, sf_dir, 20))
    plan = lines.where("turn = 1").select("conv_id", F.timestamp_seconds(F.lit(_START)).alias("at"), F.lit(_DAY).alias("day"), _entries().alias("entries"))
    first = attribution.lines_of(lines.where("turn <= 2"), "conv_id", "turn", "ts", "text").unionByName(attribution.agendas_of(plan, "conv_id", "at", "day", "entries"))
    path = work_folder(spark)
    run_stream(attribution.attribute(first, "conv_id", rules), path)
    pause = F.make_dt_interval(F.lit(0), F.lit(0), F.when(F.col("conv_id") % 3 == 0, 120).otherwise(10))
    rest = attribution.lines_of(lines.where("turn > 2").withColumn("ts", F.col("ts") + pause), "conv_id", "turn", "ts", "text")
    taken = attribution.saved_trackers(spark, f"{path}/state", "conv_id")
    found = run_stream(attribution.attribute(rest, "conv_id", rules, taken_over=taken))
    return found.where("kind = 'line'").select("conv_id", "seq", "speaker")


@query(r"""WITH RECURSIVE d AS (SELECT conv_id, turn, CASE WHEN turn = 1 THEN 'I now give the floor to the President of Land' || translate(conv_id::VARCHAR, '0123456789', 'bcdfghjklm') || '.' ELSE text END AS text FROM conversations),
c AS (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS f FROM d),
w AS (SELECT conv_id, turn, f, len(l) AS many, unnest(l) AS hit, unnest(range(len(l))) AS i FROM (SELECT *, regexp_extract_all(f, '[\p{L}\p{N}_]+') AS l FROM c)),
h AS (SELECT conv_id, turn, lower(hit) AS keyword, arg_min('"' || CASE WHEN i = 0 AND starts_with(f, hit) THEN '' ELSE '...' END || hit || CASE WHEN i = many - 1 AND ends_with(f, hit) THEN '' ELSE '...' END || '"', i) AS context FROM w WHERE lower(hit) IN ('que', 'the') GROUP BY conv_id, turn, lower(hit)),
p AS (SELECT conv_id, keyword, min(turn) AS turn FROM h GROUP BY ALL UNION ALL SELECT p.conv_id, p.keyword, min(h.turn) FROM p JOIN h ON h.conv_id = p.conv_id AND h.keyword = p.keyword AND h.turn >= p.turn + 3 GROUP BY p.conv_id, p.keyword)
SELECT conv_id, h.turn::BIGINT AS seq, CASE WHEN conv_id % 2 = 1 AND h.turn > 1 THEN 'Head ' || translate(conv_id::VARCHAR, '0123456789', 'bcdfghjklm') ELSE 'unknown' END AS speaker, keyword, context,
(SELECT string_agg(x.text, ' ' ORDER BY x.turn) FROM c x WHERE x.conv_id = h.conv_id AND x.turn BETWEEN h.turn - 2 AND h.turn + 1 AND x.text <> '') AS passage FROM h JOIN p USING (conv_id, keyword, turn)""")
def stream_alerts(spark, sf_dir):
    """The whole loop: attributed lines, hits, cooldown, and what is sent with the lines around it. Agendas of odd conversations come in time, others never."""
    lines = closed(_introducing(_spoken(spark, sf_dir, 20)), "ts", conv_id=-1, turn=0, text="")
    plan = _spoken(spark, sf_dir, 20).where("turn = 1 AND conv_id % 2 = 1").select("conv_id", F.timestamp_seconds(F.lit(_START)).alias("at"), F.lit(_DAY).alias("day"), _entries().alias("entries"))
    both = attribution.lines_of(lines, "conv_id", "turn", "ts", "text").unionByName(attribution.agendas_of(plan, "conv_id", "at", "day", "entries"))
    around = lines.select("conv_id", F.col("ts").alias("start"), (F.col("ts") + F.expr("INTERVAL 20 SECONDS")).alias("end"), "text")
    found = loop.alerts(both, around, "conv_id", speaker.SpeakerRules([]), ["que", "the"], before=30, after=25, longest=20, context_words=0, cooldown=60)
    return run_stream(found).select("conv_id", "seq", "speaker", "keyword", "context", "passage")


# --- journals and stored tables ----------------------------------------------------------------------------


@query("SELECT event_id, event_type, event_id % 4 AS batch FROM events WHERE event_id % 4 <> 2")
def journal_commits(spark, sf_dir):
    """Four batches: the first is written twice, the second had left half of itself behind, the third was never committed."""
    e, path = table(spark, sf_dir, "events").select("event_id", "event_type"), work_folder(spark)
    part = lambda n: e.where(F.col("event_id") % 4 == n)
    versions.add_batch(part(0), path, 0, ["event_id"])
    versions.add_batch(part(0).unionByName(part(0)), path, 0, ["event_id"])
    for n, left in ((1, part(1).where("event_id % 8 = 1")), (2, part(2))):
        left.write.parquet(f"{path}/data/batch={n}")
    versions.add_batch(part(1), path, 1, ["event_id"])
    versions.add_batch(part(3), path, 3, ["event_id"])
    return versions.read_journal(spark, path, e.schema)


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOUSES' ELSE c_mktsegment END AS segment FROM customer WHERE c_mktsegment <> 'MACHINERY' UNION ALL SELECT s_suppkey + 1000000, 'SUPPLIER' FROM supplier")
def store_versions(spark, sf_dir):
    """A store that is filled, whose names change, from which a name goes, and to which rows come, each in one step."""
    path, schema = work_folder(spark), "c_custkey long, segment string"
    s = F.col("segment")
    more = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1_000_000).alias("c_custkey"), F.lit("SUPPLIER").alias("segment"))
    versions.change(spark, path, schema, lambda d: table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment")))
    versions.change(spark, path, schema, lambda d: d.withColumn("segment", F.when(s == "BUILDING", "HOUSES").otherwise(s)))
    versions.change(spark, path, schema, lambda d: d.where(s != "MACHINERY"))
    versions.change(spark, path, schema, lambda d: d.unionByName(more))
    versions.prune(spark, path)
    return versions.read_version(spark, path, schema)
