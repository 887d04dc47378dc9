"""Readers of speech files, journals, rosters and listings, as DataFrames."""

from __future__ import annotations

import tomllib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.labels import transformation
from ..operators.alerts import AlertConfig
from ..operators.rows import keep_first

HEADER = ["session", "slug", "country", "speaker", "title", "date", "source", "source_url", "language", "id_speech", "speaker_title", "original_language", "transformation", "via", "elapsed_s"]


def parse_front_matter(files: DataFrame, value: str = "value", path: str = "path", strict: bool = False) -> DataFrame:
    """path, the header's fields and the body of files of the form `---`, lines `key: value`, `---`, body.

    Fields split at the first colon; missing ones are empty; slug falls back to the file's stem. strict: the second marker must begin a
    line, the language is lower-cased and `und` if missing, dates are cut to ten characters.
    """
    whole = F.regexp_replace(F.col(value), "\r\n", "\n")
    rest = F.substring(whole, F.lit(4), F.length(whole))
    mark = F.lit("\n---") if strict else F.lit("---")
    at = F.locate("\n---" if strict else "---", rest)
    head, body = F.substring(rest, F.lit(1), at - 1), F.substring(rest, at + F.length(mark), F.length(rest))
    lines = F.filter(F.split(head, "\n"), lambda x: F.instr(x, ":") > 0)
    pair = lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("v"))
    rows = files.where(whole.startswith("---") & (at > 0)).select(F.col(path).alias("path"), F.transform(lines, pair).alias("_h"), T.col(F.trim(F.regexp_replace(body, r"(?U)^\s+|\s+$", ""))).alias("text"))
    field = lambda name: F.coalesce(F.get(F.filter("_h", lambda p: p["k"] == name), F.lit(0))["v"], F.lit(""))
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    out = rows.select("path", *[field(h).alias(h) for h in HEADER], "text")
    out = out.withColumn("slug", F.when(F.col("slug") == "", stem).otherwise(F.col("slug")))
    out = out.withColumn("id_speech", F.when((F.col("id_speech") == "") & T.id_number(stem).isNotNull(), stem).otherwise(F.col("id_speech")))
    out = out.withColumn("transformation", F.coalesce(F.nullif("transformation", F.lit("")), transformation(F.col("source"), F.lit(False))))
    out = out.withColumn("session", F.col("session").try_cast("int")).withColumn("elapsed_s", F.coalesce(F.col("elapsed_s").try_cast("double"), F.lit(0.0)))
    if strict:
        language = F.lower("language")
        out = out.withColumn("language", F.when(language == "", "und").otherwise(language)).withColumn("date", F.left("date", F.lit(10)))
    return out


def without_header(files: DataFrame, value: str = "value", path: str = "path", strict: bool = False) -> DataFrame:
    """The paths of the files that parse_front_matter passes over, for those who want to stop on them."""
    whole = F.regexp_replace(F.col(value), "\r\n", "\n")
    rest = F.substring(whole, F.lit(4), F.length(whole))
    good = whole.startswith("---") & (F.locate("\n---" if strict else "---", rest) > 0)
    return files.where(~F.coalesce(good, F.lit(False))).select(path)


def read_speeches(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Speech files below path (session and day folders are partitions)."""
    files = spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    return parse_front_matter(files, strict=strict)


def parse_log_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """timestamp, keyword, speaker, video_seconds, timestamp_reliable and context of journal lines; others are left out."""
    p = F.split(F.col(value), r" \| ")
    good = lines.where(F.col(value).rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d \| KEYWORD_DETECTED \| ") & (F.size(p) >= 4))
    middle = F.slice(p, F.lit(4), F.greatest(F.size(p) - 4, F.lit(0)))
    clock = F.get(F.filter(middle, lambda x: x.rlike(r"^t=\d+s\??$")), F.lit(0))
    return good.select(
        F.to_timestamp(F.get(p, F.lit(0)), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.get(p, F.lit(2)).alias("keyword"),
        F.coalesce(F.get(F.filter(middle, lambda x: ~x.rlike(r"^t=\d+s\??$")), F.lit(0)), F.lit("")).alias("speaker"),
        F.nullif(F.regexp_extract(clock, r"^t=(\d+)s", 1), F.lit("")).cast("double").alias("video_seconds"),
        (clock.isNotNull() & ~clock.endswith("?")).alias("timestamp_reliable"),
        F.element_at(p, -1).alias("context"),
    )


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; broken lines and those without a keyword are left out."""
    schema = "timestamp string, day string, keyword string, speaker string, speaker_title string, context string, video_seconds double, timestamp_reliable boolean, watch_url string, webtv_url string"
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where(F.coalesce("keyword", F.lit("")) != "")


def read_csv(spark: SparkSession, path: str, names: dict[str, list[str]]) -> DataFrame:
    """The named columns of a CSV with a header, found by any of their spellings, blind to case; missing values are empty."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    have = {c.lstrip("\ufeff").strip().lower(): c for c in raw.columns}
    pick = {n: next((have[o.lower()] for o in [n, *other] if o.lower() in have), None) for n, other in names.items()}
    return raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) if c else F.lit("").alias(n) for n, c in pick.items()])


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """One row for each speaker of roster documents, in agenda order."""
    schema = "session int, day string, speakers array<struct<slug string, ficha_url string, country string, name string, rank string, speaker_title string, speech_date string, chosen string, error string, http_status int>>"
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    return doc.select("session", "day", F.posexplode("speakers").alias("position", "s")).select("session", "day", "position", "s.*")


def parse_agenda(lines: DataFrame, value: str = "value", order: str = "position") -> DataFrame:
    """name, country and title of lines `name | country | title`; several stand in one line between semicolons; `#` starts a comment."""
    part = F.posexplode(F.split(F.col(value), "[;\n]")).alias("_k", "_line")
    rows = lines.select(order, part).withColumn("_line", F.trim("_line")).where((F.col("_line") != "") & ~F.col("_line").startswith("#"))
    p = F.split("_line", r"\|")
    at = lambda i: F.trim(F.coalesce(F.get(p, F.lit(i)), F.lit("")))
    out = rows.select(order, "_k", at(0).alias("name"), at(1).alias("country"), at(2).alias("title")).where("name <> ''")
    return keep_first(out, [F.lower("name")], [F.col(order), F.col("_k")]).drop("_k")


def parse_listing(docs: DataFrame, value: str = "value") -> DataFrame:
    """day, meeting, slot, name, country and title from nested meeting documents; placeholders, skipped and nameless entries are left out."""
    schema = "sampleData array<struct<MT_agendaitem struct<MT_AG_item string, MT_AG_title string>, MT_speakers array<struct<SP_slotNo string, SP_isSkip boolean, SP_LS_nameFormat boolean, SP_LS_fname string, SP_LS_lname string, SP_LS_funcTitle string, SP_entity struct<SP_entity string, SP_entityShort string>>>>>"
    m = docs.select(F.posexplode(F.from_json(value, schema)["sampleData"]).alias("meeting_no", "m"))
    s = m.select("meeting_no", F.col("m.MT_agendaitem.MT_AG_title").alias("meeting"), F.explode("m.MT_speakers").alias("s"))
    given, family = F.coalesce("s.SP_LS_fname", F.lit("")), F.coalesce("s.SP_LS_lname", F.lit(""))
    name = T.squeeze(F.when(F.col("s.SP_LS_nameFormat"), F.concat_ws(" ", family, given)).otherwise(F.concat_ws(" ", given, family)))
    day = F.try_to_date(F.regexp_replace(F.regexp_extract("meeting", r"(?i)(\d{1,2}\s+[a-z]+\s+\d{4})", 1), r"\s+", " "), "d MMMM yyyy")
    out = s.select(
        F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("")).alias("day"), "meeting", "meeting_no",
        F.coalesce(F.col("s.SP_slotNo").try_cast("int"), F.lit(0)).alias("slot"), name.alias("name"),
        F.coalesce("s.SP_entity.SP_entity", F.lit("")).alias("country"), F.coalesce("s.SP_LS_funcTitle", F.lit("")).alias("title"), F.coalesce("s.SP_isSkip", F.lit(False)).alias("_skip"),
    )
    return out.where((F.col("name") != "") & ~F.col("_skip") & ~F.lower("name").contains("forthcoming")).drop("_skip")


def read_slugs(lines: DataFrame, value: str = "value", order: str = "position") -> DataFrame:
    """First tokens of lines that are neither blank nor comments."""
    line = F.trim(value)
    return lines.where((line != "") & ~line.startswith("#")).select(order, F.get(F.split(line, r"\s+"), F.lit(0)).alias("slug"))


def load_alert_config(text: str, strict: bool = False) -> AlertConfig:
    """Keyword groups and timing from TOML."""
    raw = tomllib.loads(text)
    groups: dict[str, tuple[str, ...]] = {}
    for g in raw.get("group", []):
        words = tuple(str(k).strip() for k in g.get("keywords", []) if str(k).strip())
        if not g.get("name") or not words:
            raise ValueError("a keyword group needs a name and keywords")
        groups[g["name"]] = words
    names = {"cooldown_seconds": "cooldown_seconds", "chunk_seconds": "chunk_seconds", "chunk_overlap_seconds": "overlap_seconds", "words_per_minute": "words_per_minute", "speech_gap_seconds": "gap_seconds"}
    config = AlertConfig(groups, **{v: float(raw[k]) for k, v in names.items() if k in raw}, strict=strict)
    if config.overlap_seconds >= config.chunk_seconds:
        raise ValueError("the overlap must be shorter than a window")
    return config


def choose_source(sources: Column, order: list[str]) -> Column:
    """The first of the named sources that a map holds."""
    return F.get(F.filter(F.array(*[F.lit(s) for s in order]), lambda s: F.map_contains_key(sources, s) & F.element_at(sources, s).isNotNull()), F.lit(0))


