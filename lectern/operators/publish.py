"""Rows for the sheets and files that leave the engine: coding rows, kept ids, journal order, listings, exports and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .dims import fallback_lookup
from .rows import keep_first

#: The rank of speeches that a journal does not name, titles that say nothing.
UNRANKED = 10_000
BARE_TITLES = ["his excellency", "her excellency"]


# --- selection ---------------------------------------------------------------------------------------------


def of_day(df: DataFrame, day: str | None = None, slug: str | None = None, day_column: str = "day", slug_column: str = "slug") -> DataFrame:
    """The rows of a day (those without a day stay) and of a slug."""
    out = df if not day else df.where((F.coalesce(day_column, F.lit("")) == "") | (F.col(day_column) == day))
    return out if not slug else out.where(F.col(slug_column) == slug)


def to_extract(listed: DataFrame, stored: DataFrame, again: list[str], slug: str = "slug") -> DataFrame:
    """listed without the slugs that have a stored English speech already, but with those to be extracted again."""
    done = stored.where(F.lower(F.trim("language")).isin("en", "english")).where(~F.col(slug).isin(again)).select(slug).distinct()
    return listed.join(done, slug, "left_anti")


def selected_slugs(journal: DataFrame, listed: DataFrame, days: DataFrame, day: str, limit: int | None = None) -> DataFrame:
    """slug and position: the day's journal; without one the list, cut to the day by the date index (whole if the index is empty). A limit comes last."""
    own = journal.where(F.col("day") == day).groupBy("slug").agg(F.min("position").alias("position"))
    has_journal = own.agg(F.count(F.lit(1)).alias("_journal"))
    has_days = days.agg(F.count(F.lit(1)).alias("_days"))
    rest = listed.join(days.select("slug", F.left("day", F.lit(10)).alias("_day")), "slug", "left").crossJoin(F.broadcast(has_days)).crossJoin(F.broadcast(has_journal))
    rest = rest.where((F.col("_journal") == 0) & ((F.col("_days") == 0) | (F.col("_day") == day)))
    out = own.select("slug", F.col("position").cast("long").alias("position")).unionByName(rest.select("slug", F.col("position").cast("long").alias("position")))
    return out if limit is None else out.orderBy("position", "slug").limit(limit)


def coded_ids(*sources: DataFrame, key: str = "id_speech") -> DataFrame:
    """The ids that stand in any source, each once; empty ones go."""
    out = sources[0].select(F.trim(key).alias(key))
    for s in sources[1:]:
        out = out.unionByName(s.select(F.trim(key).alias(key)))
    return out.where(F.col(key) != "").distinct()


# --- order and ids -----------------------------------------------------------------------------------------


def journal_rank(speeches: DataFrame, journal: DataFrame, slug: str = "slug", position: str = "position") -> DataFrame:
    """speeches with rank: the place in the journal (the last of repeated slugs counts), UNRANKED for others. Order by rank, then slug."""
    places = journal.groupBy(slug).agg(F.max(position).alias("_rank"))
    return speeches.join(places, slug, "left").withColumn("rank", F.coalesce("_rank", F.lit(UNRANKED)).cast("long")).drop("_rank")


def id_order(id_speech: Column, slug: Column) -> list[Column]:
    """By the number of the id, others last, then by slug."""
    return [F.coalesce(T.id_number(id_speech), F.lit(1_000_000_000).cast("bigint")), slug]


def kept_numbers(items: DataFrame, sheet: DataFrame, url: str, position: str) -> DataFrame:
    """items with kept: the number of the header's id, else of the file's name, else of the last sheet row with the item's address; null for new ones.

    items: id_speech, stem and the address; sheet: id_speech, the address and a position. Numbers for the others come from rows.assign_ids.
    """
    known = sheet.select(F.trim(url).alias(url), T.id_number("id_speech").alias("_number"), position).where((F.col(url) != "") & F.col("_number").isNotNull())
    last = known.groupBy(url).agg(F.max_by("_number", position).alias("_sheet"))
    return items.join(last, url, "left").withColumn("kept", F.coalesce(T.id_number("id_speech"), T.id_number("stem"), "_sheet")).drop("_sheet")


def resolve_listings(listings: DataFrame, listing_id: str, title: str, slugs: DataFrame, slug: str = "slug", position: str = "position") -> DataFrame:
    """listings with slug: that of the catalogue whose slug, slugified or weak form equals the title's slugified, else its weak form; else the title's own slug."""
    forms = [F.col(slug), T.ascii_slug(slug), T.weak_slug(slug)]
    wanted = [T.ascii_slug(title), T.weak_slug(title)]
    found = fallback_lookup(listings, listing_id, wanted, slugs.select(position, slug), forms, position, [slug])
    return found.withColumn(slug, F.coalesce(slug, F.nullif(wanted[0], F.lit("")), wanted[1]))


def journal_lines(entries: DataFrame, day: str = "day", position: str = "position") -> DataFrame:
    """day, position, line_no and line of journal files: the slugs in order, below `# part` where a part begins. Days are small."""
    w = Window.partitionBy(day).orderBy(position)
    seen = F.last(F.nullif("part", F.lit("")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = entries.withColumn("_new", (F.coalesce("part", F.lit("")) != "") & ~F.col("part").eqNullSafe(seen))
    lines = F.when(F.col("_new"), F.array(F.concat(F.lit("# "), F.col("part")), F.col("slug"))).otherwise(F.array("slug"))
    return rows.select(day, position, F.posexplode(lines).alias("line_no", "line"))


def select_run(lines: DataFrame, key: str, run: int | None, name: str = "run") -> DataFrame:
    """The lines of one run of each key (see sequence.runs): from 0, from the end if negative, all for None. A run that is not there gives no rows."""
    if run is None:
        return lines
    if run >= 0:
        return lines.where(F.col(name) == run)
    last = lines.groupBy(key).agg(F.max(name).alias("_last"))
    return lines.join(last, key).where(F.col(name) == F.col("_last") + 1 + run).drop("_last")


# --- rows --------------------------------------------------------------------------------------------------


def coding_sheet_rows(codes: DataFrame, speeches: DataFrame, day: str, links: DataFrame | None = None) -> DataFrame:
    """codes with date (the speech's, else the day), country (empty if unknown) and link of their speech."""
    known = keep_first(speeches.where(F.col("id_speech") != ""), ["id_speech"], [F.col("position").desc()]).select("id_speech", F.col("date").alias("_date"), F.col("country").alias("_country"))
    out = codes.join(known, "id_speech", "left")
    out = out.withColumn("date", F.coalesce(F.nullif("_date", F.lit("")), F.lit(day))).withColumn("country", F.coalesce("_country", F.lit(""))).drop("_date", "_country")
    if links is not None:
        own = links.groupBy("id_speech").agg(F.max("link").alias("_link"))
        old = F.col("link") if "link" in codes.columns else F.lit(None).cast("string")
        out = out.join(own, "id_speech", "left").withColumn("link", F.coalesce("_link", old)).drop("_link")
    return out


def extract_key(id_speech: Column, indicator: Column, given: Column | None = None) -> Column:
    """The key of a coding row; rows of before have none and get theirs from speech and indicator. Null if either is empty."""
    own = F.when((id_speech != "") & (indicator != ""), F.concat_ws("_", id_speech, indicator))
    return own if given is None else F.coalesce(F.nullif(F.trim(given), F.lit("")), own)


def export_title(rank: Column, title: Column) -> Column:
    """The rank, else the title unless it is a bare style of address."""
    t = F.coalesce(F.trim(title), F.lit(""))
    return F.coalesce(F.nullif(F.trim(rank), F.lit("")), F.when(F.lower(t).isin(BARE_TITLES), "").otherwise(t))


def joined_title(*parts: Column) -> Column:
    """The parts that are not empty, joined by commas."""
    return F.concat_ws(", ", *[F.nullif(p, F.lit("")) for p in parts])


def speaker_lines(roster: DataFrame, leaked: DataFrame, position: str = "position") -> DataFrame:
    """position and line `name | country | title`: leaked names give way to the country, repeated entries and empty ones go, empty ends are cut."""
    low = lambda c: F.lower(F.coalesce(F.trim(c), F.lit("")))
    bad = leaked.select(F.col("name").alias("_low"), F.lit(True).alias("_leaked")).distinct()
    rows = roster.withColumn("_low", low("name")).join(bad, "_low", "left")
    name = F.when(F.col("_leaked"), F.lit("")).otherwise(F.coalesce(F.trim("name"), F.lit("")))
    rows = rows.withColumn("_country", F.coalesce(F.trim("country"), F.lit(""))).withColumn("_name", F.coalesce(F.nullif(name, F.lit("")), F.col("_country"))).where("_name <> ''")
    rows = keep_first(rows, [F.lower("_name"), F.lower("_country")], [F.col(position)])
    line = F.concat_ws(" | ", "_name", "_country", export_title(F.col("rank"), F.col("speaker_title")))
    return rows.select(position, F.regexp_replace(line, r"[ |]+$", "").alias("line"))


# --- summaries ---------------------------------------------------------------------------------------------


def available_days(listed: DataFrame, day: str = "day", position: str = "position") -> DataFrame:
    """day (`?` if empty), speakers and first: days in order of appearance."""
    return listed.groupBy(F.coalesce(F.nullif(day, F.lit("")), F.lit("?")).alias("day")).agg(F.count(F.lit(1)).alias("speakers"), F.min(position).alias("first"))


def outcome(error: Column, skip: Column, has_text: Column, metadata_only: bool = False) -> Column:
    """How an extraction ended: error, skipped, ok or other; without extraction a skip counts only if the speech was there already."""
    skipped = (skip == "already extracted") if metadata_only else (F.coalesce(skip, F.lit("")) != "")
    return F.when(F.coalesce(error, F.lit("")) != "", "error").when(skip == "already extracted", "skipped").when(has_text, "ok").when(skipped, "skipped").otherwise("other")


def extract_summary(items: DataFrame, kind: Column) -> DataFrame:
    k = items.select(kind.alias("k"))
    return k.agg(F.count(F.lit(1)).alias("fetched"), *[F.count_if(F.col("k") == v).alias(n) for v, n in (("ok", "ok"), ("skipped", "skipped"), ("error", "errors"))])


def pending_quotes(quotes: DataFrame, speaker: str = "speaker") -> DataFrame:
    """speaker and number of quotes that wait, of those that have any; unknown speakers have none."""
    return quotes.where((F.coalesce(speaker, F.lit("")) != "") & (F.lower(speaker) != "unknown")).groupBy(speaker).agg(F.count(F.lit(1)).alias("quotes"))


def id_summary(items: DataFrame, by: list[str], number: str = "number") -> DataFrame:
    """Rows, first and last id of each group, as text."""
    t = items.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.min(number).alias("_a"), F.max(number).alias("_b"))
    return t.select(*by, "rows", F.when(F.col("_a") == F.col("_b"), T.format_id("_a")).otherwise(F.concat(T.format_id("_a"), F.lit(".."), T.format_id("_b"))).alias("ids"))


def sample_messages(picks: DataFrame, limit: int = 50) -> DataFrame:
    """day, t and keywords of the first messages: a top-k by day and time."""
    return picks.groupBy("day", "t").agg(F.array_join(F.array_sort(F.collect_set("keyword")), ", ").alias("keywords")).orderBy("day", "t").limit(limit)


def report_lines(days: DataFrame) -> DataFrame:
    """day and a line of the text report from projected days (see alerts.projection)."""
    number = F.coalesce(F.format_string("%.1f", F.col("projected").cast("double")), F.lit("-"))
    line = F.format_string("%s  %d of %d speeches  %d e-mails  projected %s", "day", F.col("analysed").cast("long"), F.col("expected").cast("long"), F.col("emails").cast("long"), number)
    return days.select("day", line.alias("line"))
