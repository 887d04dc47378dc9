"""Alert messages, saved-speech selection, ordered unions and retagging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.clock import in_zone
from .dims import contained


def first_seen(values: Column) -> Column:
    """Distinct values in order of appearance."""
    return F.array_distinct(values)


def messages(events: DataFrame, key: list[str]) -> DataFrame:
    """subject and body of one message for each key from its events (t, keyword, speaker, context), in order of (t, keyword)."""
    m = events.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("t", F.lower("keyword").alias("k"), "keyword", "speaker", "context"))).alias("e"))
    words = first_seen(F.transform("e", lambda x: x["keyword"]))
    speakers = first_seen(F.filter(F.transform("e", lambda x: x["speaker"]), lambda x: x != ""))
    line = lambda x: F.concat(T.timecode(x["t"]), F.lit("  "), x["keyword"], F.lit(": "), x["context"])
    subject = F.concat(F.array_join(words, ", "), F.when(F.size(speakers) > 0, F.concat(F.lit(" - "), F.array_join(speakers, ", "))).otherwise(""))
    return m.select(*key, subject.alias("subject"), F.array_join(F.transform("e", line), "\n").alias("body"), F.size("e").alias("events"))


def own_keywords(keywords: Column) -> Column:
    """A pattern for any of a row's keywords, longest first."""
    words = F.array_sort(keywords, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).otherwise(F.when(a < b, -1).when(a > b, 1).otherwise(0)))
    quoted = F.transform(words, lambda k: F.array_join(F.transform(F.split(T.squeeze(k), " "), lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E"))), r"\s+"))
    return F.concat(F.lit(r"(?iU)\b("), F.array_join(quoted, "|"), F.lit(r")\b"))


def alert_emails(events: DataFrame, key: list[str], order: str) -> DataFrame:
    """subject, text and html of one e-mail for each key.

    events: keyword, speaker, speaker_title, timestamp, transcript, mail_context and watch_url. Keywords, speakers (without unknown ones) and titles are
    listed as they appear; moment, passage (the mail's context, else the window) and link are those of the first event.
    """
    fields = ["keyword", "speaker", "speaker_title", "timestamp", "transcript", "mail_context", "watch_url"]
    m = events.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(order, *fields))).alias("e"))
    listed = lambda name, keep: first_seen(F.filter(F.transform("e", lambda x: x[name]), keep))
    some = lambda x: F.coalesce(x, F.lit("")) != ""
    first = F.get("e", F.lit(0))
    context = F.nullif(first["mail_context"], F.lit(""))
    moment = lambda zone: in_zone(first["timestamp"], zone)
    m = m.select(
        *key, listed("keyword", some).alias("k"), listed("speaker", lambda x: some(x) & (x != "unknown")).alias("s"), listed("speaker_title", some).alias("t"),
        moment("UTC").alias("utc"), moment("America/New_York").alias("ny"), moment("Europe/Madrid").alias("madrid"), F.nullif(first["watch_url"], F.lit("")).alias("url"),
        F.coalesce(context, first["transcript"], F.lit("")).alias("passage"), F.when(context.isNotNull(), "Context").otherwise("Chunk").alias("label"),
    )
    words, speakers, titles = (F.array_join(c, ", ") for c in ("k", "s", "t"))
    spoken, titled = F.size("s") > 0, (F.size("s") > 0) & (F.size("t") > 0)
    mark = lambda c, before, after: F.regexp_replace(c, own_keywords(F.col("k")), F.lit(f"{before}$1{after}"))
    lines = [("Keyword(s)", words, None), ("When", F.col("utc"), None), ("New York", F.col("ny"), None), ("Madrid", F.col("madrid"), None), ("YouTube", F.col("url"), F.col("url").isNotNull()), ("Speaker", speakers, spoken), ("Title", titles, titled)]
    line = lambda name, value, there: F.concat(F.lit(f"{name}: "), value) if there is None else F.when(there, F.concat(F.lit(f"{name}: "), value))
    text = F.concat(F.concat_ws("\n", *[line(*x) for x in lines]), F.lit("\n\n"), F.col("label"), F.lit(":\n"), mark(F.col("passage"), "**", "**"))
    row = lambda name, value: F.concat(F.lit(f"<b>{name}:</b> "), T.html_escape(value))
    block = lambda there, *parts: F.when(there, F.concat(F.lit("<p>"), *parts, F.lit("</p>"))).otherwise("")
    html = F.concat(
        F.lit('<div style="font-family:sans-serif;max-width:40em;line-height:1.45">'), block(F.lit(True), row("Keyword(s)", words)),
        block(F.lit(True), row("When", F.col("utc")), F.lit("<br>"), row("New York", F.col("ny")), F.lit("<br>"), row("Madrid", F.col("madrid"))),
        F.coalesce(block(F.col("url").isNotNull(), F.lit('<b>YouTube:</b> <a href="'), T.html_escape("url"), F.lit('">'), T.html_escape("url"), F.lit("</a>")), F.lit("")),
        block(spoken, row("Speaker", speakers)), block(titled, row("Title", titles)), F.lit("<p><b>"), F.col("label"), F.lit(":</b></p>"),
        F.lit('<blockquote style="margin:0;border-left:3px solid #222;padding:0.4em 0.8em">'), mark(T.html_escape("passage"), "<strong>", "</strong>"), F.lit("</blockquote></div>"),
    )
    subject = F.concat_ws(" | ", F.lit("KEYWORD_DETECTED"), words, F.when(spoken, speakers))
    return m.select(*key, subject.alias("subject"), text.alias("text"), html.alias("html"))


def select_saved(saved: DataFrame, wanted: DataFrame, name: str = "name", country: str = "country") -> DataFrame:
    """wanted (wish) with what it selects: equal names, else names that contain it, else the country; state ok, ambiguous or missing."""
    fold = lambda c: F.trim(F.lower(c))
    w = wanted.select("wish").distinct().withColumn("_wish", fold(F.col("wish")))
    s = saved.select(name, F.col(country).alias("_country"), fold(F.col(name)).alias("_name"))
    # Saved names are counted before they meet a wish, so that one that selects very many makes no row for each of them.
    counted = [F.count(F.lit(1)).alias("n"), F.min(name).alias("found")]
    by_name = s.groupBy("_name").agg(*counted)
    total = [F.sum("n").alias("n"), F.min("found").alias("found")]
    equal = w.join(by_name.hint("merge"), F.col("_name") == F.col("_wish")).select("wish", "n", "found")
    rest = w.join(equal.select("wish").hint("merge"), "wish", "left_anti")
    part = contained(rest, "_wish", s, "_name").join(by_name.hint("merge"), "_name").groupBy("_wish").agg(*total)
    part = rest.join(part.hint("merge"), "_wish").select("wish", "n", "found")
    rest = rest.join(part.select("wish").hint("merge"), "wish", "left_anti").withColumn("_slug", T.ascii_slug("wish"))
    by_country = s.groupBy(T.ascii_slug("_country").alias("_slug")).agg(*counted)
    place = rest.join(by_country.hint("merge"), "_slug").select("wish", "n", "found")
    hits = equal.unionByName(part).unionByName(place)
    state = F.when(F.col("n").isNull(), "missing").when(F.col("n") == 1, "ok").otherwise("ambiguous")
    return w.join(hits.hint("merge"), "wish", "left").select("wish", state.alias("state"), F.when(F.col("n") == 1, F.col("found")).alias("found"))


def ordered_union(existing: DataFrame, listed: DataFrame, key: str, position: str) -> DataFrame:
    """existing in its order, then the keys of listed that it lacks, in theirs."""
    end = existing.agg(F.coalesce(F.max(position) + 1, F.lit(0)).alias("_end"))
    more = listed.groupBy(key).agg(F.min(position).alias(position)).join(existing.select(key), key, "left_anti")
    more = more.crossJoin(F.broadcast(end)).select(key, (F.col(position) + F.col("_end")).alias(position))
    return existing.groupBy(key).agg(F.min(position).alias(position)).unionByName(more)


def overlay(pages: DataFrame, listing: DataFrame, key: str = "slug") -> DataFrame:
    """Listing names replace page names; countries only where the page has a generic one."""
    l = listing.select(key, F.col("name").alias("_n"), F.col("country").alias("_c"))
    generic = F.lower(F.trim("country")).isin("", "unknown", "general debate")
    j = pages.join(l, key, "left")
    j = j.withColumn("name", F.coalesce(F.nullif("_n", F.lit("")), "name")).withColumn("country", F.when(generic, F.coalesce("_c", "country")).otherwise(F.col("country")))
    return j.drop("_n", "_c")
