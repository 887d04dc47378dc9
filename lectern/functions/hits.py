"""Keyword hits with their place, segment and surroundings, as column expressions in the JVM.

A pattern's matches have no offsets in SQL. So a text is split at the pattern and its matches are extracted: the lengths of
what stands before each match add up to its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

SPAN = "array<struct<start:int,end:int,hit:string>>"


def occurrences(c, pattern: str) -> Column:
    """array of struct start, end, hit: the matches of a pattern from left to right, in characters."""
    hits = F.regexp_extract_all(T.col(c), F.lit(pattern), F.lit(0))
    gaps = F.split(T.col(c), pattern, -1)
    start = lambda acc, h, g: acc["at"] + F.length(g)
    step = lambda acc, x: F.struct(
        (start(acc, x["h"], x["g"]) + F.length(x["h"])).alias("at"),
        F.concat(acc["found"], F.array(F.struct(start(acc, x["h"], x["g"]).alias("start"), (start(acc, x["h"], x["g"]) + F.length(x["h"])).alias("end"), x["h"].alias("hit")))).alias("found"),
    )
    pairs = F.arrays_zip(hits.alias("h"), F.slice(gaps, F.lit(1), F.size(hits)).alias("g"))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found")), step, lambda acc: acc["found"])


def joined_segments(segments: Column) -> Column:
    """struct text, spans: the segments' squeezed texts joined by spaces, and from, to and start of each that is not empty.

    segments: array of struct start (seconds), end, text.
    """
    pieces = F.filter(F.transform(segments, lambda x: F.struct(x["start"].cast("double").alias("start"), T.squeeze(x["text"]).alias("text"))), lambda x: x["text"] != "")
    begin = F.struct(F.lit(-1).alias("at"), F.array().cast("array<struct<from:int,to:int,start:double>>").alias("spans"))
    step = lambda a, x: F.struct(
        (a["at"] + 1 + F.length(x["text"])).alias("at"),
        F.concat(a["spans"], F.array(F.struct((a["at"] + 1).alias("from"), (a["at"] + 1 + F.length(x["text"])).alias("to"), x["start"].alias("start")))).alias("spans"),
    )
    return F.struct(F.array_join(F.transform(pieces, lambda x: x["text"]), " ").alias("text"), F.aggregate(pieces, begin, step, lambda a: a["spans"]).alias("spans"))


def segment_at(spans: Column, at: Column) -> Column:
    """The span that holds a character; behind the last one that one, else the first. Null without spans."""
    inside = F.get(F.filter(spans, lambda s: (s["from"] <= at) & (at < s["to"])), F.lit(0))
    last = F.get(spans, F.size(spans) - 1)
    return F.coalesce(inside, F.when(at >= last["to"], last), F.get(spans, F.lit(0)))


def keyword_hits(df: DataFrame, text: str, keywords: list[str], context: int, spans: str | None = None, window_start: Column | None = None) -> DataFrame:
    """df with one row for each hit: keyword, start, end, hit, context and seconds; in keyword order, then by place.

    text is squeezed white space already (see joined_segments). seconds: the window's start plus that of the hit's segment; the
    window's start alone without segments.
    """
    tagged = lambda i, k: lambda x: F.struct(F.lit(i).alias("keyword_no"), F.lit(k).alias("keyword"), x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit"))
    found = [F.transform(occurrences(text, T.keyword_pattern(k)), tagged(i, k)) for i, k in enumerate(keywords)]
    rows = df.where(F.col(text).rlike(T.any_keyword(keywords))).select("*", F.inline(F.concat(*found)))
    c = F.col(text)
    before, after = T.words(F.left(c, F.col("start"))), T.words(F.substring(c, F.col("end") + 1, F.length(c)))
    rows = rows.withColumn("context", T.snippet(before, F.col("hit"), after, context))
    base = F.lit(None).cast("double") if window_start is None else window_start.cast("double")
    inside = F.lit(0.0) if spans is None else F.coalesce(segment_at(F.col(spans), F.col("start"))["start"], F.lit(0.0))
    return rows.withColumn("seconds", base + inside)


def window_lines(segments: Column, window_start: Column) -> Column:
    """The segments with times of the stream instead of the window's; none ends before it begins, empty ones go."""
    shifted = F.transform(segments, lambda x: F.struct((x["start"] + window_start).cast("double").alias("start"), (F.greatest(x["end"], x["start"]) + window_start).cast("double").alias("end"), T.squeeze(x["text"]).alias("text")))
    return F.filter(shifted, lambda x: x["text"] != "")
