"""Corrections of journals after the event: fixed speakers, speeches cut in two, quotes put back.

Nothing is changed in place: each function gives the rows as they should be, or what would change; a day's partition is then
overwritten (sources.sinks.write_days).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import keep_first
from .sequence import first_interval, totals_inside


def fixed_events(events: DataFrame, fixes: DataFrame, event_id: str, time: str = "timestamp") -> DataFrame:
    """events with speaker and speaker_title of the first fix (start, end, name, title, position) that covers their time, old_speaker and changed.

    A fix without a title leaves the title. Events that say so already are not changed.
    """
    hit = first_interval(events, fixes.select("start", "end", "position", F.col("name").alias("_name"), F.coalesce("title", F.lit("")).alias("_title")), time, "start", "end", "position", ["_name", "_title"], event_id)
    old = F.coalesce("speaker", F.lit(""))
    same_title = (F.col("_title") == "") | F.col("speaker_title").eqNullSafe(F.col("_title"))
    change = F.col("_name").isNotNull() & ~((old == F.col("_name")) & same_title)
    out = hit.withColumn("changed", change).withColumn("old_speaker", old)
    out = out.withColumn("speaker_title", F.when(change & (F.col("_title") != ""), F.col("_title")).otherwise(F.col("speaker_title")))
    return out.withColumn("speaker", F.when(change, F.col("_name")).otherwise(F.col("speaker"))).drop("_name", "_title")


def inside_fixes(events: DataFrame, fixes: DataFrame, time: str = "timestamp", width_seconds: int = 3600) -> DataFrame:
    """events with the position of every fix that covers their time: a row for each such pair. Intervals meet events in time buckets."""
    bucket = lambda c: F.floor(F.unix_timestamp(c) / width_seconds)
    f = fixes.select("position", F.col("start").alias("_start"), F.col("end").alias("_end"), F.explode(F.sequence(bucket("start"), bucket("end"))).alias("_bucket"))
    both = events.withColumn("_bucket", bucket(time)).join(f, "_bucket").where((F.col(time) >= F.col("_start")) & (F.col(time) < F.col("_end")))
    return both.drop("_bucket", "_start", "_end")


def changes_by_fix(changes: DataFrame, fixes: DataFrame, time: str = "timestamp") -> DataFrame:
    """position and number of changes that each fix covers; overlapping fixes all count them, fixes without any have 0."""
    n = totals_inside(changes, fixes, time, "start", "end", "position").select("position", F.col("points").alias("_n"))
    return fixes.join(n.hint("merge"), "position", "left").select("position", F.coalesce("_n", F.lit(0)).alias("changes"))


def split_rows(rows: DataFrame, cuts: list[tuple[float, str, str, str]], source: str, seconds: str = "seconds", movable: Column | None = None) -> DataFrame:
    """rows of a speech (quotes or lines) with owner, owner_country and owner_title: to whom the last cut at or before their time gives them.

    cuts: (start, name, country, title), a handful from the command line. Rows before the first cut, without a time, of a cut that
    names the source itself, or not movable stay with the source.
    """
    ordered = sorted(cuts, key=lambda c: c[0])
    owner = F.struct(F.lit(source).alias("name"), F.lit("").alias("country"), F.lit("").alias("title"))
    found = owner
    for start, name, country, title in ordered:
        other = owner if name.casefold() == source.casefold() else F.struct(F.lit(name).alias("name"), F.lit(country or "").alias("country"), F.lit(title or "").alias("title"))
        found = F.when(F.col(seconds) >= start, other).otherwise(found)
    if movable is not None:
        found = F.when(movable, found).otherwise(owner)
    return rows.withColumn("_o", found).select(*rows.columns, F.col("_o.name").alias("owner"), F.col("_o.country").alias("owner_country"), F.col("_o.title").alias("owner_title"))


def retagged(rows: DataFrame, source: str) -> DataFrame:
    """Split rows as rows of their owner: speaker is the owner, speaker_title its title and country; rows of the source stay as they are."""
    moved = F.lower("owner") != source.lower()
    title = F.concat_ws(", ", F.nullif("owner_title", F.lit("")), F.nullif("owner_country", F.lit("")))
    out = rows.withColumn("speaker", F.when(moved, F.col("owner")).otherwise(F.col("speaker"))).withColumn("speaker_title", F.when(moved, F.nullif(title, F.lit(""))).otherwise(F.col("speaker_title")))
    return out.drop("owner", "owner_country", "owner_title")


def split_plan(rows: DataFrame) -> DataFrame:
    """owner, rows and first and last second of what a split would give each (a dry run)."""
    return rows.groupBy("owner").agg(F.count(F.lit(1)).alias("rows"), F.min("seconds").alias("first"), F.max("seconds").alias("last"))


def quotes_put_back(stored: DataFrame, returned: DataFrame, position: str = "position") -> DataFrame:
    """speaker, place and quote of a store to which unsent quotes return: before those that came meanwhile, all kept."""
    both = returned.select("speaker", position, "quote").withColumn("_late", F.lit(0)).unionByName(stored.select("speaker", position, "quote").withColumn("_late", F.lit(1)))
    w = Window.partitionBy(F.lower("speaker")).orderBy("_late", position)  # what waits for one speaker
    return both.select("speaker", F.row_number().over(w).alias("place"), "quote")


def lines_put_back(stored: DataFrame, returned: DataFrame, key: list[str], position: str = "position") -> DataFrame:
    """Lines likewise: the returned ones first, all of them, then those of the store that are not among them."""
    low = F.lower("speaker")
    there = returned.select(low.alias("_speaker"), *[F.col(k).alias(f"_{k}") for k in key]).distinct()
    on = low == F.col("_speaker")
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    rest = stored.join(there, on, "left_anti")
    both = returned.withColumn("_late", F.lit(0)).unionByName(rest.withColumn("_late", F.lit(1)))
    w = Window.partitionBy(low).orderBy("_late", position)
    return both.select("speaker", *key, F.row_number().over(w).alias("place"))


def meta_put_back(stored: DataFrame, returned: DataFrame) -> DataFrame:
    """speaker, country and title: what the store lacks comes from what returns; speakers that are in neither are new."""
    filled = lambda a, b: F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))
    a, b = stored.withColumn("_k", F.lower("speaker")).alias("a"), returned.withColumn("_k", F.lower("speaker")).alias("b")
    return a.join(b, F.col("a._k") == F.col("b._k"), "full").select(F.coalesce("a.speaker", "b.speaker").alias("speaker"), *[filled(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in ("country", "title")])


def introductions(lines: DataFrame, cue: str, thanks: str, text: str = "text") -> DataFrame:
    """The lines in which a chair introduces or thanks somebody (patterns of streaming.speaker)."""
    return lines.where(F.col(text).rlike(cue) | F.col(text).rlike(thanks))


def taken(speeches: DataFrame, state: DataFrame, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """(taken, left) of saved speeches: those that a selection (mail.select_saved) found alone leave the store."""
    alone = state.where("state = 'ok'").select(F.col("found").alias(name)).distinct()
    return keep_first(speeches.join(alone, name, "left_semi"), [name], [F.col(name)]), speeches.join(alone, name, "left_anti")
