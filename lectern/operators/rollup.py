"""Progress by day, session payloads, alert dashboards and usage totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Day states.
DONE, RUNNING, ROSTER_ONLY, FAILED = "completo", "en_progreso", "solo_roster", "con_errores"
WITH_HITS, WITHOUT_HITS = "con_hits", "sin_hits"


def day_status(speakers: Column, speeches: Column, analyses: Column, errors: Column) -> Column:
    return (
        F.when(errors > 0, FAILED).when((speakers == 0) | (speeches == 0), ROSTER_ONLY).when((speeches >= speakers) & (analyses >= speakers), DONE).otherwise(RUNNING)
    )


def progress(roster: DataFrame, texts: DataFrame, coded: DataFrame) -> DataFrame:
    """One row for each roster entry: speech and analysis state. Keys are unique on the right, so the joins keep roster rows."""
    r = roster.join(texts.select("slug", F.lit(True).alias("has_text")).distinct(), "slug", "left").join(coded.select("slug", F.lit(True).alias("has_codes")).distinct(), "slug", "left")
    speech = F.when(F.col("has_text"), "ok").when(F.col("error") & ~F.col("has_source"), "error").otherwise("pending")
    return r.withColumn("speech", speech).withColumn("analysis", F.when(F.coalesce("has_codes", F.lit(False)), "ok").otherwise("pending")).drop("has_text", "has_codes")


def progress_by_day(entries: DataFrame) -> DataFrame:
    d = entries.groupBy("day").agg(
        F.count(F.lit(1)).alias("speakers"),
        F.count_if(F.col("speech") == "ok").alias("speeches"),
        F.count_if(F.col("analysis") == "ok").alias("analyses"),
        F.count_if(F.col("error") | (F.col("speech") == "error")).alias("errors"),
    )
    return d.withColumn("status", day_status(F.col("speakers"), F.col("speeches"), F.col("analyses"), F.col("errors")))


def session_payload(days: DataFrame, by: str = "session") -> DataFrame:
    """All days of a session in one array, newest first."""
    body = F.sort_array(F.collect_list(F.struct(*[c for c in days.columns if c != by])), asc=False)
    return days.groupBy(by).agg(F.to_json(body).alias("payload"))


def alert_days(speakers: DataFrame, hits: DataFrame) -> DataFrame:
    """day, speakers, with_hits, hits and status; hits of unknown speakers count as speakers of their own."""
    h = hits.groupBy("day", "speaker").agg(F.count(F.lit(1)).alias("n"))
    both = speakers.select("day", "speaker").distinct().withColumn("listed", F.lit(1)).join(h, ["day", "speaker"], "full")
    d = both.groupBy("day").agg(F.count(F.lit(1)).alias("speakers"), F.count_if(F.col("n") > 0).alias("with_hits"), F.coalesce(F.sum("n"), F.lit(0)).alias("hits"))
    return d.withColumn("status", F.when(F.col("hits") > 0, WITH_HITS).otherwise(WITHOUT_HITS))


#: USD for a million tokens.
INPUT, OUTPUT, CACHE_READ, WRITE_SHORT, WRITE_LONG = 1.0, 5.0, 0.10, 1.25, 2.0


def usage(calls: DataFrame, by: list[str]) -> DataFrame:
    """Totals of the token counters and their cost; cache writes of unknown duration cost as short ones."""
    names = ["input_tokens", "output_tokens", "cache_read", "cache_write", "write_5m", "write_1h"]
    t = calls.groupBy(*by).agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("cache_read") > 0).alias("cache_hits"), *[F.sum(n).cast("long").alias(n) for n in names])
    rest = F.greatest(F.col("cache_write") - F.col("write_5m") - F.col("write_1h"), F.lit(0))
    cost = F.col("input_tokens") * INPUT + F.col("output_tokens") * OUTPUT + F.col("cache_read") * CACHE_READ + (F.col("write_5m") + rest) * WRITE_SHORT + F.col("write_1h") * WRITE_LONG
    return t.withColumn("cost", F.round(cost / 1_000_000, 6))
