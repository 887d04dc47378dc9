"""Speaker level, pronouns, language labels, protocol people and the metadata table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: What titles say about the level, in the order in which it is decided.
LEVELS = [
    ("PGA", r"(?i)president of the general assembly"),
    ("SG", r"(?i)secretary[- ]general"),
    ("HS", r"(?i)\b(?:king|queen|emir|sultan|prince|monarch|head of state)\b|(?<!vice[- ])\bpresident\b"),
    ("HG", r"(?i)\b(?:prime minister|head of government|chancellor|premier|taoiseach)\b"),
    ("CD", r"(?i)\b(?:minister|secretary|ambassador|permanent representative|chair|delegation|vice[- ]president)\b"),
]
#: Labels of language codes.
LANGUAGES = {"en": "English", "fr": "French", "es": "Spanish", "de": "German", "ar": "Arabic", "zh": "Chinese", "ru": "Russian", "pt": "Portuguese", "it": "Italian"}


def level(title: Column, slug: Column | None = None, known: dict[str, str] | None = None) -> Column:
    """HS, HG and so on from a slug table or the title; empty if nothing fits."""
    out = F.lit("")
    for name, pattern in reversed(LEVELS):
        out = F.when(title.rlike(pattern), name).otherwise(out)
    if known and slug is not None:
        out = F.coalesce(F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[slug], out)
    return out


def gender(title: Column) -> Column:
    """she/her titles are looked for first."""
    return F.when(title.rlike(r"(?i)\b(?:her|mrs|ms|madam|queen|princess)\b"), "F").when(title.rlike(r"(?i)\b(?:his|mr|sir|king|prince|emir|sultan)\b"), "M").otherwise("")


def pronouns(g: Column) -> Column:
    return F.when(g == "F", "she/her").when(g == "M", "he/him").otherwise("")


def language_label(code: Column) -> Column:
    """The label of a code; a name that is longer than a code stays as it is; other codes have none."""
    labels = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    return F.coalesce(labels[F.lower(code)], F.when(F.length(code) > 3, code), F.lit(""))


#: Token sets of up to this size are looked up by their subsets (255 at most), larger ones by single tokens.
SUBSETS = 8


def _subsets(tokens: Column) -> Column:
    """Every subset but the empty one of a sorted token set, as a text."""
    chosen = lambda m: F.array_join(F.filter(tokens, lambda x, i: m.bitwiseAND(F.pow(F.lit(2), i).cast("int")) != 0), " ")
    return F.transform(F.sequence(F.lit(1), F.pow(F.lit(2), F.size(tokens)).cast("int") - 1), chosen)


def _by_tokens(names: DataFrame, people: DataFrame, key: str, least: float) -> DataFrame:
    """key, _a and _best (score, first): for each token set _a of names the best share among people (_b, _first) of its key, the first of the best.

    A person whose tokens hold a subset of the name's shares at least that, and just that for the largest one. So the first person of each subset and
    size is enough, and no name meets all people with a frequent token. Where either set is large, they meet by single tokens.
    """
    few = lambda c: F.size(c) <= SUBSETS
    share = lambda n: n / F.least(F.size("_a"), F.col("_size"))
    some = names.where(F.size("_a") > 0)
    said = some.where(few("_a")).select(key, "_a", F.explode(_subsets(F.col("_a"))).alias("_s"))
    held = people.where(few("_b")).select(key, F.size("_b").alias("_size"), "_first", F.explode(_subsets(F.col("_b"))).alias("_s"))
    held = held.groupBy(key, "_s", "_size").agg(F.min("_first").alias("_first"))
    found = said.join(held.hint("merge"), [key, "_s"]).select(key, "_a", share(F.size(F.split("_s", " "))).alias("_score"), "_first")
    x, y = some.select(key, "_a", F.explode("_a").alias("_s")), people.select(key, "_b", "_first", F.explode("_b").alias("_s"))
    met = [x.where(~few("_a")).join(y.hint("merge"), [key, "_s"]), x.where(few("_a")).join(y.where(~few("_b")).hint("merge"), [key, "_s"])]
    counted = met[0].unionByName(met[1]).groupBy(key, "_a", "_b", "_first").agg(F.count(F.lit(1)).alias("_n"))
    found = found.unionByName(counted.withColumn("_size", F.size("_b")).select(key, "_a", share(F.col("_n")).alias("_score"), "_first"))
    best = F.min(F.struct((-F.col("_score")).alias("score"), F.col("_first").alias("first")))
    return found.where(F.col("_score") >= least).groupBy(key, "_a").agg(best.alias("_best"))


def protocol_match(speeches: DataFrame, people: DataFrame, key: str, least: float = 0.5) -> DataFrame:
    """speeches with person, gender and honorific of the protocol person of the same country key.

    Best share of common name tokens (at least `least`, which is above 0; the first of the best), else the last person of the speech's level. Distinct token
    sets and levels meet, not speeches and people.
    """
    if least <= 0:
        raise ValueError("a share above 0")
    tokens = lambda c: F.array_sort(F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: x != "")))
    fields = ["person", "gender", "honorific"]
    first = F.min(F.struct("position", *fields)).alias("_first")
    sets = people.select(key, "position", *fields, tokens(F.col("person")).alias("_b")).where(F.size("_b") > 0).groupBy(key, "_b").agg(first)
    rows = speeches.withColumn("_a", tokens(F.col("name")))
    by_name = _by_tokens(rows.select(key, "_a").distinct(), sets, key, least).select(key, "_a", F.col("_best.first").alias("_b"))
    by_level = people.groupBy(key, "level").agg(F.max_by(F.struct(*fields), "position").alias("_l"))
    out = rows.join(by_name, [key, "_a"], "left").join(by_level, [key, "level"], "left")
    return out.select(*speeches.columns, *[F.when(F.col("_b").isNotNull(), F.col(f"_b.{f}")).otherwise(F.col(f"_l.{f}")).alias(f) for f in fields])


def metadata_rows(speeches: DataFrame, order: list) -> DataFrame:
    """The output table: labels, dates as dd/mm/yyyy, level, gender, and the place of each speech in its day (days are small groups)."""
    g = gender(F.col("title"))
    return speeches.select(
        "speech_id",
        F.row_number().over(Window.partitionBy("day").orderBy(*order)).alias("num_of_appearance"),
        T.day_month_year("day").alias("date"),
        F.concat_ws("\n", F.nullif("name", F.lit("")), F.nullif("title", F.lit(""))).alias("speaker"),
        level(F.col("title")).alias("level"),
        g.alias("gender"),
        pronouns(g).alias("pronouns"),
        language_label(F.col("language")).alias("original language"),
    )
