"""Joins on likeness (the Ratcliff-Obershelp ratio of the standard library) for tables of any size, and who is meant by a heard name.

A ratio of two texts is twice the letters that they share in the same order over both lengths. So a ratio of at least r needs a common subsequence of
o = r * (a + b) / 2 letters for lengths a and b. Of these the k rarest are among the first a - o + k letters of the one and the first b - o + k of the other,
rare letters first, and stand in the same order in both. Both sides are therefore joined by equality on (a, b, k letters in the text's order); what meets is
bounded by its longest common subsequence and then measured. Nothing is left out, and no text meets every other.
"""

from __future__ import annotations

import math
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType

from ..functions import fuzzy
from ..session import stored

#: Letters from rare to frequent in European languages; any order gives the same pairs. Others are taken as rarer.
_RARE = "qxzjkywvfbgphmcdulotrsnaie "
_LIST = ArrayType(StringType())
#: Keys of a text for one length of the other. More of them are more selective: words meet very many others, names of countries few.
WORD_KEYS, PLACE_KEYS = 512, 32


def word_likeness(least: float) -> float:
    """No name's score reaches `least` unless two of the words are as like as this: all parts of it but the whole names' likeness are
    bounded by the best two words."""
    return (least - 0.15) / 0.85 - 1e-9


WORD_LIKENESS = word_likeness(fuzzy.NAME_THRESHOLD)


def shared_letters(a: int, b: int, least: float) -> int:
    """The letters that texts of these lengths share if their ratio is at least `least`."""
    return math.ceil(least * (a + b) / 2 - 1e-9)


def _key_letters(a: int, b: int, need: int, most: int) -> int:
    """The letters of a key: as many as leave either text about `most` keys."""
    spare, k = max(a, b) - need, 1
    while k < need and math.comb(spare + k + 1, k + 1) <= most:
        k += 1
    return k


def _keys(text: str, lengths: list[int], least: float, most: int, left: bool) -> list[str]:
    """Keys of one side: for every length that the other has, letters in the text's order out of the rarest ones."""
    a, out = len(text), []
    rare = lambda c: (_RARE.find(c), c)
    ordered = sorted(map(rare, text))
    for b in lengths:
        need = shared_letters(a, b, least)
        if 0 < need <= min(a, b):
            k = _key_letters(a, b, need, most)
            # All of the last letter's places, since the other text may share any of them.
            last = ordered[a - need + k - 1]
            both = f"{a}|{b}|" if left else f"{b}|{a}|"
            out += {both + "".join(found) for found in combinations([c for c in text if rare(c) <= last], k)}
    return out


def candidates(left: DataFrame, right: DataFrame, least: float, most: int = WORD_KEYS) -> DataFrame:
    """a, b: the pairs of distinct texts (column t of either side) that share enough letters in order to be as like as `least`."""

    def keyed(side: DataFrame, name: str, other: DataFrame, first: bool) -> DataFrame:
        keys = F.pandas_udf(lambda s, n: pd.Series([_keys(x, y, least, most, first) for x, y in zip(s, n)]), _LIST)
        # Texts take few bytes and make many keys, so they are dealt to all tasks, and adaptive execution may not gather them again.
        many = int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        texts = side.select(F.col("t").alias(name)).where(F.length("t") > 0).repartition(many, name).distinct()
        lengths = F.broadcast(other.agg(F.collect_set(F.length("t")).alias("lengths")))
        held = texts.crossJoin(lengths).select(name, F.explode(keys(name, "lengths")).alias("key"))
        return held.select(name, F.xxhash64("key").alias("key"))

    # A file's size says nothing about its keys: neither side is broadcast.
    met = keyed(left, "a", right, True).join(keyed(right, "b", left, False).hint("merge"), "key").select("a", "b").distinct()
    share = F.pandas_udf(lambda a, b: pd.Series(fuzzy.shared_in_order(a, b) >= (least - 1e-9) * (a.str.len() + b.str.len()) / 2), BooleanType())
    return met.where(share("a", "b"))


def like_pairs(left: DataFrame, right: DataFrame, least: float, most: int = WORD_KEYS) -> DataFrame:
    """a, b, likeness, reverse: the pairs whose ratio, taken as (a, b) or as (b, a), is at least `least`. (The ratio may depend on the order.)"""
    measured = F.pandas_udf(lambda a, b: pd.Series([fuzzy.ratio(x, y) for x, y in zip(a, b)]), DoubleType())
    pairs = candidates(left, right, least, most).select("a", "b", measured("a", "b").alias("likeness"), measured("b", "a").alias("reverse"))
    return pairs.where(F.greatest("likeness", "reverse") >= least)


# --- Names -------------------------------------------------------------------------------------------------

_words = F.pandas_udf(lambda s: s.map(lambda n: list(fuzzy.name_tokens(n or ""))), _LIST)
_name_score = F.pandas_udf(lambda a, b: pd.Series([fuzzy.name_score(x, y) for x, y in zip(a, b)]), DoubleType())
#: Scores down to which names are searched, one after another. A name whose best entry lies a margin above such a score has no rival below it.
LEVELS = tuple(fuzzy.NAME_THRESHOLD + n * fuzzy.NAME_MARGIN for n in (2, 1, 0))


def _each(names: DataFrame, *more: str) -> DataFrame:
    return names.select(*more, F.explode(F.array_distinct("words")).alias("t"))


def _least_two(scored: DataFrame) -> DataFrame:
    """Of each name its best entry (ties: the first) and the second best score."""
    w = Window.partitionBy("name").orderBy(F.col("score").desc(), "position")
    two = scored.withColumn("_n", F.row_number().over(w)).where("_n <= 2")
    first, second = F.col("_n") == 1, (F.col("_n") == 2) | F.col("several")
    return two.groupBy("name").agg(F.max(F.when(first, F.col("position"))).alias("position"), F.max(F.when(first, F.col("score"))).alias("score"), F.max(F.when(second, F.col("score"))).alias("second"))


def _best(said: DataFrame, listed: DataFrame, least: float) -> DataFrame:
    """name, position, score, second: what _least_two finds among the entries whose score is at least `least`."""
    alike = like_pairs(_each(said), _each(listed), word_likeness(least))
    heard_words, listed_words = _each(said, "name").withColumnRenamed("t", "a"), _each(listed, "listed").withColumnRenamed("t", "b").distinct()
    pairs = heard_words.join(alike.select("a", "b").hint("merge"), "a").join(listed_words.hint("merge"), "b").select("name", "listed").distinct()
    scored = pairs.withColumn("score", _name_score("name", "listed")).where(F.col("score") >= least)
    entries = listed.groupBy("listed").agg(F.min("position").alias("position"), (F.count(F.lit(1)) > 1).alias("several"))
    return _least_two(scored.join(entries, "listed"))


def by_name(names: DataFrame, agenda: DataFrame) -> DataFrame:
    """name, position, score: the entry that each distinct name means, as fuzzy.match judges it.

    Names are searched from high scores to low ones, and go on to the next level only while an entry below could still change the answer.
    """
    said = stored(names.select("name", _words("name").alias("words")).where(F.size("words") > 0))
    listed = stored(agenda.select("position", F.col("name").alias("listed"), _words("name").alias("words")).where(F.size("words") > 0))
    rest, best = said, None
    for least in LEVELS:
        found = stored(_best(rest, listed, least))
        # Scores are sums of floats: what lies within a hair of the margin is searched again below.
        known = found if least == LEVELS[-1] else found.where(F.col("second").isNotNull() | (F.col("score") > least + fuzzy.NAME_MARGIN + 1e-6))
        best = known if best is None else best.unionByName(known)
        rest = rest.join(known.select("name"), "name", "left_anti")
        if rest.isEmpty():
            break
    clear = F.col("second").isNull() | (F.col("second") < fuzzy.NAME_THRESHOLD) | (F.col("score") - F.col("second") >= fuzzy.NAME_MARGIN)
    sure = best.where(clear).select("name", "position", "score")
    # Others by surname: the only entry whose surname is very like a word that was said.
    long = F.length("t") >= 5
    spoken = _each(said.join(sure.select("name"), "name", "left_anti"), "name").where(long)
    surnames = listed.select("position", "listed", F.element_at("words", -1).alias("t")).where(long)
    surnames = surnames.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("position"), F.min("listed").alias("listed"))
    near = like_pairs(spoken, surnames, fuzzy.SURNAME_THRESHOLD).where(F.col("likeness") >= fuzzy.SURNAME_THRESHOLD).select("a", "b")
    one = spoken.withColumnRenamed("t", "a").join(near, "a").select("name", "b").distinct().join(surnames.withColumnRenamed("t", "b"), "b")
    one = one.groupBy("name").agg(F.sum("n").alias("n"), F.min("position").alias("position"), F.min("listed").alias("listed")).where("n = 1")
    return sure.unionByName(one.select("name", "position", _name_score("name", "listed").alias("score")))


# --- Countries ---------------------------------------------------------------------------------------------

_country_keys = F.pandas_udf(lambda s: s.map(lambda c: sorted(fuzzy.country_keys(c or ""))), _LIST)
_country_score = F.pandas_udf(lambda a, b: pd.Series([fuzzy.country_score(x, y) for x, y in zip(a, b)]), DoubleType())
_role = F.pandas_udf(lambda s: s.map(lambda t: fuzzy.role(t)), StringType())


def _alike_countries(places: DataFrame, countries: DataFrame) -> DataFrame:
    """place, country: for each place the countries of the highest score, if that is high enough."""
    x = places.select("place", F.explode(_country_keys("place")).alias("a"))
    y = countries.select("country", F.explode(_country_keys("country")).alias("b"))
    like = like_pairs(x.select(F.col("a").alias("t")), y.select(F.col("b").alias("t")), fuzzy.COUNTRY_THRESHOLD, PLACE_KEYS).select("a", "b")
    pairs = x.join(like, "a").join(y, "b").select("place", "country").distinct()
    scored = pairs.withColumn("score", _country_score("place", "country")).where(F.col("score") >= fuzzy.COUNTRY_THRESHOLD)
    top = scored.groupBy("place").agg(F.max("score").alias("top"))
    return scored.join(top, "place").where(F.col("score") >= F.col("top") - 1e-9).select("place", "country")


def by_country(asked: DataFrame, agenda: DataFrame) -> DataFrame:
    """place, title, position: the only entry of the countries most like the place; of several, the only one of the title's role.

    Entries are counted by country and role before they meet a place, so a country with very many is one row for each role.
    """
    listed = agenda.where(F.coalesce(F.col("country"), F.lit("")) != "")
    held = listed.select("position", "country", F.array_distinct(F.array(_role(F.concat_ws(" ", "title", "country")), _role(F.coalesce("title", F.lit(""))))).alias("roles"))
    alike = _alike_countries(asked.select("place").distinct(), listed.select("country").distinct())
    count = [F.count(F.lit(1)).alias("n"), F.min("position").alias("position")]
    total = [F.sum("n").alias("n"), F.min("position").alias("position")]
    every = alike.join(held.groupBy("country").agg(*count), "country").groupBy("place").agg(*total)
    roles = held.select("position", "country", F.explode("roles").alias("role")).where("role <> ''")
    of_role = alike.join(roles.groupBy("country", "role").agg(*count), "country").groupBy("place", "role").agg(*total)
    both = asked.withColumn("role", _role("title")).join(every, "place").join(of_role.toDF("place", "role", "n_role", "position_role"), ["place", "role"], "left")
    chosen = F.when(F.col("n") == 1, F.col("position")).when(F.col("n_role") == 1, F.col("position_role"))
    return both.select("place", "title", chosen.alias("position")).where(F.col("position").isNotNull())


# --- Who is meant ------------------------------------------------------------------------------------------


def match_roster(heard: DataFrame, agenda: DataFrame) -> DataFrame:
    """heard (name, title, country, ...) with the position and found_by of the agenda entry (position, name, country, title) that is meant.

    The same as fuzzy.match for each row over the whole agenda, whatever its size. Nulls count as empty texts; positions are distinct.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    listed = agenda.select("position", *[text(c).alias(c) for c in ("name", "country", "title")])
    name, country, title = (F.regexp_replace(text(c), r"^\s+|\s+$", "") for c in ("name", "country", "title"))
    place = F.when(country != "", country).otherwise(_of_title(title))
    forms = heard.select("name", "title", "country").distinct().withColumns({"_name": F.when(F.lower(name).isin("", "unknown"), "").otherwise(name), "_title": text("title"), "_place": place})
    named = by_name(forms.select(F.col("_name").alias("name")).where("_name <> ''").distinct(), listed).select(F.col("name").alias("_name"), F.col("position").alias("_by_name"), "score")
    placed = by_country(forms.select(F.col("_place").alias("place"), F.col("_title").alias("title")).where("_place <> ''").distinct(), listed)
    placed = placed.select(F.col("place").alias("_place"), F.col("title").alias("_title"), F.col("position").alias("_by_country"))
    folded = listed.select("position", fuzzy.fold_name("name").alias("folded"))
    found = forms.join(named, "_name", "left").join(placed, ["_place", "_title"], "left")
    found = found.join(folded.toDF("_by_name", "_one"), "_by_name", "left").join(folded.toDF("_by_country", "_other"), "_by_country", "left")
    keep = F.col("_by_name").isNotNull() & (F.col("_by_country").isNull() | (F.col("_one") == F.col("_other")) | (F.col("score") >= fuzzy.TRUSTED_NAME))
    by = F.when(keep, "name").when(F.col("_by_country").isNotNull(), "country")
    found = found.select(*[F.col(c).alias(f"_k_{c}") for c in ("name", "title", "country")], F.when(keep, F.col("_by_name")).otherwise(F.col("_by_country")).alias("position"), by.alias("found_by"))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in ("name", "title", "country")]
    return heard.join(found, same[0] & same[1] & same[2], "left").drop("_k_name", "_k_title", "_k_country")


def _of_title(title: Column) -> Column:
    of = F.pandas_udf(lambda s: s.map(fuzzy.country_of_title), StringType())
    return of(title)
