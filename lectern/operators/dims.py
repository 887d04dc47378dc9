"""Dimension look-ups with ordered candidate keys, leaked names, best matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import keep_first


def fallback_lookup(facts: DataFrame, fact_id: str, candidates: list[Column], dim: DataFrame, dim_keys: list[Column], dim_order: str, values: list[str]) -> DataFrame:
    """facts with the values of the first candidate key that the dimension knows.

    A dimension row answers to all its keys; of rows with one key the first counts. Both sides are exploded to single keys,
    joined by equality, and the least candidate position wins: no condition joins, no look-up loops.
    """
    every = F.posexplode(F.array(*dim_keys)).alias("_kp", "_key")
    index = keep_first(dim.select(dim_order, *values, every).where("_key <> ''"), ["_key"], [F.col(dim_order), F.col("_kp")]).drop(dim_order, "_kp")
    probe = facts.select(fact_id, F.posexplode(F.array(*candidates)).alias("_pos", "_key")).where("_key <> ''")
    best = probe.join(index, "_key").groupBy(fact_id).agg(F.min_by(F.struct(*values), "_pos").alias("_hit"))
    return facts.join(best, fact_id, "left").select(*facts.columns, *[F.col(f"_hit.{v}").alias(v) for v in values])


def leaked_names(roster: DataFrame, name: str = "name", country: str = "country", least: int = 3) -> DataFrame:
    """Names that stand with at least `least` different countries."""
    return roster.groupBy(F.lower(F.trim(name)).alias("name")).agg(F.countDistinct(F.nullif(F.lower(F.trim(country)), F.lit(""))).alias("countries")).where(F.col("countries") >= least)


def best_with_margin(scored: DataFrame, key: str, score: str, threshold: float, margin: float, tie: list) -> DataFrame:
    """The best row of each key with at least threshold, unless the second is that good too and closer than margin."""
    w = Window.partitionBy(key).orderBy(F.col(score).desc(), *tie)
    ranked = scored.withColumn("_n", F.row_number().over(w)).withColumn("_second", F.lead(score).over(w))
    clear = F.col("_second").isNull() | (F.col("_second") < threshold) | (F.col(score) - F.col("_second") >= margin)
    return ranked.where((F.col("_n") == 1) & (F.col(score) >= threshold) & clear).drop("_n", "_second")


def overlap_share(a: Column, b: Column) -> Column:
    """Shared tokens as a share of the smaller set, 0 where either is empty."""
    n = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(0.0)


#: Length of the pieces by which texts that lie in others are found.
GRAM = 8


def contained(inner: DataFrame, inner_text: str, outer: DataFrame, outer_text: str) -> DataFrame:
    """The distinct pairs (inner_text, outer_text) in which the outer text contains the inner one; empty texts are in none.

    An inner text is looked up by the rarest of its pieces of GRAM characters (shorter texts as a whole) among the pieces of the
    outer ones, so that a beginning that many share makes no pairs; what is found is confirmed. Only pieces that an inner text asks for are
    kept, and none of these tables is broadcast: a file's size says nothing about its pieces.
    """
    m = F.length(inner_text)
    own = F.when(m >= GRAM, F.transform(F.sequence(F.lit(1), m - GRAM + 1), lambda i: F.substring(F.col(inner_text), i, F.lit(GRAM)))).otherwise(F.array(inner_text))
    keys = inner.select(inner_text).where(m > 0).distinct().select(inner_text, F.explode(F.array_distinct(own)).alias("_piece"))
    many = int(outer.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # held: short texts have many pieces
    o = outer.select(outer_text).where(F.length(outer_text) > 0).distinct().repartition(many, outer_text)
    n = F.length(outer_text)
    piece = lambda size: lambda i: F.substring(F.col(outer_text), i, F.lit(size))
    every = [F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), piece(k))).otherwise(F.array().cast("array<string>")) for k in range(1, GRAM + 1)]
    pieces = o.select(outer_text, F.explode(F.array_distinct(F.concat(*every))).alias("_piece"))
    pieces = pieces.join(keys.select("_piece").distinct(), "_piece", "left_semi")
    counts = pieces.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    rarest = keys.join(counts.hint("merge"), "_piece", "left").groupBy(inner_text).agg(F.min_by("_piece", F.coalesce("_n", F.lit(0))).alias("_piece"))
    return rarest.join(pieces.hint("merge"), "_piece").where(F.col(outer_text).contains(F.col(inner_text))).select(inner_text, outer_text)


def exact_or_contained(facts: DataFrame, fact_id: str, needle: str, roster: DataFrame, name: str, position: str, least: int = 8) -> DataFrame:
    """fact_id and the roster position: an equal name, else (needles of enough characters) the first that contains the needle or lies in it."""
    equal = facts.join(roster, F.col(needle) == F.col(name)).groupBy(fact_id).agg(F.min(position).alias(position))
    rest = facts.join(equal, fact_id, "left_anti").where(F.length(needle) >= least)
    forms = rest.select(needle).distinct()
    pairs = contained(forms, needle, roster, name).unionByName(contained(roster, name, forms, needle)).distinct()
    found = pairs.join(roster.groupBy(name).agg(F.min(position).alias(position)), name).groupBy(needle).agg(F.min(position).alias(position))
    return equal.unionByName(rest.join(found, needle).select(fact_id, position))
