"""Keep-first, last-wins, unions, idempotent appends and numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key by order; unlike dropDuplicates this is the same row each time."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def last_wins(df: DataFrame, keys: list[str], position: str, values: list[str]) -> DataFrame:
    """Each key's last values at the position of its first row: a partial aggregate, no sort of whole groups."""
    return df.groupBy(*keys).agg(F.min(position).alias(position), *[F.max_by(v, position).alias(v) for v in values])


def union_first(frames: list[DataFrame], keys: list, order: list) -> DataFrame:
    """All frames' rows; of equal keys the row of the earliest frame, then the first by order."""
    tagged = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    out = tagged[0]
    for f in tagged[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return keep_first(out, keys, [F.col("_source"), *order]).drop("_source")


def append_missing(existing: DataFrame, new: DataFrame, key: Column | str, order: list) -> DataFrame:
    """The rows of new whose key is neither empty nor in existing, the first of each: what an idempotent append writes.

    key: a name or an expression that both sides can evaluate.
    """
    k = F.col(key) if isinstance(key, str) else key
    old = existing.select(k.alias("_key")).where("_key <> ''").distinct()
    rows = keep_first(new.withColumn("_key", k).where("_key <> ''"), ["_key"], order)
    return rows.join(old, "_key", "left_anti").drop("_key")


def append_missing_aliases(existing: DataFrame, new: DataFrame, aliases: list[Column], row_id: str) -> DataFrame:
    """The rows of new none of whose aliases (non-empty) is one of existing."""
    every = F.explode(F.filter(F.array(*aliases), lambda x: x.isNotNull() & (x != "")))
    old = existing.select(every.alias("_alias")).distinct()
    seen = new.select(row_id, every.alias("_alias")).join(old, "_alias", "left_semi").select(row_id).distinct()
    return new.join(seen, row_id, "left_anti")


def drop_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on).distinct(), on, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str, position: str) -> DataFrame:
    """new replaces rows of old in place and adds the others at the end; rows with an empty key go."""
    old, new = old.where(F.col(key) != ""), last_wins(new.where(F.col(key) != ""), [key], position, [c for c in new.columns if c not in (key, position)])
    end = old.agg(F.coalesce(F.max(position), F.lit(-1)).alias("_end"))
    a, b = old.alias("a"), new.crossJoin(F.broadcast(end)).alias("b")
    cols = [c for c in old.columns if c not in (key, position)]
    pick = [F.when(F.col(f"b.{key}").isNotNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in cols]
    at = F.coalesce(F.col(f"a.{position}"), F.col("b._end") + 1 + F.col(f"b.{position}")).alias(position)
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), at, *pick)


def evolve(stored: list[str], df: DataFrame) -> list[str]:
    """The stored header with the columns that are new, at the right."""
    return [*stored, *[c for c in df.columns if c not in stored]]


def numbered(df: DataFrame, order: list, name: str, within: list[str] | None = None) -> DataFrame:
    """1, 2, ... in order, within groups of bounded size."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*(within or [])).orderBy(*order)))


def join_totals(rows: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the columns of totals, joined on keys of which null is one."""
    right = totals.withColumnsRenamed({k: f"_total_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_total_{k}")) for k in keys]
    return rows.join(right, on).drop(*[f"_total_{k}" for k in keys])


def row_numbers_at_scale(df: DataFrame, part: Column, order: list, name: str, within: list[str] | None = None) -> DataFrame:
    """Row numbers from 1, over everything or within large groups: parts in ascending order (null last), each numbered on its own; only part sizes meet."""
    keys = [*(within or []), "_part"]
    rows = df.withColumn("_part", part)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*(within or [])).orderBy(F.col("_part").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    return join_totals(rows.withColumn("_n", F.row_number().over(inside)), sizes, keys).withColumn(name, (F.col("_n") + F.col("_before")).cast("long")).drop("_part", "_n", "_before")


def in_batches(df: DataFrame, order: list, size: int, within: list[str], part: Column) -> DataFrame:
    """The number of each row's batch of size rows; part cuts large groups (see row_numbers_at_scale)."""
    return row_numbers_at_scale(df, part, order, "_row", within).withColumn("batch", F.floor((F.col("_row") - 1) / size).cast("long")).drop("_row")


def assign_ids(items: DataFrame, kept: Column, part: Column, order: list, start: int = 1) -> DataFrame:
    """items with id: the kept number, else the next free number from start on, in order.

    The k-th row without a number gets the k-th number that no row keeps: numbers left free are counted from the kept ones, so a
    row's number is its rank plus the kept numbers below it.
    """
    rows = items.withColumn("_kept", kept)
    used = rows.where(F.col("_kept") >= start).select(F.col("_kept").alias("u")).distinct()
    # rank of u among the used numbers: u - rank(u) free numbers lie below it
    used = row_numbers_at_scale(used, F.floor(F.col("u") / 100_000), [F.col("u")], "r").select("u", (F.col("u") - start + 1 - F.col("r")).alias("free_below"), "r")
    steps = used.groupBy("free_below").agg(F.max("r").alias("r"))
    fresh = row_numbers_at_scale(rows.where(F.col("_kept").isNull()), part, order, "_k")
    # the k-th free number is start - 1 + k + (used numbers with fewer than k free ones below them)
    probe = fresh.select(F.col("_k").alias("k"), F.lit(None).cast("long").alias("r"), F.lit(1).alias("side"))
    build = steps.select((F.col("free_below") + 1).alias("k"), F.col("r").cast("long").alias("r"), F.lit(0).alias("side"))
    both = probe.unionByName(build).withColumn("_p", F.floor(F.col("k") / 100_000))
    tops = both.groupBy("_p").agg(F.max("r").alias("top"))
    carry = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_p", F.max("top").over(carry).alias("_carry"))
    w = Window.partitionBy("_p").orderBy("k", "side").rowsBetween(Window.unboundedPreceding, 0)
    at = both.withColumn("_m", F.max("r").over(w)).join(tops, "_p").where("side = 1")
    at = at.select(F.col("k").alias("_k"), (F.lit(start - 1) + F.col("k") + F.coalesce("_m", "_carry", F.lit(0))).alias("_new"))
    given = fresh.join(at, "_k").withColumn("id", F.col("_new").cast("long")).drop("_k", "_new")
    own = rows.where(F.col("_kept").isNotNull()).withColumn("id", F.col("_kept").cast("long"))
    return own.unionByName(given).drop("_kept")
