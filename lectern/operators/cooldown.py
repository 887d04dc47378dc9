"""Greedy cooldown: an event is taken if its key has taken none in the last `cooldown` time units.

The rule is sequential, but how a stretch of time begins matters only through the moment from which its key is
free again. So time is cut into slices of `SLICE` cooldowns: each slice finds where taking would end for every place at which it could
start (a step function, of a few steps since different starts soon meet); a fold over a key's slices gives each its true start;
then all slices take their events at once. A task streams over sorted slices, many at a time in whole arrays.

The fold goes up and down a tree: the functions of at most `FAN` neighbouring slices are composed to one, those of as many such groups again, until a
key has one group; then each group's start gives its members theirs. No row holds the steps of more than `FAN` slices, however long a
key's history is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import join_totals

SLICE, FAN = 1024, 256
_NEVER = -(1 << 62)


def changes(table: pa.Table, names: list[str]) -> np.ndarray:
    """Whether each row differs from the one before in one of the columns; nulls are equal, and so are NaNs."""
    out = np.ones(table.num_rows, bool)
    if table.num_rows < 2:
        return out
    out[1:] = False
    for name in names:
        c = table[name].combine_chunks()
        a, b = c.slice(1), c.slice(0, len(c) - 1)
        if pa.types.is_nested(c.type):
            raise ValueError(f"{name}: a key is a plain value")
        other = np.asarray(pc.fill_null(pc.not_equal(a, b), False)) | (np.asarray(a.is_null()) != np.asarray(b.is_null()))
        if pa.types.is_floating(c.type):
            other &= ~np.asarray(pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        out[1:] |= other
    return out


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of sorted rows, with where each group begins; a batch's last group waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        begin = np.flatnonzero(changes(table, names))
        if len(begin) > 1:
            cut = int(begin[-1])
            yield table.slice(0, cut), begin[:-1]
            held = table.slice(cut).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.flatnonzero(changes(table, names))


def _next(t: np.ndarray, group: np.ndarray, end: np.ndarray, cooldown: int) -> np.ndarray:
    """For each event the place of the next of its group that could be taken after it; the group's end if there is none."""
    base = int(t.min())
    far = int(t.max()) - base + cooldown + 1
    if far * (len(end) + 1) < 1 << 62:  # one search over all groups
        line = group * far + (t - base)
        return np.minimum(np.searchsorted(line, line + cooldown), end[group])
    return np.concatenate([a + np.searchsorted(t[a:b], t[a:b] + cooldown) for a, b in zip(np.concatenate(([0], end[:-1])).tolist(), end.tolist())])


def _composed(maps: DataFrame, keys: list[str], cooldown: int) -> DataFrame:
    """The step functions of FAN neighbouring slices as one: where each start leads to, and what follows if the first slice has nothing behind the start."""

    def step(a, s):
        on = lambda x: F.coalesce(F.get(s["_last"], F.size(F.filter(s["_first"], lambda y: y < x["last"] + cooldown))), x["last"])
        led = F.transform(a["steps"], lambda x: F.struct(x["first"].alias("first"), on(x).alias("last")))
        more = F.array(F.struct(F.get(s["_first"], F.lit(0)).alias("first"), F.get(s["_last"], F.lit(0)).alias("last")))
        whole = F.when(a["n"] == 1, F.concat(led, more)).otherwise(led)
        return F.struct((a["n"] + 1).alias("n"), F.when(a["n"] == 0, F.transform(F.arrays_zip(s["_first"].alias("f"), s["_last"].alias("l")), lambda x: F.struct(x["f"].alias("first"), x["l"].alias("last")))).otherwise(whole).alias("steps"))

    one = F.struct(F.lit(0).alias("n"), F.array().cast("array<struct<first:bigint,last:bigint>>").alias("steps"))
    held = maps.groupBy(*keys, F.floor(F.col("_slice") / FAN).cast("long").alias("_slice")).agg(F.array_sort(F.collect_list(F.struct("_slice", "_first", "_last"))).alias("_s"))
    steps = held.select(*keys, "_slice", F.aggregate("_s", one, step, lambda a: a["steps"]).alias("_steps"))
    # Of starts in a row that lead to one end only the last is a step.
    kept = steps.select(*keys, "_slice", F.filter("_steps", lambda x, i: ~x["last"].eqNullSafe(F.get("_steps", i + 1)["last"])).alias("_steps"))
    return kept.select(*keys, "_slice", F.transform("_steps", lambda x: x["first"]).alias("_first"), F.transform("_steps", lambda x: x["last"]).alias("_last"))


def _starts(maps: DataFrame, keys: list[str], cooldown: int) -> DataFrame:
    """keys, _slice and _free: when the key is free again as each slice of a group (of at most FAN) begins, from when it is as the group begins."""

    def step(a, s):
        last = F.get(s["_last"], F.size(F.filter(s["_first"], lambda x: x < a["free"])))
        return F.struct(F.coalesce(last + cooldown, a["free"]).alias("free"), F.concat(a["seen"], F.array(F.struct(s["_slice"].alias("_slice"), a["free"].alias("_free")))).alias("seen"))

    held = maps.groupBy(*keys, "_group").agg(F.min("_free").alias("_free"), F.array_sort(F.collect_list(F.struct("_slice", "_first", "_last"))).alias("_s"))
    entry = F.struct(F.col("_free").alias("free"), F.array().cast("array<struct<_slice:bigint,_free:bigint>>").alias("seen"))
    return held.select(*keys, F.inline(F.aggregate("_s", entry, step, lambda a: a["seen"])))


def take_with_cooldown(events: DataFrame, keys: list[str], time: str, cooldown: int, slice_length: int | None = None) -> DataFrame:
    """Distinct (keys, time) of the events taken. time is a whole number in any unit; null times are never taken, null keys are one key."""
    if cooldown < 0:
        raise ValueError("a negative cooldown")
    rows = events.where(F.col(time).isNotNull()).select(*keys, F.col(time).cast("long").alias("_t"))
    if cooldown == 0:
        return rows.distinct().select(*keys, F.col("_t").alias(time))
    length = max(slice_length or SLICE * cooldown, 2 * cooldown)
    rows = rows.withColumn("_slice", F.floor(F.col("_t") / length).cast("long"))
    group = [*keys, "_slice"]
    key_sql = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in (rows.schema[k] for k in keys))

    def arrays(table: pa.Table, begin: np.ndarray):
        """Distinct times of each group: times, group of each, ends."""
        t, of = np.asarray(table["_t"]), np.zeros(table.num_rows, np.int64)
        of[begin] = 1
        of = np.cumsum(of) - 1
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (of[1:] != of[:-1])
        t, of = t[new], of[new]
        return t, of, np.searchsorted(of, np.arange(len(begin)), side="right")

    def steps(batches):
        for table, begin in whole_groups(batches, group):
            t, of, end = arrays(table, begin)
            after = _next(t, of, end, cooldown)
            last = np.where(after < end[of], after, np.arange(len(t)))
            while True:  # pointer doubling: each event's last successor
                further = last[last]
                if np.array_equal(further, last):
                    break
                last = further
            # Starts at which taking can begin: up to a cooldown behind the slice's edge, and the first one beyond.
            edge = np.asarray(table["_slice"])[begin] * length + cooldown
            first = np.concatenate(([0], end[:-1]))
            possible = np.ones(len(t), bool)
            possible[1:] = (t[:-1] < edge[of[1:]]) | (of[1:] != of[:-1])
            # Of starts in a row that lead to one end only the last is a step.
            keep = np.flatnonzero(possible)
            keep = keep[np.append((last[keep][1:] != last[keep][:-1]), True)]
            offsets = pa.array(np.searchsorted(keep, np.append(first, len(t))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (t[keep], t[last[keep]])]
            out = table.select(group).take(pa.array(begin))
            yield from pa.table([*out.columns, *lists], names=[*group, "_first", "_last"]).combine_chunks().to_batches()

    dealt = rows.repartition(*group).sortWithinPartitions(*group, "_t")
    maps = dealt.mapInArrow(steps, f"{key_sql}_slice long, _first array<long>, _last array<long>")
    reach = rows.agg(F.min("_t").alias("low"), F.max("_t").alias("high")).first()
    low = 0 if reach["low"] is None else reach["low"] // length
    many = 1 if reach["low"] is None else reach["high"] // length - low + 1
    levels = [maps.withColumn("_slice", F.col("_slice") - low)]
    while many > FAN:
        levels.append(_composed(levels[-1], keys, cooldown))
        many = -(-many // FAN)
    starts = _starts(levels.pop().withColumn("_group", F.lit(0)).withColumn("_free", F.lit(_NEVER)), keys, cooldown)
    while levels:
        inside = levels.pop().withColumn("_group", F.floor(F.col("_slice") / FAN).cast("long"))
        starts = _starts(join_totals(inside, starts.withColumnRenamed("_slice", "_group"), [*keys, "_group"]), keys, cooldown)
    starts = starts.withColumn("_slice", F.col("_slice") + low)

    def take(batches):
        for table, begin in whole_groups(batches, group):
            free = np.asarray(table["_free"].take(pa.array(begin)))
            event = np.ones(table.num_rows, bool)
            event[begin] = False  # each group's first row is its start
            table, begin = table.filter(pa.array(event)), begin - np.arange(len(begin))
            t, of, end = arrays(table, begin)
            after = _next(t, of, end, cooldown)
            began = np.concatenate(([0], end[:-1]))
            at = began + np.bincount(of, weights=t < free[of], minlength=len(begin)).astype(np.int64)
            taken = []
            # Places walk through their groups side by side.
            who = np.flatnonzero(at < end)
            at = at[who]
            while len(at):
                taken.append(at)
                at = after[at]
                go = at < end[who]
                at, who = at[go], who[go]
            picked = np.sort(np.concatenate(taken)) if taken else np.zeros(0, np.int64)
            out = table.select(keys).take(pa.array(begin[of[picked]]))
            yield from pa.table([*out.columns, pa.array(t[picked])], names=[*keys, time]).combine_chunks().to_batches()

    # A join may leave a group's rows in several partitions (broadcast, skew), so starts come as rows, ahead of their group by their null time.
    both = rows.withColumn("_free", F.lit(None).cast("long")).unionByName(starts.select(*group, F.lit(None).cast("long").alias("_t"), "_free"))
    return both.repartition(*group).sortWithinPartitions(*group, "_t").mapInArrow(take, f"{key_sql}`{time}` long")


def first_in_window(events: DataFrame, keys: list[str], time: str, ttl: int) -> DataFrame:
    """Events that are not repeated within ttl of the last kept one; the same rule, with rows kept whole (of one time the least)."""
    rest = [c for c in events.columns if c not in (*keys, time)]
    least = events.where(F.col(time).isNotNull()).groupBy(*keys, time).agg(F.min(F.struct(*rest)).alias("_row")) if rest else events.select(*keys, time).distinct()
    kept = join_totals(least, take_with_cooldown(least, keys, time, ttl), [*keys, time])
    return kept.select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in events.columns])
