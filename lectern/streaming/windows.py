"""Streams that need no rule of their own: hopping windows over lines of text, and hits joined with the lines around them.

Both are declared with watermarks only, so that Spark keeps and drops the state. A window, or what surrounds a hit, is put out once
the watermark has passed it; rows later than the watermark are dropped.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import COVER_SLACK
from .processors import LATE

#: Lines (and hits of a window) that a task looks at side by side: bytes of lines, number of hits.
LINE_BYTES, HITS = 32 << 20, 4096


def hopping_text(lines: DataFrame, key: str, time: str, order: list[str], text: str, *, size: str = "20 seconds", hop: str = "16 seconds", late: str = LATE) -> DataFrame:
    """key, start, end, lines, text: every window of `size` that begins a multiple of `hop` after 1970 and holds a line, with its lines joined in order.

    A line stands in each window that its time lies in, so neighbouring windows overlap by size - hop.
    """
    each = F.struct(F.col(time).alias("time"), *[F.col(c).alias(f"order{i}") for i, c in enumerate(order)], F.coalesce(F.col(text), F.lit("")).alias("text"))
    held = lines.withWatermark(time, late).groupBy(key, F.window(time, size, hop).alias("w")).agg(F.sort_array(F.collect_list(each)).alias("held"))
    said = F.filter(F.transform("held", lambda x: x["text"]), lambda t: t != "")
    return held.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.size("held").cast("long").alias("lines"), F.array_join(said, " ").alias("text"))


def context_join(
    hits: DataFrame, lines: DataFrame, key: str, hit_time: str, hit_columns: list[str], start: str, end: str, text: str,
    *, before: int, after: int, longest: int, late: str = LATE, stamped: bool = False,
) -> DataFrame:
    """Each hit (key, hit_time, hit_columns) with the passage of the lines (key, start, end, text) that meet [hit_time - before, hit_time + after].

    Both streams have a watermark and no line is longer than `longest` seconds. stamped: the hits have a watermark already. Hits without any line are not
    put out. Repeats from overlapping lines are left out as in sequence.covered_text.
    """
    held = context_windows(hits, lines, key, hit_time, hit_columns, start, end, text, before=before, after=after, longest=longest, late=late, stamped=stamped)
    return passages(held, key, hit_time, hit_columns, before=before, after=after, longest=longest)


def context_windows(
    hits: DataFrame, lines: DataFrame, key: str, hit_time: str, hit_columns: list[str], start: str, end: str, text: str,
    *, before: int, after: int, longest: int, late: str = LATE, stamped: bool = False,
) -> DataFrame:
    """The stateful part of context_join: hits of a key and a hop with the lines around them, from which passages() follow at once or when they are read.

    Hits and lines of a key meet in hopping windows as in hopping_text: a window holds all lines that the hits of one hop can need, so no pair of a hit and
    a line is kept, and Spark drops it once the watermark has passed it. Lines that no passage can hold go before they are sent to their windows (see
    outlasting): first in each task that reads them, then among all lines of a key and a slice of time.
    """
    span = before + longest + after
    hop = max(span // 4, 1)
    hit = F.struct(F.col(hit_time).alias("_at"), *[F.col(c).alias(f"_h{i}") for i, c in enumerate(hit_columns)])
    line = F.struct(F.unix_micros("_time").alias("start"), F.col("_end").alias("end"), F.col("_text").alias("text"))
    h = hits.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(hit_time).alias("_time"), hit.alias("_hit"), F.lit(None).cast("struct<start:bigint,end:bigint,text:string>").alias("_line"))
    h = h if stamped else h.withWatermark("_time", late)
    x = lines.where(F.col(key).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull())
    x = x.select(F.col(key).alias("_key"), F.col(start).alias("_time"), F.unix_micros(end).alias("_end"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    lasting = outlasting(longest)
    x = x.mapInArrow(lasting, x.schema).repartition("_key", F.floor(F.unix_micros("_time") / (span * 1_000_000))).mapInArrow(lasting, x.schema)
    x = x.select("_key", "_time", F.lit(None).cast(h.schema["_hit"].dataType).alias("_hit"), line.alias("_line"))
    both = h.unionByName(x.withWatermark("_time", late)).select("_key", F.window("_time", f"{span + hop} seconds", f"{hop} seconds").alias("_w"), "_hit", "_line")
    home = F.unix_micros("_hit._at") - F.unix_micros("_w.start") - (before + longest) * 1_000_000
    held = both.where(F.col("_hit").isNull() | ((home >= 0) & (home < hop * 1_000_000))).groupBy("_key", "_w").agg(F.collect_set("_hit").alias("_hits"), F.collect_list("_line").alias("_lines"))
    return held.where(F.size("_hits") > 0).select("_key", "_hits", "_lines")


def passages(held: DataFrame, key: str, hit_time: str, hit_columns: list[str], *, before: int, after: int, longest: int) -> DataFrame:
    """The hits of context_windows with their passages, row by row: of a stream, or of what it has stored. Passages of neighbours are long copies of each other."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                lines = batch["_lines"][i].as_py()
                found = batch["_hits"][i].values
                # In order of time, since passages of neighbours are alike and take little room when they are stored.
                found = found.take(pc.sort_indices(found.field("_at")))
                for part in (found.slice(k, HITS) for k in range(0, len(found), HITS)):
                    at = pc.struct_field(part, "_at")
                    told = pa.array(passages_around(lines, np.asarray(at.cast(pa.int64())), before, after, longest), pa.string())
                    keys = batch["_key"].take(pa.array(np.full(len(part), i)))
                    columns = [keys, at, *[pc.struct_field(part, f"_h{c}") for c in range(len(hit_columns))], told]
                    yield pa.RecordBatch.from_arrays(columns, names=[key, hit_time, *hit_columns, "passage"]).filter(told.is_valid())

    kinds = [held.schema["_key"].dataType, *[f.dataType for f in held.schema["_hits"].dataType.elementType.fields]]
    schema = ", ".join(f"`{c}` {k.simpleString()}" for c, k in zip([key, hit_time, *hit_columns], kinds))
    return held.mapInArrow(run, f"{schema}, passage string")


def outlasting(longest: int):
    """For mapInArrow over lines (_key, _time, _end in microseconds, _text): without those that an earlier one of the key outlasts.

    In order of (start, end, text) a passage's first line is the first that ends after some time, and each next one ends later than all before it. So a line
    that ends no later than one before it is in no passage, nor is it the only line that a hit meets, if that one has a text or neither has. This holds in any
    part of the lines, thus in each task's, and in a window: what reaches from an earlier start to a later end is in it too. A line above `longest` seconds
    outlasts nothing, as hits do not look so far back for it. The latest line of a part stays, so the watermark is that of all lines.
    """

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= LINE_BYTES:
                held = _lasting(held, longest)
                size = sum(b.nbytes for b in held)
                if size >= LINE_BYTES // 2:
                    yield from held
                    held, size = [], 0
        if held:
            yield from _lasting(held, longest)

    return run


def _lasting(batches: list[pa.RecordBatch], longest: int) -> list[pa.RecordBatch]:
    rows = pa.Table.from_batches(batches).combine_chunks()
    if not rows.num_rows:
        return []
    key = pc.dictionary_encode(rows["_key"]).combine_chunks().indices
    rows = rows.append_column("_k", key).sort_by([(c, "ascending") for c in ("_k", "_time", "_end", "_text")])
    start, end = np.asarray(rows["_time"].cast(pa.int64())), np.asarray(rows["_end"])
    # Ends as numbers that are greater for every later key, so a running maximum begins anew with each key.
    distinct, rank = np.unique(end, return_inverse=True)
    base = np.asarray(rows["_k"]).astype(np.int64) * (len(distinct) + 1)
    place, said = base + rank + 1, np.asarray(pc.not_equal(rows["_text"], ""))
    reach = np.where(end - start <= longest * 1_000_000, place, base)

    def before(values):
        return np.concatenate([[-1], np.maximum.accumulate(values)[:-1]])

    stays = np.where(said, before(np.where(said, reach, base)), before(reach)) < place
    stays[np.argmax(start)] = True
    return rows.drop_columns("_k").filter(pa.array(stays)).combine_chunks().to_batches()


def passages_around(lines: list[dict], at: np.ndarray, before: int, after: int, longest: int) -> list[str | None]:
    """For each time (in microseconds) the passage of the lines (start, end, text) around it, None where there is no line at all.

    In order of (start, end, text) the next line that is kept depends on the last kept one alone: the first that ends later by more than the slack. So
    these successors are found once, from the last line to the first, and each time has only to find its first line.
    """
    rows = sorted((x["start"], x["end"], x["text"]) for x in lines)
    starts = np.array([r[0] for r in rows], np.int64)
    low, high = at - before * 1_000_000, at + after * 1_000_000
    begin, stop, last = np.searchsorted(starts, low - longest * 1_000_000), np.searchsorted(starts, high), np.searchsorted(starts, high, "right")
    waiting = np.argsort(begin, kind="stable").tolist()
    follower, first, met = [len(rows)] * len(rows), [len(rows)] * len(at), [len(rows)] * len(at)
    # Lines with a text, and all lines, that no earlier one (from here on) outlasts: places, and their ends with a minus, ascending.
    said, every = ([], []), ([], [])

    def nearest(stack, ends_after, or_at=False):
        i = (bisect_right if or_at else bisect_left)(stack[1], -ends_after) - 1
        return stack[0][i] if i >= 0 else len(rows)

    def push(stack, i, end):
        while stack[1] and stack[1][-1] >= -end:
            stack[0].pop(), stack[1].pop()
        stack[0].append(i), stack[1].append(-end)

    for i in range(len(rows), -1, -1):
        if i < len(rows):
            _, end, text = rows[i]
            if text:
                follower[i] = nearest(said, end + round(COVER_SLACK * 1_000_000))
                push(said, i, end)
            push(every, i, end)
        while waiting and begin[waiting[-1]] == i:
            k = waiting.pop()
            first[k], met[k] = nearest(said, int(low[k])), nearest(every, int(low[k]), True)
    out = []
    for k in range(len(at)):
        i, kept = first[k], []
        while i < stop[k]:
            kept.append(rows[i][2])
            i = follower[i]
        out.append(" ".join(kept) if met[k] < last[k] else None)
    return out
