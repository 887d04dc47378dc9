"""Who speaks, as one stateful stream operator with typed state.

Lines and agendas come in one stream, keyed alike: an agenda row replaces the agenda of its day from its time on (or removes it), so that
agendas change while the stream runs. State is held in parts that are read and written apart: the tracker's few values, the agenda of each day
in a map of which a line reads its own day alone, and the days for which a missing agenda has been reported.

The day changes at midnight in New York. A day without an agenda of its own falls back to that of the rules, and one status row says so.

A query that follows another one takes over its state (saved_trackers): what is left of it is decided at the key's first line,
by the rules of speaker.restored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .processors import IDLE_SECONDS, LATE
from .speaker import SpeakerRules, day_in_new_york, restored

LINE, AGENDA, STATUS = "line", "agenda", "status"
#: Columns of the input beside the key; lines have no day and entries, agendas no text.
INPUT = "kind string, seq long, ts timestamp, text string, day string, entries string"
OUTPUT = "kind string, seq long, ts timestamp, speaker string, day string, text string, message string"


def lines_of(stream: DataFrame, key: str, seq: str, ts: str, text: str) -> DataFrame:
    """A stream of lines in the operator's form."""
    empty = F.lit(None).cast("string")
    return stream.select(key, F.lit(LINE).alias("kind"), F.col(seq).cast("long").alias("seq"), F.col(ts).alias("ts"), F.col(text).alias("text"), empty.alias("day"), empty.alias("entries"))


def agendas_of(stream: DataFrame, key: str, ts: str, day: str, entries: str) -> DataFrame:
    """A stream of agendas: from ts on a day has these entries (array of struct name, country, title; null: none)."""
    listed = F.to_json(F.transform(entries, lambda e: F.array(*[F.coalesce(e[c], F.lit("")) for c in ("name", "country", "title")])))
    return stream.select(key, F.lit(AGENDA).alias("kind"), F.lit(None).cast("long").alias("seq"), F.col(ts).alias("ts"), F.lit(None).cast("string").alias("text"), F.col(day).alias("day"), listed.alias("entries"))


class _Attribution(StatefulProcessor):
    def __init__(self, key: str, rules: SpeakerRules, idle: float):
        self.key, self.rules, self.idle = key, rules, idle
        self.columns = [key, *[c.split()[0] for c in OUTPUT.split(", ")]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tracker = handle.getValueState("tracker", "value string")
        self.agendas = handle.getMapState("agendas", "day string", "entries string")
        self.reported = handle.getMapState("reported", "day string", "at double")
        self.timer = handle.getValueState("timer", "at long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        values = [json.loads(v) for v in initialState["value"] if v]
        if values:
            last = max(values, key=lambda v: v.get("since") or 0)
            self.tracker.update((json.dumps({"taken_over": last}),))

    def _agenda(self, day: str) -> list[tuple[str, str, str]] | None:
        return [tuple(e) for e in json.loads(self.agendas.getValue((day,))[0])] if self.agendas.containsKey((day,)) else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows), ignore_index=True)
        got["_agenda"] = got["kind"] != AGENDA
        got = got.sort_values(["ts", "_agenda", "seq"], kind="stable")
        # Each access to state is a message to the JVM: a key without a tracker is new, and each day is asked for once.
        seen = self.tracker.exists()
        state, known, reported, out = json.loads(self.tracker.get()[0]) if seen else {}, {}, set(), []
        for r in got.itertuples(index=False):
            if r.kind == AGENDA:
                known.pop(r.day, None)
                if r.entries is None:
                    if self.agendas.containsKey((r.day,)):
                        self.agendas.removeKey((r.day,))
                else:
                    self.agendas.updateValue((r.day,), (r.entries,))
                continue
            now = r.ts.timestamp()
            day = day_in_new_york(now)
            if "taken_over" in state:
                state = restored(state["taken_over"], now)
            if day not in known:
                known[day] = self._agenda(day)
            if known[day] is None and day not in reported and not self.reported.containsKey((day,)):
                self.reported.updateValue((day,), (now,))
                fallback = self.rules.agenda_at(now)
                out.append((key[0], STATUS, None, r.ts, None, day, None, f"no agenda of {day}; {len(fallback)} speakers of another agenda are used"))
            reported.update([day] if known[day] is None else [])
            rules = self.rules if known[day] is None else replace(self.rules, agenda=known[day])
            state, who = rules.observe(state, r.text, now)
            out.append((key[0], LINE, int(r.seq), r.ts, who, day, r.text, None))
        self.tracker.update((json.dumps(state),))
        until = max(int(got["ts"].max().timestamp() * 1000) + int(self.idle * 1000), timerValues.getCurrentWatermarkInMs() + 1)
        old = self.timer.get()[0] if seen and self.timer.exists() else None
        if old is None or until > old:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(until)
            self.timer.update((until,))
        yield pd.DataFrame(out, columns=self.columns).astype({"seq": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for part in (self.tracker, self.agendas, self.reported, self.timer):
            part.clear()
        yield pd.DataFrame([], columns=self.columns)

    def close(self) -> None:
        pass


def attribute(stream: DataFrame, key: str, rules: SpeakerRules, *, taken_over: DataFrame | None = None, idle: float = 24 * IDLE_SECONDS, late: str = LATE) -> DataFrame:
    """stream: key and the columns of INPUT (lines_of and agendas_of, unioned); out: key and the columns of OUTPUT.

    A row of kind line for each line, with its speaker; one of kind status for each day that has no agenda. taken_over: key and value
    of each tracker, from saved_trackers. A key that has been silent for `idle` seconds of event time is forgotten.
    """
    kind = dict(stream.dtypes)[key]
    grouped = stream.withWatermark("ts", late).groupBy(key)
    start = None if taken_over is None else taken_over.select(F.col(key).cast(kind).alias(key), "value").groupBy(key)
    return grouped.transformWithStateInPandas(_Attribution(key, rules, idle), f"`{key}` {kind}, {OUTPUT}", "Append", "EventTime", initialState=start, eventTimeColumnName="ts")


def saved_trackers(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """key and value of each tracker, as the query with this checkpoint left it."""
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "tracker").load()
    return held.select(F.col(f"key.{key}").alias(key), F.col("value.value").alias("value"))
