"""The live loop as a chain of stateful operators in one query: who speaks, hits, repeats and cooldown, the lines around what is sent.

Each operator keeps its own state under its own key, and hands the event time on, so that the next one's watermark follows: attribution by stream,
repeats and cooldown by stream and keyword, the surroundings by a join on time. A stream with many keywords is thus no single task's work.

The order for a line is that of the rules: it is attributed, searched, its hits are cleared of repeats, and each keyword may be sent again
once its cooldown is over. What is sent waits for the lines behind it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import hits as H
from ..functions import text as T
from . import attribution
from .processors import IDLE_SECONDS, LATE
from .speaker import SpeakerRules
from .windows import context_join

JOURNAL = "seq long, ts timestamp, speaker string, keyword string, context string, send boolean"


class _Repeats(StatefulProcessor):
    """One keyword of one stream: which contexts were seen when, and when the keyword was last sent."""

    def __init__(self, key: str, ttl: float, cooldown: float, idle: float):
        self.key, self.ttl, self.cooldown, self.idle = key, max(ttl, 1.0), cooldown, idle
        self.columns = [key, *[c.split()[0] for c in JOURNAL.split(", ")]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "context string", "at double")
        self.sent = handle.getValueState("sent", "at double")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "seq", "start"], kind="stable")
        # Each access to state is a message to the JVM, so what was seen is read once and written back once, and a key without a timer is new.
        old = self.timer.get()[0] if self.timer.exists() else None
        sent = self.sent.get()[0] if old is not None and self.sent.exists() else None
        before = {} if old is None else {c: at for (c,), (at,) in self.seen.iterator()}
        seen, out, last, now = dict(before), [], sent, 0.0
        for r in got.itertuples(index=False):
            now = r.ts.timestamp()
            if r.context in seen and now - seen[r.context] < self.ttl:
                continue
            seen[r.context] = now
            send = last is None or now - last >= self.cooldown
            last = now if send else last
            out.append((key[0], r.seq, r.ts, r.speaker, r.keyword, r.context, send))
        if last is not None and last != sent:
            self.sent.update((last,))
        for context, at in seen.items():
            if now - at >= self.ttl:
                if context in before:
                    self.seen.removeKey((context,))
            elif before.get(context) != at:
                self.seen.updateValue((context,), (at,))
        until = max(int((now + max(self.idle, self.cooldown)) * 1000), timerValues.getCurrentWatermarkInMs() + 1)
        if old is None or until > old:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(until)
            self.timer.update((until,))
        yield pd.DataFrame(out, columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for part in (self.seen, self.sent, self.timer):
            part.clear()
        yield pd.DataFrame([], columns=self.columns)

    def close(self) -> None:
        pass


def journal(stream: DataFrame, key: str, rules: SpeakerRules, keywords: list[str], *, context_words: int = 20, ttl: float = 8.0, cooldown: float = 120.0, idle: float = IDLE_SECONDS, late: str = LATE) -> DataFrame:
    """stream: lines and agendas as attribution.attribute takes them; out: key and the columns of JOURNAL, the new hits, with send where an alert is due."""
    spoken = attribution.attribute(stream, key, rules, idle=max(idle, 24 * IDLE_SECONDS), late=late).where(F.col("kind") == attribution.LINE)
    flat = spoken.select(key, "seq", "ts", "speaker", T.squeeze("text").alias("flat"))
    found = H.keyword_hits(flat, "flat", keywords, context_words).select(key, F.lower("keyword").alias("low"), "seq", "ts", "speaker", "keyword", "start", "context")
    kind = dict(stream.dtypes)[key]
    return found.groupBy(key, "low").transformWithStateInPandas(_Repeats(key, ttl, cooldown, idle), f"`{key}` {kind}, {JOURNAL}", "Append", "EventTime", eventTimeColumnName="ts")


def alerts(stream: DataFrame, lines: DataFrame, key: str, rules: SpeakerRules, keywords: list[str], *, before: int = 45, after: int = 45, longest: int = 60, late: str = LATE, **options) -> DataFrame:
    """key, ts, seq, speaker, keyword, context and passage of each alert that is due: journal()'s hits to be sent, with the lines around them.

    lines: key, start, end (timestamps) and text of the same stream's lines.
    """
    sent = journal(stream, key, rules, keywords, late=late, **options).where("send")
    return context_join(sent, lines, key, "ts", ["seq", "speaker", "keyword", "context"], "start", "end", "text", before=before, after=after, longest=longest, late=late, stamped=True)
