"""The live monitor as one stateful operator: each window of a stream in turn is attributed, searched, cleared of repeats, and passed on or held back.

The order for a window is fixed: who speaks; which keywords are hit; which of these are new (overlapping windows repeat hits); which keywords may be
sent again. The new hits are the journal; those to be sent are marked.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..functions.text import keyword_pattern
from .processors import IDLE_SECONDS, LATE, _JsonState, _run, tracked
from .speaker import SpeakerRules


@dataclass
class Monitor:
    """keywords in order; words of context on either side; seconds for which a hit counts as repeated, and for which a keyword is not sent again."""

    keywords: list[str]
    rules: SpeakerRules
    context_words: int = 20
    ttl: float = 8.0
    cooldown: float = 120.0
    patterns: list[tuple[str, re.Pattern]] = field(init=False)

    def __post_init__(self):
        self.patterns = [(k, re.compile(keyword_pattern(k).replace("(?iU)", "(?i)", 1))) for k in self.keywords]
        self.ttl = max(self.ttl, 1.0)

    def hits(self, text: str) -> list[tuple[str, str]]:
        """(keyword, context) in keyword order, then by place."""
        flat = " ".join((text or "").split())
        found = []
        for keyword, pattern in self.patterns:
            for m in pattern.finditer(flat):
                before, after, n = flat[: m.start()].split(), flat[m.end() :].split(), self.context_words
                words = " ".join([*(before[-n:] if n else []), m[0], *after[:n]])
                found.append((keyword, f'"{"..." if len(before) > n else ""}{words}{"..." if len(after) > n else ""}"'))
        return found

    def window(self, state: dict, row: dict) -> tuple[dict, list[dict]]:
        """The state after a window (seq, seconds, text) and its new hits."""
        now = float(row["seconds"])
        tracking, who = tracked(self.rules, state.get("speaker", {}), [row])
        seen = {k: t for k, t in state.get("seen", {}).items() if t >= now - self.ttl}
        sent, out, this = dict(state.get("sent", {})), [], set()
        for keyword, context in self.hits(row["text"]):
            low = keyword.casefold()
            key = f"{low}|{context}"
            if key in seen and now - seen[key] < self.ttl:
                continue
            seen[key] = now
            send = low not in this and (low not in sent or now - sent[low] >= self.cooldown)
            if send:
                this.add(low)
            out.append({"seq": int(row["seq"]), "seconds": now, "speaker": who[0]["speaker"], "keyword": keyword, "context": context, "send": send})
        sent.update(dict.fromkeys(this, now))
        return {"speaker": tracking, "seen": seen, "sent": sent}, out


SCHEMA = "seq long, seconds double, speaker string, keyword string, context string, send boolean"


def stream_monitor(stream: DataFrame, key: str, monitor: Monitor, *, event_time: str | None = None, idle: float = IDLE_SECONDS, late: str = LATE) -> DataFrame:
    """stream: key, seq, seconds (since 1970) and text of windows; out: the journal of new hits, with send where an alert is due."""
    kind = dict(stream.dtypes)[key]

    class Windows(_JsonState):
        columns, order = [key, "seq", "seconds", "speaker", "keyword", "context", "send"], ["seq"]

        def step(self, k, state, rows):
            out = []
            for r in rows:
                state, found = monitor.window(state, r)
                out += [{key: k[0]} | f for f in found]
            return state, out

    return _run(stream, [key], Windows, f"`{key}` {kind}, {SCHEMA}", event_time, idle, late)
