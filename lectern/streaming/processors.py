"""Stateful stream operators: cooldown, repeats within a time, delayed context, quotes batched by speaker, speaker tracking.

Each is a processor over one key's rows in time order; its state is a few values or the lines that are still needed. Time is event
time from the rows. The rule itself is a plain function of (state, rows), which replays of stored rows use as well.

With event_time (a timestamp column) the stream gets a watermark, rows later than `late` are dropped, and a key that has been silent
for `idle` seconds is closed: what it still holds is put out and its state goes. Without it state stays as long as the query.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import covered_lines
from .speaker import SpeakerRules

LATE, IDLE_SECONDS = "10 minutes", 3600


class _JsonState(StatefulProcessor):
    """Keeps one JSON value for each key and gives the rows of step(key, state, rows) -> (state, rows).

    close_key(key, state) gives the rows of a key that has gone silent.
    """

    columns: list[str] = []
    order: list[str] = []
    event_time: str | None = None
    idle = IDLE_SECONDS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "value string")

    def step(self, key: tuple, state: dict, rows: list[dict]) -> tuple[dict, list[dict]]:
        raise NotImplementedError

    def step_frame(self, key: tuple, state: dict, rows: pd.DataFrame) -> tuple[dict, pd.DataFrame]:
        """step() over a frame, for rules that need no row by itself."""
        state, out = self.step(key, state, rows.to_dict("records"))
        return state, pd.DataFrame(out, columns=self.columns)

    def close_key(self, key: tuple, state: dict) -> list[dict]:
        return []

    def _read(self) -> dict:
        return json.loads(self.state.get()[0]) if self.state.exists() else {}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable")
        kept = self._read()
        timer = kept.pop("_timer", None)
        state, out = self.step_frame(key, kept, got)
        if self.event_time:
            until = int(got[self.event_time].max().timestamp() * 1000) + int(self.idle * 1000)
            until = max(until, timer or 0, timerValues.getCurrentWatermarkInMs() + 1)
            if until != timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(until)
            state = state | {"_timer": until}
        self.state.update((json.dumps(state),))
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._read()
        state.pop("_timer", None)
        self.state.clear()
        yield pd.DataFrame(self.close_key(key, state), columns=self.columns)

    def close(self) -> None:
        pass


def _run(stream: DataFrame, keys: list[str], processor: type[_JsonState], schema, event_time: str | None, idle: float, late: str) -> DataFrame:
    processor.event_time, processor.idle = event_time, idle
    if event_time:
        stream = stream.withWatermark(event_time, late)
    return stream.groupBy(*keys).transformWithStateInPandas(processor(), outputStructType=schema, outputMode="Append", timeMode="EventTime" if event_time else "None")


def keep_spaced(state: dict, rows: list[dict], time: str, gap: int) -> tuple[dict, list[dict]]:
    """Rows at least gap after the last kept one; rows of one time are kept or left together once."""
    last, out = state.get("last"), []
    for r in rows:
        if last is None or r[time] - last >= gap:
            out.append(r)
            last = r[time]
    return {"last": last}, out


def spaced_places(last: int | None, times: np.ndarray, gap: int) -> tuple[list[int], int | None]:
    """keep_spaced for sorted times alone: the places of the rows that are kept and the last kept time. Each kept row finds the next by a search, so no other row is looked at."""
    at, kept = 0 if last is None else int(np.searchsorted(times, last + gap)), []
    while at < len(times):
        kept.append(at)
        last = int(times[at])
        at = max(at + 1, int(np.searchsorted(times, last + gap)))
    return kept, last


def stream_cooldown(stream: DataFrame, keys: list[str], time: str, cooldown: int, *, event_time: str | None = None, idle: float | None = None, late: str = LATE) -> DataFrame:
    """The rows that the cooldown of their key lets pass. time is a whole number; the first row is the least of its time.

    A silent key may be forgotten once its cooldown is over, so idle should not be shorter than that.
    """
    names = stream.columns

    class Cooldown(_JsonState):
        columns, order = names, [time, *[c for c in names if c != time and c not in keys]]

        def step_frame(self, key, state, rows):
            kept, last = spaced_places(state.get("last"), rows[time].to_numpy(np.int64), cooldown)
            return {"last": last}, rows.iloc[kept]

    return _run(stream, keys, Cooldown, stream.schema, event_time, max(cooldown, IDLE_SECONDS) if idle is None else idle, late)


def stream_dedup(stream: DataFrame, keys: list[str], time: str, ttl: int, **options) -> DataFrame:
    """The first row of each key, and again once ttl has passed since the last kept one."""
    return stream_cooldown(stream, keys, time, max(ttl, 1), **options)


def delayed_context(state: dict, rows: list[dict], before: float, after: float) -> tuple[dict, list[dict]]:
    """Lines (start, end, text, keywords) in; (keyword, t, passage) out once lines cover t + after.

    A keyword that still waits is not queued again. Lines older than what a waiting or coming hit can need are dropped.
    """
    lines, waiting, out = state.get("lines", []), state.get("waiting", []), []
    for r in rows:
        lines.append([float(r["start"]), float(r["end"]), r["text"]])
        for k in [k for k in (r["keywords"] or "").split("|") if k]:
            if k.lower() not in {w[0].lower() for w in waiting}:
                waiting.append([k, float(r["start"])])
        covered = max(x[1] for x in lines)
        ready = [w for w in waiting if covered + 1e-6 >= w[1] + after]
        waiting = [w for w in waiting if w not in ready]
        out += [{"keyword": k, "t": t, "passage": passage(lines, t - before, t + after)} for k, t in ready]
        oldest = min([w[1] for w in waiting], default=covered) - before
        lines = [x for x in lines if x[1] >= oldest]
    return {"lines": lines, "waiting": waiting}, out


def passage(lines: list, low: float, high: float) -> str:
    """Text of the lines that meet [low, high], without those that overlapping windows repeat."""
    return " ".join(covered_lines(lines, low, high))


def left_waiting(state: dict, before: float, after: float) -> list[dict]:
    """(keyword, t, passage) of the hits that still wait, with what there is of their surroundings."""
    return [{"keyword": k, "t": t, "passage": passage(state.get("lines", []), t - before, t + after)} for k, t in state.get("waiting", [])]


def stream_context(stream: DataFrame, key: str, before: float, after: float, *, event_time: str | None = None, idle: float = IDLE_SECONDS, late: str = LATE) -> DataFrame:
    """stream: key, start, end, text and keywords (joined by |), in order of start. A silent key puts out what waits."""
    kind = dict(stream.dtypes)[key]

    class Context(_JsonState):
        columns, order = [key, "keyword", "t", "passage"], ["start", "end", "text"]

        def step(self, k, state, rows):
            state, out = delayed_context(state, rows, before, after)
            return state, [{key: k[0]} | r for r in out]

        def close_key(self, k, state):
            return [{key: k[0]} | r for r in left_waiting(state, before, after)]

    return _run(stream, [key], Context, f"`{key}` {kind}, keyword string, t double, passage string", event_time, idle, late)


def speaker_batches(state: dict, rows: list[dict]) -> tuple[dict, list[dict]]:
    """Quotes (seq, speaker, quote) of a speaker, put out together when another one begins; unknown speakers do not interrupt."""
    speaker, quotes, out = state.get("speaker", ""), state.get("quotes", []), []
    for r in rows:
        if r["speaker"] and r["speaker"] != speaker:
            if quotes:
                out.append({"speaker": speaker, "quotes": len(quotes), "text": "\n".join(quotes)})
            speaker, quotes = r["speaker"], []
        if r["quote"] and speaker:
            quotes.append(r["quote"])
    return {"speaker": speaker, "quotes": quotes}, out


def last_batch(state: dict) -> list[dict]:
    quotes = state.get("quotes", [])
    return [{"speaker": state.get("speaker", ""), "quotes": len(quotes), "text": "\n".join(quotes)}] if quotes else []


def stream_speaker_batches(stream: DataFrame, key: str, *, event_time: str | None = None, idle: float = IDLE_SECONDS, late: str = LATE) -> DataFrame:
    """stream: key, seq, speaker and quote. A silent key puts out its last batch."""
    kind = dict(stream.dtypes)[key]

    class Batches(_JsonState):
        columns, order = [key, "speaker", "quotes", "text"], ["seq"]

        def step(self, k, state, rows):
            state, out = speaker_batches(state, rows)
            return state, [{key: k[0]} | r for r in out]

        def close_key(self, k, state):
            return [{key: k[0]} | r for r in last_batch(state)]

    return _run(stream, [key], Batches, f"`{key}` {kind}, speaker string, quotes long, text string", event_time, idle, late)


def tracked(rules: SpeakerRules, state: dict, rows: list[dict]) -> tuple[dict, list[dict]]:
    """Rows (seq, seconds, text) with their speakers."""
    out = []
    for r in rows:
        state, speaker = rules.observe(state, r["text"], float(r["seconds"]))
        out.append({"seq": int(r["seq"]), "speaker": speaker})
    return state, out


def stream_speakers(stream: DataFrame, key: str, rules: SpeakerRules, *, event_time: str | None = None, idle: float = IDLE_SECONDS, late: str = LATE) -> DataFrame:
    """stream: key, seq, seconds (since 1970) and text; out: the speaker to whom each passage belongs."""
    kind = dict(stream.dtypes)[key]

    class Speakers(_JsonState):
        columns, order = [key, "seq", "speaker"], ["seq"]

        def step(self, k, state, rows):
            state, out = tracked(rules, state, rows)
            return state, [{key: k[0]} | r for r in out]

    return _run(stream, [key], Speakers, f"`{key}` {kind}, seq long, speaker string", event_time, idle, late)


def replay_speakers(chunks: DataFrame, key: str, rules: SpeakerRules) -> DataFrame:
    """The same over stored chunks: one session of a key at a time."""
    kind = dict(chunks.dtypes)[key]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("seq")
        _, out = tracked(rules, {}, rows.to_dict("records"))
        return pd.DataFrame({key: rows[key].to_numpy(), "seq": [o["seq"] for o in out], "speaker": [o["speaker"] for o in out]})

    return chunks.groupBy(key).applyInPandas(run, f"`{key}` {kind}, seq long, speaker string")
