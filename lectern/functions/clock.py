"""Times and clocks: parsing, calendars, plausibility, freshness, stream time and zones. All in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

#: The longest plausible age of a live stream, and how many watchdog times a heartbeat stays fresh.
LONGEST_LIVE_SECONDS, FRESH_TIMES = 36 * 3600, 2.0
#: The names of zones by their hours from UTC.
ZONE_NAMES = {"America/New_York": {-4: "EDT", -5: "EST"}, "Europe/Madrid": {2: "CEST", 1: "CET"}, "UTC": {0: "UTC"}}


def parse_utc(c) -> Column:
    """A moment from ISO text; without a zone it is UTC, null for anything else. The session's zone is UTC."""
    s = F.regexp_replace(F.trim(col(c)), r"^(\S+) (\d)", "$1T$2")
    return F.when(s.rlike(r"^\d{4}-\d\d-\d\d"), F.try_to_timestamp(s))


def session_day(day, debate_days: list[str]) -> Column:
    """A day whose month and day are in a session's calendar gets that session's year; others stay."""
    d = F.trim(col(day))
    same = F.create_map(*[x for full in reversed(debate_days) for x in (F.lit(full[5:]), F.lit(full))]) if debate_days else F.lit(None).cast("map<string,string>")
    known = F.when(d.isin(debate_days), d) if debate_days else F.lit(None).cast("string")
    return F.coalesce(known, F.when(d.rlike(r"^\d{4}-\d\d-\d\d$"), F.try_element_at(same, F.substring(d, 6, 5))), d)


def live_origin(start: Column, now: Column) -> Column:
    """struct seconds, reliable: the age of a stream that began at `start` (seconds since 1970), 0 and false if that is not plausible."""
    age = now - start
    good = F.coalesce((start > 0) & age.between(0, LONGEST_LIVE_SECONDS), F.lit(False))
    return F.struct(F.when(good, age).otherwise(0.0).cast("double").alias("seconds"), good.alias("reliable"))


def origin_with_player(origin: Column, dvr: Column, elapsed: Column) -> Column:
    """The same, overruled by a player's clock: without rewinding nothing is reliable, an elapsed time is; no player (null dvr) changes nothing."""
    own = F.struct(elapsed.cast("double").alias("seconds"), F.lit(True).alias("reliable"))
    return F.when(~dvr, F.struct(origin["seconds"].alias("seconds"), F.lit(False).alias("reliable"))).when(dvr & elapsed.isNotNull(), own).otherwise(origin)


def is_fresh(beat: Column, now: Column, limit: float, times: float = FRESH_TIMES) -> Column:
    """Whether a heartbeat is younger than so many limits; always where the watchdog is off, never without a beat."""
    return F.lit(True) if limit <= 0 else F.coalesce(now - beat < limit * times, F.lit(False))


def is_stale(progress: Column, now: Column, limit: float) -> Column:
    return F.lit(False) if limit <= 0 else now - progress >= limit


def keeps_speaker(since: Column, now: Column) -> Column:
    """Whether a stored speaker still counts: the speech began on the same New York day, at most 90 minutes ago."""
    day = lambda t: F.to_date(F.from_utc_timestamp(t, "America/New_York"))
    return F.coalesce((day(since) == day(now)) & (F.unix_timestamp(now) - F.unix_timestamp(since) <= 5400), F.lit(False))


def pcm_seconds(n_bytes: Column, rate: int) -> Column:
    """Seconds of 16-bit mono sound."""
    if rate <= 0:
        raise ValueError("a sampling rate above 0")
    return n_bytes / (2.0 * rate)


def video_seconds(origin: Column, fresh_bytes: Column, window_bytes: Column, segment_start: Column, rate: int) -> Column:
    """Place of a segment in the stream: a window of sound ends where the fresh sound so far ends (overlap is not fresh)."""
    return F.greatest(F.lit(0.0), origin + pcm_seconds(fresh_bytes, rate) - pcm_seconds(window_bytes, rate) + segment_start)


def player_time(seconds: Column) -> Column:
    """h:mm:ss, or mm:ss below an hour; rounded half to even."""
    s = F.greatest(F.bround(seconds.cast("double"), 0).cast("long"), F.lit(0))
    return F.when(s >= 3600, F.format_string("%d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60)).otherwise(F.format_string("%02d:%02d", F.floor(s / 60).cast("long"), s % 60))


def in_zone(ts: Column, zone: str) -> Column:
    """Local date and time with the zone's short name; its hours from UTC tell summer from winter."""
    local = F.from_utc_timestamp(ts, zone)
    hours = F.round((F.unix_timestamp(local) - F.unix_timestamp(ts)) / 3600).cast("int")
    names = F.create_map(*[x for h, n in ZONE_NAMES[zone].items() for x in (F.lit(h), F.lit(n))])
    return F.concat_ws(" ", F.date_format(local, "yyyy-MM-dd HH:mm:ss"), names[hours])


def when_lines(ts: Column) -> Column:
    """The moment in UTC, New York and Madrid, one below the other."""
    return F.concat_ws("\n", *[in_zone(ts, z) for z in ("UTC", "America/New_York", "Europe/Madrid")])


def account_slot(hour: Column, second: bool) -> Column:
    """Which of two sender accounts an hour uses: A in even hours, B in odd ones if there is a second account."""
    return F.when((F.pmod(hour, F.lit(2)) == 1) & F.lit(second), "B").otherwise("A")
