"""Parts of addresses: video ids, seek parameters, list pages, session markers. All in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

_ID = r"^[A-Za-z0-9_-]{11}$"


def video_id(url) -> Column:
    """The id of eleven characters in a video page's address: the short host's path, the `v` of a watch page, what follows live, embed, shorts or v, or the only path part."""
    u = F.trim(col(url))
    host, path = F.lower(F.coalesce(F.try_parse_url(u, F.lit("HOST")), F.lit(""))), F.coalesce(F.try_parse_url(u, F.lit("PATH")), F.lit(""))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    long_host = (host == "youtube.com") | host.endswith(".youtube.com")
    found = (
        F.when(host.isin("youtu.be", "www.youtu.be"), first)
        .when(long_host & path.startswith("/watch"), F.try_parse_url(u, F.lit("QUERY"), F.lit("v")))
        .when(long_host & first.isin("live", "embed", "shorts", "v"), second)
        .when(long_host & (F.size(parts) == 1), first)
    )
    return F.when(found.rlike(_ID), found)


def watch_page(video: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), video)


def with_query(url, key: str, value: Column) -> Column:
    """The address with a query key set: an old value goes, the new one stands last. Null for what is no address."""
    u = F.trim(col(url))
    base, fragment = F.regexp_extract(u, r"^([^?#]*)", 1), F.regexp_extract(u, r"(#.*)$", 1)
    pairs = F.filter(F.split(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1), "&"), lambda p: (p != "") & (F.substring_index(p, "=", 1) != key))
    query = F.array_join(F.concat(pairs, F.array(F.concat(F.lit(f"{key}="), value.cast("string")))), "&")
    return F.when(u.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+"), F.concat(base, F.lit("?"), query, fragment))


def seek_link(url, key: str, seconds: Column, reliable: Column) -> Column:
    """The address at a second, the bare one where the clock cannot be trusted."""
    at = F.greatest(F.bround(seconds.cast("double"), 0).cast("long"), F.lit(0))
    return F.when(F.trim(col(url)) != "", F.when(reliable & seconds.isNotNull(), with_query(url, key, at)).otherwise(F.trim(col(url))))


def list_data_url(c, base: str) -> Column:
    """The data address of a speakers' list from a hash, its page's address or the data address; null for others."""
    v = F.trim(col(c))
    whole = F.regexp_replace(F.regexp_extract(v, r"^([a-z]+://[^/?#]+/[^?#]+)", 1), "/+$", "")
    page = F.when(whole.endswith("/data.json"), whole).when(whole.rlike(r"^[a-z]+://[^/]+/."), F.concat(whole, F.lit("/data.json")))
    return F.when(v.rlike("^[0-9a-fA-F]{8,}$"), F.concat(F.lit(f"{base}/"), v, F.lit("/data.json"))).otherwise(page)


def tail_segment(url) -> Column:
    """The last part of an address' path."""
    return F.regexp_extract(col(url), r"([^/?#]+)/*(?:[?#].*)?$", 1)


def of_session(url, session: int) -> Column:
    """Whether an address belongs to a session: its path holds /en/SESSION/."""
    return F.coalesce(F.contains(col(url), F.lit(f"/en/{session}/")), F.lit(False))
