"""Column expressions on text: normalising, keyword matching, ids, labels and URLs. All run in the JVM."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, then) -> Column:
    """then(value) with the value evaluated once, however often then names it, also inside lambdas (null values included)."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def squeeze(c) -> Column:
    """Runs of white space (Unicode) become one space; none at the ends."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def words(c) -> Column:
    """White-space separated words; an empty or null text has none."""
    return F.coalesce(F.array_remove(F.split(col(c), r"(?U)\s+"), ""), F.array().cast("array<string>"))


def keyword_pattern(keyword: str) -> str:
    """Whole-word pattern, blind to case; white space in a phrase matches any run of it."""
    parts = keyword.split()
    if not parts:
        raise ValueError("an empty keyword")
    return r"(?iU)\b" + r"\s+".join(re.escape(p) for p in parts) + r"\b"


def any_keyword(keywords) -> str:
    """One alternation, longest first: a cheap test before counting each keyword."""
    bodies = [keyword_pattern(k)[len(r"(?iU)\b") : -len(r"\b")] for k in sorted(keywords, key=len, reverse=True)]
    return r"(?iU)\b(?:" + "|".join(bodies) + r")\b"


def keyword_count(c, keyword: str) -> Column:
    return F.regexp_count(col(c), F.lit(keyword_pattern(keyword))).cast("long")


def mark_plain(c, keywords) -> Column:
    """`**` around keywords; of overlapping ones the longest at the earliest place."""
    return F.regexp_replace(col(c), any_keyword(keywords).replace("(?:", "(", 1), "**$1**")


def html_escape(c) -> Column:
    out = col(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def mark_html(c, keywords) -> Column:
    return F.regexp_replace(html_escape(c), any_keyword(keywords).replace("(?:", "(", 1), "<strong>$1</strong>")


def snippet(before: Column, hit: Column, after: Column, context: int) -> Column:
    """The hit with context words on both sides in quotes; `...` where words were cut."""
    left = F.when(F.size(before) > context, F.slice(before, F.size(before) - context + 1, F.lit(context))).otherwise(before)
    right = F.slice(after, 1, context) if context else F.array().cast("array<string>")
    left = left if context else F.array().cast("array<string>")
    parts = F.array_join(F.concat(left, F.array(hit), right), " ")
    cut_left = F.when(F.size(before) > context, "...").otherwise("")
    cut_right = F.when(F.size(after) > context, "...").otherwise("")
    return F.concat(F.lit('"'), cut_left, parts, cut_right, F.lit('"'))


def timecode(seconds) -> Column:
    """h:mm:ss of whole seconds."""
    s = F.floor(col(seconds)).cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60)


def id_number(c) -> Column:
    """The number of an id like M_12, null for others and for zero."""
    return F.nullif(F.regexp_extract(col(c), r"(?i)^M_(\d+)$", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def format_id(number) -> Column:
    return F.concat(F.lit("M_"), col(number).cast("string"))


def strict_code(c) -> Column:
    """An integer written as such; null for anything else."""
    s = F.trim(col(c))
    return F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("int"))


def ascii_slug(c) -> Column:
    """Lower case, every run of other characters becomes one hyphen."""
    return F.trim(F.regexp_replace(F.lower(col(c)), r"[^a-z0-9]+", "-"), F.lit("-"))


#: Latin letters with marks and the letters without them, by decomposition.
_MARKED = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x250) if unicodedata.normalize("NFKD", chr(c))[0].isascii()]


def without_marks(c) -> Column:
    """Latin letters without accents."""
    return F.translate(col(c), "".join(a for a, _ in _MARKED), "".join(b for _, b in _MARKED))


def country_slug(c) -> Column:
    """Lower case without accents and without what stands in brackets: `Iran (Islamic Republic of)` is `iran`."""
    return ascii_slug(without_marks(F.lower(F.regexp_replace(col(c), r"\([^)]*\)", " "))))


#: Words that a weak slug leaves out.
SLUG_STOP_WORDS = ["of", "the", "and", "de", "la", "a"]


def weak_slug(c) -> Column:
    return F.array_join(F.filter(F.split(ascii_slug(c), "-"), lambda w: ~w.isin(SLUG_STOP_WORDS)), "-")


def new_york_day(ts) -> Column:
    return F.date_format(F.from_utc_timestamp(col(ts), "America/New_York"), "yyyy-MM-dd")


def day_month_year(c) -> Column:
    """dd/mm/yyyy of an ISO date; anything else as it is."""
    p = F.split(col(c), "-")
    return F.when(F.size(p) == 3, F.concat_ws("/", F.get(p, F.lit(2)), F.get(p, F.lit(1)), F.get(p, F.lit(0)))).otherwise(col(c))


def clip(c, n: int) -> Column:
    return F.when(F.length(col(c)) > n, F.concat(F.left(col(c), F.lit(n - 3)), F.lit("..."))).otherwise(col(c))


def flat_lines(c) -> Column:
    return F.regexp_replace(col(c), "\r\n|\r|\n", " | ")


def strip_tags(c) -> Column:
    """Tags become spaces, the common entities characters, white space single spaces."""
    out = F.regexp_replace(col(c), "<[^>]+>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def estimated_tokens(c) -> Column:
    return F.floor((F.length(col(c)) + 3) / 4).cast("long")


def cache_key(c) -> Column:
    return F.left(F.sha2(col(c), 256), F.lit(24))


def first_available(sources: dict[str, Column]) -> Column:
    """Name of the first source that is not null, in the given order."""
    return F.coalesce(*[F.when(v.isNotNull(), F.lit(k)) for k, v in sources.items()])


#: Fixed value: seconds by which a line must reach beyond what is covered to count as new.
COVER_SLACK = 0.3


def covered_lines(lines: list, low: float, high: float, slack: float = COVER_SLACK) -> list[str]:
    """Texts of the lines (start, end, text) that meet [low, high], without those that end no later than what is covered; the rule of sequence.covered_text."""
    kept, covered = [], low
    for start, end, text in sorted(x for x in lines if x[0] < high and x[1] > low and x[2]):
        if not kept or end > covered + slack:
            kept.append(text)
            covered = max(covered, end)
    return kept
