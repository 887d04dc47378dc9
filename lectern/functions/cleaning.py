"""Cleaning of extracted text: garbage detection, line rules, paragraphs, lenient JSON."""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import col


def is_glyph_garbage(c) -> Column:
    """Text of glyph numbers: at least 20 of them and hardly any letters."""
    tokens = F.regexp_count(col(c), F.lit(r"/i?\d+"))
    letters = F.regexp_count(F.regexp_replace(col(c), r"/i?\d+", " "), F.lit(r"\p{L}"))
    return (tokens >= 20) & (letters < F.greatest(F.lit(20), F.floor(tokens / 5).cast("int")))


def is_shouted(line: Column) -> Column:
    """A heading: at least 12 letters, under 120 characters, more than 85 % capitals."""
    letters, capitals = F.length(F.regexp_replace(line, r"\P{L}+", "")), F.length(F.regexp_replace(line, r"\P{Lu}+", ""))
    return (F.length(line) < 120) & (letters >= 12) & (100 * capitals > 85 * letters)


#: Lines that are no text of a speech, by what they are.
LINE_RULES = {
    "page": r"^(?:page\s+\d+(?:\s+of\s+\d+)?(?:\s*\|\s*.*)?|\d+\s*\|\s*p\s*a\s*g\s*e|\d+\s*/\s*\d+|\d{1,3})$",
    "letterhead": (
        r"^(?:please check against delivery|\(please check against delivery\)|check against delivery|seul le prononc[eé] fait foi|t[eé]l[eé]charger le \.pdf"
        r"|statement by\b|national statement by\b|address (?:by|to)\b|remarks delivered\b|the secretary-general$|permanent mission\b|fuente:.*|updated\s+\d{4}"
        r"|publicado em\b|atualizado em\b|https?://|www\.|(?:tel|e-?mail|fax)\s*:|new york,?\s+(?:ny\b|\d)|\d{3,}\s+\w+\s+(?:avenue|street|blvd)|--+)"
    ),
    "print": r"^(?:\d{1,2}/\d{1,2}/\d{2,4},?\s+\d{1,2}:\d{2}\s*(?:[ap]m)?\b|news$)",
    "greeting": r"^(?:bismillah|assalam|wassalam|shalom|salve,?$|om (?:swasti|shanti)|salam kebajikan|rahayu|in the name of (?:god|allah)|au nom d)",
}
SPACED_LETTERS = r"^(?:[A-Z]\s+){4,}[A-Z].*$"
#: How speeches begin, how sentences end, how new blocks begin, what may only stand inside a sentence.
SPEECH_START = (
    r"(?i)^(?:-?\s*madam(?:e)?(?:\s+la)?(?:\s+pr[eé]sident[ae]?|\s+first)?|-?\s*mr\.?\s+(?:president|secretary)|-?\s*mister\s+president|-?\s*ms\.?\s+president"
    r"|-?\s*the\s+president\s+of\s+the|-?\s*president\s+of\s+the\s+\d+|-?\s*secretary[- ]general\b|-?\s*distinguished\s+delegat|-?\s*ladies\s+and\s+gentlemen"
    r"|-?\s*your\s+excellenc|-?\s*excellencies\b|-?\s*heads?\s+of\s+state|let\s+me\s+(?:begin|start)|it\s+is\s+(?:indeed\s+)?(?:a\s+|my\s+)?(?:great\s+)?(?:honou?r|pleasure)"
    r"|i\s+(?:stand|congratulate|have\s+the|wish\s+to|am\s+(?:honou?red|pleased|happy)|want\s+to)|eighty\s+years|\d+\.\s+\S|estimad[ao]s?|se[nñ]hor[ae]s?\s|mesdames?\b|messieurs\b"
    r"|monsieur\s+le|je\s+(?:suis|voudrais|tiens)|son\s+ochenta|-?\s*(?:his|her)\s+excellency\s+m[rs])"
)
FINISHED, NEW_BLOCK, INSIDE = r"""[.!?…؟۔]["'”’»)]*$""", r"^(?:\d+\.\s|-+\s)", r"^[\p{Ll},;:)\]—–-]"
#: What a chair says before and after a speech, and what a recogniser writes above it.
_TO_ROSTRUM = r"(?:address\s+the\s+assembly|to\s+the\s+rostrum)\.?\s*"
_ESCORT = r"i\s+request\s+(?:the\s+)?protocol\s+to\s+(?:escort|his\s+court|her\s+court)"
PROTOCOL = (
    rf"(?i)^\s*(?:the\s+)?assembly\s+will\s+(?:now\s+)?hear\s+(?:an\s+|and\s+)?(?:address|statement)\s+by\b[\s\S]{{10,500}}?{_ESCORT}[\s\S]{{0,220}}?{_TO_ROSTRUM}",
    rf"(?i)^\s*{_ESCORT}[\s\S]{{10,220}}?{_TO_ROSTRUM}",
    r"(?i)(?:(?<=[.!?])\s+|(?<=\n)|^)on\s+behalf\s+of\s+(?:the\s+)?(?:general\s+)?assembly,?\s+i\s+wish\s+to\s+thank\b[\s\S]*$",
)
TRANSCRIPT_HEADER = r"(?i)^(?:Meeting/Event:|Date:|Categories:|\s*\[Auto-generated transcript)"
TRANSCRIPT_START = r"(?i)(?:the\s+)?assembly\s+will\s+(?:now\s+)?hear\b"


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_glyph_line(line: Column) -> Column:
    """A line of glyph numbers such as /12/i4."""
    slashes = F.length(line) - F.length(F.replace(line, F.lit("/"), F.lit("")))
    return ((slashes >= 8) & (F.regexp_count(line, F.lit(r"/\d+")) >= 6)) | ((slashes >= 4) & line.rlike(r"^[\d/i\s]+$"))


def is_no_text(line: Column) -> Column:
    """Whether one of the rules drops a line; empty lines stay."""
    rules = "(?i)^(?:" + "|".join(p.removeprefix("^") for p in LINE_RULES.values()) + ")"
    return (line != "") & (line.rlike(rules) | is_shouted(line) | line.rlike(SPACED_LETTERS) | is_glyph_line(line))


def one_newline(c) -> Column:
    """A text whose lines all end in a line feed."""
    return F.replace(F.replace(col(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def clean_lines(c) -> Column:
    """The lines of a text without those that are no text, trimmed, with single spaces and without soft hyphens."""
    whole = F.regexp_replace(F.replace(one_newline(c), F.lit("\u00ad"), F.lit("")), r"[\t\x{00A0}\x{2009}\x{202F}]", " ")
    plain = F.transform(F.split(F.regexp_replace(whole, "  +", " "), "\n"), lambda x: F.trim(x))
    return F.filter(plain, lambda x: ~is_no_text(x))


def from_speech_start(lines: Column) -> Column:
    """The lines from the first one with which a speech can begin; all if there is none."""
    at = F.array_position(F.transform(lines, lambda x: x.rlike(SPEECH_START)), True)
    return F.when(at > 1, F.slice(lines, at.cast("int"), F.size(lines))).otherwise(lines)


def joins(before: Column, line: Column) -> Column:
    """Whether a line goes on with the paragraph before it: not as a new block; always if it begins in small letters or with a mark that cannot
    begin a sentence; else unless a sentence has ended, or a comma or colon stands before a capital."""
    opens = F.regexp_extract(before, "[,:]$", 0) != ""
    return ~line.rlike(NEW_BLOCK) & (line.rlike(INSIDE) | (~before.rlike(FINISHED) & ~(opens & line.rlike(r"^\p{Lu}"))))


def reflow(lines: Column) -> Column:
    """Lines into paragraphs, joined by empty lines; a hyphen at a line's end joins its word. Empty lines say nothing.

    How a paragraph goes on depends on its end alone, so rules look at `tail`, what follows its last joint by a space, and not at all of it for each line.
    """
    begin = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit("").alias("tail"))
    tidy = lambda p: F.regexp_replace(F.trim(F.regexp_replace(p, "  +", " ")), r" +([,.;:!?])", "$1")
    full = lambda a: F.when(a["open"] == "", a["done"]).otherwise(F.concat(a["done"], F.array(tidy(a["open"]))))
    cut = lambda p, x: F.concat(F.left(p, F.length(p) - 1), x)
    grown = lambda a, x: (
        F.when(a["tail"].rlike("(?<!-)-$"), F.struct(a["done"].alias("done"), cut(a["open"], x).alias("open"), cut(a["tail"], x).alias("tail")))
        .otherwise(F.struct(a["done"].alias("done"), F.concat(a["open"], F.lit(" "), x).alias("open"), x.alias("tail")))
    )
    step = lambda a, x: (
        F.when(x == "", a)
        .when((a["open"] != "") & joins(a["tail"], x), grown(a, x))
        .otherwise(F.struct(full(a).alias("done"), x.alias("open"), x.alias("tail")))
    )
    return F.aggregate(lines, begin, step, lambda a: F.array_join(full(a), "\n\n"))


def without_protocol(c) -> Column:
    """A text without the chair's introduction at its head and thanks at its end."""
    out = _stripped(col(c))
    for pattern in PROTOCOL:
        out = _stripped(F.regexp_replace(out, pattern, ""))
    return out


def clean_document(c) -> Column:
    """The speech in an extracted document: line rules, its first line, paragraphs, protocol. Compatibility characters are for `nfkc` before."""
    return without_protocol(reflow(from_speech_start(clean_lines(c))))


def clean_transcript(c) -> Column:
    """The speech in a recognised transcript: without header lines, from the chair's announcement on, without protocol."""
    lines = F.filter(F.split(col(c), "\r\n|\r|\n"), lambda x: ~F.trim(x).rlike(TRANSCRIPT_HEADER))
    body = _stripped(F.array_join(lines, "\n"))
    before = F.get(F.split(body, TRANSCRIPT_START, 2), F.lit(0))
    announced = F.when(body.rlike(TRANSCRIPT_START), F.substring(body, F.length(before) + 1, F.length(body))).otherwise(body)
    return without_protocol(announced)


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility characters (ligatures, wide forms) as plain ones."""
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def looks_translated(source, target) -> Column:
    """Not empty, not the same text, and of a plausible length."""
    s, t = F.length(F.trim(col(source))), F.length(F.trim(col(target)))
    return (t > 0) & (col(source) != col(target)) & (t * 4 >= s) & (t <= s * 4 + 40)


def _objects(text: str):
    """JSON objects in a text, fenced or bare, from left to right."""
    decoder, at = json.JSONDecoder(), 0
    while (at := text.find("{", at)) >= 0:
        try:
            value, end = decoder.raw_decode(text, at)
        except ValueError:
            at += 1
            continue
        if isinstance(value, dict):
            yield value
        at = end


def merge_objects(text: str | None) -> str | None:
    """One object from all objects of an answer: lists are joined, of other values the first counts. None without any."""
    found = list(_objects(re.sub(r"```(?:json)?", " ", text or "")))
    if not found:
        return None
    out: dict = {}
    for obj in found:
        for k, v in obj.items():
            if isinstance(v, list) and isinstance(out.get(k), list):
                out[k] = out[k] + v
            else:
                out.setdefault(k, v)
    return json.dumps(out, ensure_ascii=False)


@F.pandas_udf(StringType())
def lenient_json(texts: pd.Series) -> pd.Series:
    return texts.map(merge_objects)
