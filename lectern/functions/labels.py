"""Labels of sources, languages and transformations, prompts and chunks of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

#: Sources whose text is English, marks of prompts that nobody has filled in, prompt sizes from which models cache.
ENGLISH_SOURCES, HEARD_SOURCES = ["pdf_en", "audio_en", "transcript_ai"], ["audio_en", "video"]
STUB_MARKS = ["TODO: pegar el prompt", "PEGAR_PROMPT"]
CACHE_TOKENS = [("haiku-4-5", 4096), ("haiku-4.5", 4096), ("haiku", 2048), ("opus-4-6", 4096), ("opus-4.6", 4096), ("opus-4-5", 4096), ("opus-4.5", 4096), ("opus-4-7", 2048), ("opus-4.7", 2048)]
DEFAULT_CACHE_TOKENS = 1024


def transformation(source: Column, translated: Column) -> Column:
    return F.when(translated | (source == "pdf_other"), "translate").when(source.isin(HEARD_SOURCES), "whisper").otherwise("none")


def file_language(source: Column, lang: Column, filename: Column) -> Column:
    """en for English sources, else the file's own language, else the two letters at the end of its name (`fl` is the floor), else und."""
    named = F.lower(F.regexp_extract(filename, r"(?i)_([a-z]{2})(?:\.pdf|\.mp3)$", 1))
    return F.when(source.isin(ENGLISH_SOURCES), "en").otherwise(F.coalesce(F.nullif(lang, F.lit("")), F.when((named != "") & (named != "fl"), named), F.lit("und")))


def is_stub(prompt) -> Column:
    low = F.lower(col(prompt))
    return F.array_contains(F.array(*[low.contains(m.lower()) for m in STUB_MARKS]), True)


def cache_tokens(model) -> Column:
    """Prompt tokens from which a model caches, by what its name contains."""
    low, out = F.lower(col(model)), F.lit(DEFAULT_CACHE_TOKENS)
    for part, n in reversed(CACHE_TOKENS):
        out = F.when(low.contains(part), n).otherwise(out)
    return out


def user_message(identity: Column, slug: Column, day: Column, text: Column) -> Column:
    """The message for one speech: its identity fields as JSON, then the text."""
    return F.concat(F.lit("Identidad (copiá estos campos tal cual en el JSON):\n"), F.to_json(identity), F.lit("\n\nDISCURSO ("), slug, F.lit(" "), day, F.lit("):\n"), F.trim(text), F.lit("\n"))


def halves(chunk) -> Column:
    """array of one or two parts: a chunk of 800 characters or more is cut behind the last paragraph end, sentence end or space that lies from 400 to 200 behind its middle, else in the middle."""
    c = col(chunk)
    n, mid = F.length(c), F.floor(F.length(c) / 2).cast("int")
    head = F.left(c, mid + 200)
    cut = F.lit(None).cast("int")
    for sep in (" ", ". ", "\n\n"):
        # the last place of the separator that ends within the head, counted from 0
        at = F.length(head) - F.locate(sep[::-1], F.reverse(head)) + 1 - len(sep)
        good = (F.locate(sep[::-1], F.reverse(head)) > 0) & (at >= 400)
        parts = (F.trim(F.left(c, at + len(sep))) != "") & (F.trim(F.substring(c, at + len(sep) + 1, n)) != "")
        cut = F.when(good & parts, at + len(sep)).otherwise(cut)
    cut = F.coalesce(cut, mid)
    return F.when(n < 800, F.array(c)).otherwise(F.array(F.trim(F.left(c, cut)), F.trim(F.substring(c, cut + 1, n))))
