"""Quality rules as one Spark projection.

A table of thresholds (`RULES`) is compiled into a single `select`: text statistics from built-in
functions, then one boolean for each rule and their conjunction. No user function runs, nothing shuffles.

Defined results: a null text has no words, so its counts are 0 and it fails the base rule; the same holds
for an empty text. Null ids and repeated rows pass through untouched, each row is judged on its own; an empty table gives
an empty result with the same columns. Texts of any length are measured whole, as arrays of their words and of a hash and
a place for each 3-word window, in memory of the task. Other columns are passed through whatever their names; columns with the operator's own names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "with", "as", "be", "was", "by", "this", "at"],
    "fr": ["le", "la", "les", "de", "des", "du", "et", "un", "une", "que", "qui", "en", "dans", "est", "pour", "par", "au", "sur"],
    "de": ["der", "die", "das", "und", "den", "in", "zu", "von", "mit", "ist", "des", "auf", "für", "im", "dem", "nicht", "ein", "eine"],
    "es": ["el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "por", "con", "para", "se", "del", "al", "su", "es"],
}


@dataclass(frozen=True)
class Rule:
    """The text passes where low <= measure <= high."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The threshold table. Ratios are per word unless the name says otherwise.
RULES = (
    Rule("length", "n_words", low=50),
    Rule("repeated_words", "repeat_ratio", high=0.5),
    Rule("word_length", "mean_word_chars", low=2.0, high=14.0),
    Rule("symbols", "symbol_ratio", high=0.3),
    Rule("stop_words", "stop_ratio", low=0.01),
    Rule("duplicate_lines", "dup_line_ratio", high=0.5),
)


OUTPUT = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "mean_word_chars",
    "symbol_ratio", "repeat_ratio", "dup_line_ratio", "stop_ratio", "base_failed", "kept",
)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows found twice or more in the text.

    Windows are hashed to 64 bits. Only a text in which some hash recurs goes on: its (hash, place) pairs are
    sorted, pairs equal to a neighbour give the places of recurring windows, and each place adds the words
    up to the next one, three at most.
    """
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    h = F.col("_windows")
    pairs = F.sort_array(F.arrays_zip(h.alias("h"), F.sequence(F.lit(0), F.size(h) - 1).alias("p")))
    p = F.col("_pairs")
    recurring = F.filter(p, lambda x, i: (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"]))
    return hashes, pairs, recurring, n


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the base counts and the measures that RULES names; helper columns start with an underscore."""
    t = F.coalesce(F.col(text), F.lit(""))
    hashes, pairs, recurring, n = _repeat_words(F.col("_words"))
    lines = F.filter(F.split(F.col("_text"), "\n", -1), lambda line: F.length(F.translate(line, SPACE_CHARS, "")) > 0)
    stop = sorted({w for words in STOP_WORDS.values() for w in words})
    step = (
        docs.withColumn("_text", t)
        .withColumn("_bare", F.translate(F.col("_text"), SPACE_CHARS, ""))
        .withColumn("_words", F.when(F.length("_bare") > 0, F.split(F.trim(F.col("_text"), F.lit(SPACE_CHARS)), SPACE, -1)).otherwise(F.array().cast("array<string>")))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length("_bare").cast("long"))
        .withColumn("n_symbols", (F.length("_bare") - F.length(F.translate(F.col("_bare"), SYMBOLS, ""))).cast("long"))
        .withColumn("_lines", lines)
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("_windows", F.when(n >= 3, hashes))
        .withColumn("_pairs", F.when(F.size("_windows") > F.size(F.array_distinct("_windows")), pairs))
        .withColumn("_places", F.when(F.col("_pairs").isNotNull(), F.sort_array(F.transform(recurring, lambda x: x["p"]))))
    )
    places = F.col("_places")
    span = F.aggregate(
        places,
        F.struct(F.lit(0).alias("sum"), F.lit(-3).alias("last")),
        lambda a, q: F.struct((a["sum"] + F.least(F.lit(3), q - a["last"])).alias("sum"), q.alias("last")),
        lambda a: a["sum"],
    )
    return (
        step.withColumn("n_repeat_words", F.coalesce(span, F.lit(0)).cast("long"))
        .withColumn("_n", F.greatest(F.col("n_words"), F.lit(1)).cast("double"))
        .withColumn("mean_word_chars", F.col("word_chars") / F.col("_n"))
        .withColumn("symbol_ratio", F.col("n_symbols") / F.col("_n"))
        .withColumn("repeat_ratio", F.col("n_repeat_words") / F.col("_n"))
        .withColumn("dup_line_ratio", F.col("n_dup_lines") / F.greatest(F.size("_lines"), F.lit(1)))
        .withColumn("stop_ratio", F.size(F.filter(F.slice("_words", 1, 2_147_483_647), lambda w: F.lower(w).isin(stop))) / F.col("_n"))
    )


def verdict(rules=RULES) -> Column:
    """The table of thresholds as one boolean expression."""
    passed = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            passed = passed & (F.col(rule.measure) >= F.lit(rule.low))
        if rule.high is not None:
            passed = passed & (F.col(rule.measure) <= F.lit(rule.high))
    return passed


def quality_rules(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The columns of docs (those with the operator's own names replaced), the counts, base_failed and kept."""
    c = common.Columns(docs, OUTPUT, text=text)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = measured(c.frame).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
    # One row from one struct: a later filter on kept stays above it, and is not rewritten in terms of the text.
    return c.result(out.select(*c.frame.columns, F.inline(F.array(F.struct(*OUTPUT)))))
