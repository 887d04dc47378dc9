"""Alert simulation: sliding word windows, keyword hits, cooldown, e-mails and projections.

Times are whole word units (hop words; seconds times words per minute / 60), so both engines agree exactly. Speeches of a day
follow each other by (day, slug); a speech without words has no window but still takes its gap. A simulation reads each text once: what
its windows hold, and what time it takes, is stored in a shared folder for the steps that follow.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import stored
from .cooldown import take_with_cooldown


@dataclass(frozen=True)
class AlertConfig:
    """Keyword groups and timing. As in the configuration files, a zero stands for the default."""

    groups: dict[str, tuple[str, ...]]
    cooldown_seconds: float = 120
    chunk_seconds: float = 20
    overlap_seconds: float = 4
    words_per_minute: float = 140
    gap_seconds: float = 90
    strict: bool = False
    defaults: dict[str, float] = field(default_factory=lambda: {"cooldown_seconds": 120, "chunk_seconds": 20, "overlap_seconds": 4, "words_per_minute": 140, "gap_seconds": 90})

    def __post_init__(self):
        if not self.strict:
            for name, value in self.defaults.items():
                if not getattr(self, name):
                    object.__setattr__(self, name, value)
        if not self.keywords:
            raise ValueError("no keywords")

    @property
    def keywords(self) -> list[str]:
        """In configuration order, the first spelling of each."""
        seen: dict[str, str] = {}
        for words in self.groups.values():
            for w in words:
                if not w.strip():
                    raise ValueError("an empty keyword")
                seen.setdefault(w.casefold(), w)
        return list(seen.values())

    def group_of(self, keyword: str) -> str:
        """The first group that has the keyword."""
        return next(g for g, words in self.groups.items() if keyword.casefold() in {w.casefold() for w in words})

    def without(self, *keywords: str) -> AlertConfig:
        """The same without some keywords; groups that become empty go."""
        gone = {k.casefold() for k in keywords}
        left = {g: tuple(w for w in words if w.casefold() not in gone) for g, words in self.groups.items()}
        return AlertConfig({g: w for g, w in left.items() if w}, self.cooldown_seconds, self.chunk_seconds, self.overlap_seconds, self.words_per_minute, self.gap_seconds, self.strict)

    def _units(self, seconds: float) -> int:
        return round(seconds * self.words_per_minute / 60)  # half to even

    @property
    def window(self) -> int:
        return max(1, self._units(self.chunk_seconds))

    @property
    def hop(self) -> int:
        overlap = min(self.window - 1, max(0, self._units(self.overlap_seconds)))
        return max(1, self.window - overlap)

    @property
    def gap(self) -> int:
        return ceil(self.gap_seconds * self.words_per_minute / 60)

    @property
    def cooldown(self) -> int:
        return ceil(self.cooldown_seconds * self.words_per_minute / 60)


def english_only(speeches: DataFrame, language: str = "language") -> DataFrame:
    return speeches.where(F.col(language) == "en")


def _chunked(speeches: DataFrame, window: int, hop: int, least: int) -> DataFrame:
    """The columns of word_windows and n_chunks; `least` rows for a speech without words, whose text is then empty."""
    w = F.col("_w")
    n = F.when(F.size(w) > 0, 1 + F.ceil(F.greatest(F.size(w) - window, F.lit(0)) / hop)).otherwise(0).cast("int")
    rows = speeches.withColumn("_w", T.words("text")).withColumn("n_chunks", n)
    many = F.greatest(F.col("n_chunks"), F.lit(least))
    rows = rows.withColumn("chunk", F.explode(F.when(many > 0, F.sequence(F.lit(0), many - 1)).otherwise(F.array().cast("array<int>"))))
    return rows.withColumn("chunk_text", F.array_join(F.slice(w, F.col("chunk") * hop + 1, F.lit(window)), " ")).drop("_w", "text")


def word_windows(speeches: DataFrame, window: int, hop: int) -> DataFrame:
    """One row for each window of a speech: chunk (from 0) and its text. The window that reaches the end is the last."""
    return _chunked(speeches, window, hop, 0).drop("n_chunks")


def _counts(config: AlertConfig):
    """array of struct keyword, hits: the keywords that stand in chunk_text."""
    counts = F.array(*[F.struct(F.lit(k).alias("keyword"), T.keyword_count("chunk_text", k).alias("hits")) for k in config.keywords])
    return F.filter(counts, lambda x: x["hits"] > 0)


def scanned(speeches: DataFrame, config: AlertConfig) -> DataFrame:
    """day, slug, chunk, n_chunks and counts (array of struct keyword, hits) of each window with a keyword and of each speech's chunk 0, in one pass over the texts."""
    chunks = _chunked(speeches.select("day", "slug", "text"), config.window, config.hop, 1)
    found = chunks.where(F.col("chunk_text").rlike(T.any_keyword(config.keywords)) | (F.col("chunk") == 0))
    return found.select("day", "slug", "chunk", "n_chunks", _counts(config).alias("counts"))


def speech_starts(sizes: DataFrame, config: AlertConfig, prefix: int = 9) -> DataFrame:
    """day, slug and the time at which each speech starts, from day, slug and n_chunks.

    A running sum would put a day into one task, so sums of slices of a day's slugs are formed first: the slice sums of a day are few,
    and each slice, the slugs with one prefix, is ordered on its own.
    """
    takes = F.col("n_chunks").cast("long") * config.hop + config.gap
    rows = sizes.select("day", "slug", takes.alias("_takes")).withColumn("_part", F.substring("slug", 1, prefix))
    parts = rows.groupBy("day", "_part").agg(F.sum("_takes").alias("_sum"))
    before = Window.partitionBy("day").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("day", "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("day", "_part").orderBy("slug").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_takes").over(inside), F.lit(0)))
    return rows.join(parts, ["day", "_part"]).select("day", "slug", (F.col("_before") + F.col("_inside")).cast("long").alias("start"))


def window_hits(speeches: DataFrame, config: AlertConfig) -> DataFrame:
    """day, slug, chunk, keyword and hits (at least one) of every window. Windows without any keyword are passed over by one test."""
    chunks = word_windows(speeches.select("day", "slug", "text"), config.window, config.hop)
    found = chunks.where(F.col("chunk_text").rlike(T.any_keyword(config.keywords)))
    return found.select("day", "slug", "chunk", F.inline(_counts(config)))


def simulate(speeches: DataFrame, config: AlertConfig) -> dict[str, DataFrame]:
    """hits and picks: the windows' keyword hits with their times, and (day, keyword, t) of those that pass the cooldown."""
    found = stored(scanned(speeches, config))
    starts = speech_starts(found.where("chunk = 0"), config)
    hits = found.where(F.size("counts") > 0).join(starts, ["day", "slug"]).select("day", "slug", "chunk", F.inline("counts"), "start")
    hits = hits.withColumn("t", F.col("start") + F.col("chunk") * config.hop).drop("start")
    return {"hits": hits, "picks": take_with_cooldown(hits, ["day", "keyword"], "t", config.cooldown)}


def hits_by(hits: DataFrame, *by: str) -> DataFrame:
    return hits.groupBy(*by).agg(F.sum("hits").cast("long").alias("hits"))


def emails_by_day(picks: DataFrame) -> DataFrame:
    """An e-mail is a window with at least one keyword that passed; t names the window within its day."""
    return picks.groupBy("day").agg(F.countDistinct("t").alias("emails"))


def emails_by_keyword_day(picks: DataFrame) -> DataFrame:
    return picks.groupBy("keyword", "day").agg(F.count(F.lit(1)).alias("emails"))


def emails_by_group(picks: DataFrame, config: AlertConfig) -> DataFrame:
    """A group counts once for each e-mail."""
    names = F.create_map(*[x for k in config.keywords for x in (F.lit(k), F.lit(config.group_of(k)))])
    return picks.withColumn("group", names[F.col("keyword")]).select("group", "day", "t").distinct().groupBy("group").agg(F.count(F.lit(1)).alias("emails"))


def keyword_matrix(picks: DataFrame, config: AlertConfig, days: list[str]) -> DataFrame:
    """Keyword by day with totals; every keyword has a row."""
    spark = picks.sparkSession
    names = spark.createDataFrame([(i, k) for i, k in enumerate(config.keywords)], "position int, keyword string")
    wide = picks.groupBy("keyword").pivot("day", days).count()
    full = names.join(F.broadcast(wide), "keyword", "left").na.fill(0)
    return full.withColumn("total", sum((F.col(f"`{d}`") for d in days), F.lit(0)).cast("long"))


def projection(speeches: DataFrame, picks: DataFrame, expected: DataFrame) -> DataFrame:
    """day, analysed, expected, emails, coverage, sample_ok and projected for observed and expected days.

    A day with enough speeches is scaled up by its own count, others by the rate over all days.
    """
    analysed = speeches.groupBy("day").agg(F.count(F.lit(1)).alias("analysed"))
    days = analysed.join(expected, "day", "full").join(emails_by_day(picks), "day", "left").na.fill(0, ["analysed", "expected", "emails"])
    every = Window.partitionBy(F.lit(0))  # one row for each day
    d = days.withColumn("rate", F.coalesce(F.sum("emails").over(every) / F.nullif(F.sum("analysed").over(every), F.lit(0)), F.lit(0.0)))
    d = d.withColumn("coverage", F.when(F.col("expected") > 0, F.col("analysed") / F.col("expected")).otherwise(0.0))
    d = d.withColumn("sample_ok", (F.col("analysed") >= 8) | (F.col("coverage") >= 0.4))
    own = F.col("emails") * F.col("expected") / F.nullif(F.col("analysed"), F.lit(0))
    p = F.when(
        (F.col("expected") > 0) & (F.col("rate") > 0),
        F.when(F.col("sample_ok") & (F.col("analysed") > 0), own).otherwise(F.col("rate") * F.col("expected")),
    ).when((F.col("analysed") > 0) & (F.col("expected") > 0), own)
    return d.withColumn("projected", p).drop("rate")


def spread(projected: DataFrame) -> DataFrame:
    """Least, greatest and middle projection."""
    return projected.agg(F.min("projected").alias("least"), F.max("projected").alias("greatest"), F.median("projected").alias("middle"))
