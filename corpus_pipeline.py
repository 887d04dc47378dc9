"""The corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and works on what the one before kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, common, decontamination, near_dedup, quality_rules, suffix_dedup
from lectern.llm.queries import TOKENIZER_RANKS


NEAR_PERCENT = 80  # op8_near_dedup has its own, higher limit


def _through(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """work(docs) with the columns of docs. Meanwhile all but doc_id and text have names of their own, so that none clashes with an operator's."""
    inner = [f"p{i}" for i in range(len(docs.columns))]
    for name in ("doc_id", "text"):
        inner[common.place(docs.columns, name)] = name
    return work(docs.toDF(*inner)).select(*inner).toDF(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts among them. Repeated rows are judged alike; ids may be null."""
    return _through(docs, lambda d: quality_rules.quality_rules(d).where("kept"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8 or more) stays, that with the least doc_id.

    Rows that share a doc_id are one document and stay or go together; a null doc_id is the least. Documents without words stay.
    """
    return _through(docs, lambda d: near_dedup.near_groups(d, percent=NEAR_PERCENT).where("kept"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that an earlier document has go; a character goes if all its bytes do. n_chars (if there is one) is counted anew.

    Documents of which nothing is left go; those that were null or empty before stay. Rows of one doc_id take nothing from each other.
    """
    at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(d: DataFrame) -> DataFrame:
        found = suffix_dedup.suffix_dedup(d, as_text=True).where((F.size("removed") == 0) | (F.length("kept") > 0))
        new = {"text": F.col("kept")}
        if at is not None:
            new[f"p{at}"] = F.when(F.size("removed") > 0, F.length("kept")).otherwise(F.col(f"p{at}")).cast(docs.schema[at].dataType)
        return found.withColumns(new)

    return _through(docs, cut)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; without benchmark items all stay."""
    benchmark = common.table(spark, sf_dir, "benchmark")
    return _through(docs, lambda d: decontamination.find_contamination(d, benchmark).where(F.size("hit_words") == 0))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of what they decode to; one row for each row, null texts being empty."""
    import public_tokenizers

    return bpe.token_digests(docs, public_tokenizers.path(TOKENIZER_RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("tokens", tokens),
]

#: The last stage encodes with a vocabulary file, which SQL cannot; tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
