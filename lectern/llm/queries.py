"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, decontamination, language_id, lexical_search, near_dedup, quality_model, quality_rules, spelling, substring_dedup, suffix_dedup, token_files, toxicity, warc

TOKENIZER_RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER_JSON = "byte_bpe_50k.json"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", substring_dedup.n_removed().alias("n_removed"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = common.crc_remainder("doc_id", 4) == 2
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"), ~held_out)
    found = toxicity.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.token_digests(common.table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_RANKS), public_tokenizers.PATTERN)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = common.shared_path(spark, "tokens")
    token_files.write_tokens(common.table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER_JSON))
    return token_files.token_index(spark, path)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = (F.octet_length("text") - F.octet_length("kept")).cast("long")
    return found.select(
        "doc_id",
        "n_bytes",
        F.coalesce(gone, F.lit(0)).alias("n_removed"),
        (F.size("removed") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = common.crc_remainder("doc_id", 3) == 1
    model = quality_model.fit(docs, common.table(spark, sf_dir, "labels"), ~held_out)
    found = quality_model.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_groups(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    packages = warc.write_packages(pages, common.shared_path(spark, "warc"))
    found = warc.read_packages(spark, packages, pages.schema["page_id"].dataType.simpleString())
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.spelling_groups(common.table(spark, sf_dir, "documents"))
    return found.select("word", "n", "n_near", "form", "form_n", "root")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = common.crc_remainder("doc_id", 4) == 2
    model = language_id.fit(docs, ~held_out)
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_toxicity,
        op3_byte_bpe,
        op4_quality_rules,
        op5_token_files,
        op6_suffix_dedup,
        op7_quality_model,
        op8_near_dedup,
        op9_decontamination,
        op10_warc,
        op11_lexical_search,
        op12_spelling_groups,
        op13_language_id,
    )
}
