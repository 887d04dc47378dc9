"""Writers: day snapshots, journals, CSV exports and merged text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def write_days(df: DataFrame, path: str, *by: str) -> None:
    """Replaces only the partitions that df holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*(by or ("session", "day"))).parquet(path)


def day_documents(df: DataFrame, key: list[str], name: str = "hits") -> DataFrame:
    """One JSON document for each key with its rows in an array (snapshots of one day)."""
    body = F.sort_array(F.collect_list(F.struct(*[c for c in df.columns if c not in key])))
    return df.groupBy(*key).agg(F.to_json(F.struct(*key, body.alias(name))).alias("value"))


def append_csv(df: DataFrame, path: str) -> None:
    """Line breaks inside strings become ` | `."""
    flat = [T.flat_lines(c).alias(c) if k == "string" else F.col(f"`{c}`") for c, k in df.dtypes]
    df.select(*flat).write.mode("append").option("header", True).csv(path)


def append_journal(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def journal_batches(path: str, key: list[str]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: a batch that runs again overwrites its own folder, so each row is there once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(key).write.mode("overwrite").json(f"{path}/batch={number}")

    return write


def merged_text(speeches: DataFrame, order: list[str]) -> DataFrame:
    """A session's texts joined by blank lines, in order (one session is one document by contract)."""
    parts = F.array_sort(F.collect_list(F.struct(*order, "text")))
    return speeches.groupBy("session").agg(F.concat(F.array_join(F.transform(parts, lambda x: x["text"]), "\n\n"), F.lit("\n")).alias("value"))


def speech_text(df: DataFrame, fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """Speech files with their header, one value for each row; keep: columns that stay beside it."""
    head = F.concat_ws("\n", *[F.concat(F.lit(f"{f}: "), F.coalesce(F.col(f).cast("string"), F.lit(""))) for f in fields])
    return df.select(*(keep or []), F.concat(F.lit("---\n"), head, F.lit("\n---\n\n"), F.col("text"), F.lit("\n")).alias("value"))


def highlight_lines(logs: DataFrame, levels: list[str], markers: list[str]) -> DataFrame:
    marked = F.lit(False)
    for m in markers:
        marked = marked | F.col("message").contains(m)
    return logs.where(F.col("level").isin(levels) | marked)


def write_lines(df: DataFrame, path: str, order: str, line: str) -> None:
    """A small text file (a journal, a list of slugs or speakers) with its lines in order, in place of what was there."""
    df.select(order, line).coalesce(1).sortWithinPartitions(order).select(F.col(line).alias("value")).write.mode("overwrite").text(path)
