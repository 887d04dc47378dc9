"""Bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, limit: int, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """_id, text and label (0 or 1) of at most limit labelled documents where learn holds: those of the least id hashes.

    Only ids and labels are ordered (a top-k); the chosen ids, 16 bytes each and limit of them at most, are broadcast.
    Rows without an id or label are not used; of several labels of one id the greatest counts, of several texts the least.
    """
    known = labels.where(learn).where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    rows = common.Columns(docs, doc_id=doc_id, text=text).only().withColumnRenamed("doc_id", "_id")
    return rows.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
