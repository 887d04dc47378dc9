"""Token ids as ORC files with stripe indexes, Bloom filters on document ids, and stripe-parallel reads.

Ids are encoded with a tokenizer file of the tokenizers library, an end id is appended to each document, and
Spark's ORC writer stores them as integer run lengths in ascending id order: rows are dealt out by ranges of
doc_id and sorted within each file. Row indexes and Bloom filters let a look-up by doc_id skip stripes.
Reading gives each document's place among all ids: ids before the file (a sum over one row per file), then
ids before the document within its file.

Defined results: the string of a special token in a text is that token's single id, as the library has it by default;
a null text is empty and holds the end id alone; null doc_ids come first; documents that share a doc_id (repeated rows, too) are all kept,
in any order among themselves; an empty table gives files without rows, which read as none. Texts of any length are encoded whole;
one text's hashes, about 50 bytes for each of its bytes, must fit into a task. Other columns are not written, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from . import kernel as K
from .bpe import SLICE_BYTES, shared_file
from .stretches import StretchTable

END_ID = 0
ROW_STRIDE = 1000
STRIPE_BYTES = 16 << 20
_tables: dict[bytes, StretchTable] = {}


def _table(content: bytes) -> StretchTable:
    """The process's encoder for a tokenizer file: the library sees each distinct stretch once while it is in the table."""
    key = hashlib.sha256(content).digest()
    if key not in _tables:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(content.decode())
        _tables.clear()
        _tables[key] = StretchTable(lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)], whole=tuple(x.content for x in t.get_added_tokens_decoder().values()))
    return _tables[key]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", files: int | None = None, end_id: int = END_ID) -> None:
    """Encodes every text and writes (doc_id, ids) to ORC files below path, in ascending doc_id order across and within files."""
    rows = common.Columns(docs, doc_id=doc_id, text=text).only()
    n = files or common.block_count(rows, "text")
    data = shared_file(docs.sparkSession, tokenizer)

    def run(batches):
        t = _table(data.value)
        for whole in batches:
            for batch in K.slices(whole, "text", SLICE_BYTES):
                flat, off = t.ids(batch["text"])
                n = batch.num_rows
                ids = np.full(len(flat) + n, end_id, np.int32)
                ids[np.arange(len(flat)) + np.repeat(np.arange(n), np.diff(off))] = flat
                lists = pa.ListArray.from_arrays(pa.array((off + np.arange(n + 1)).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch["doc_id"], lists], names=["doc_id", "ids"])
        K.release()

    schema = rows.select("doc_id", F.array().cast("array<int>").alias("ids")).schema
    dealt = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    (
        dealt.mapInArrow(run, schema)
        .write.option("orc.compress", "ZSTD")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", ROW_STRIDE)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids=None) -> DataFrame:
    """(doc_id, ids); doc_ids: only these, found through row indexes and Bloom filters."""
    rows = spark.read.orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files alone."""

    def run(batches):
        for batch in batches:
            ids = batch["ids"]
            flat, off = np.asarray(ids.values).astype("<u4"), np.asarray(ids.offsets)
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["_file"], pa.array(np.diff(off).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "_file", "n_tokens", "ids_crc32"]
            )

    name = F.col("_metadata.file_name")
    # A writing task's number, then the number of its file; as numbers, since names are padded to five digits only.
    number = lambda pattern: F.coalesce(F.regexp_extract(name, pattern, 1).try_cast("long"), F.lit(0))
    file = (number(r"^part-(\d+)") * (1 << 24) + number(r"-c(\d+)\.")).alias("_file")
    rows = spark.read.orc(path).select("doc_id", file, "ids")
    schema = rows.select("doc_id", "_file", F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("ids_crc32")).schema
    found = common.written(rows.mapInArrow(run, schema), "token-index")  # a few numbers for each document
    # One row for each file.
    files = found.groupBy("_file").agg(F.sum("n_tokens").alias("_ids"))
    files = files.select("_file", (F.sum("_ids").over(Window.orderBy("_file")) - F.col("_ids")).alias("_before"))
    inside = Window.partitionBy("_file").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return found.join(files, "_file").select("doc_id", start.cast("long").alias("start"), "n_tokens", "ids_crc32")
