"""Blocks of documents and messages between blocks and hash buckets.

Documents are cut into blocks, each a range of doc_ids, so that the order of blocks is the order of documents.
A block boils what it has to say down to arrays that hold every distinct key once, cuts them by key range and
sends each part to a bucket; a bucket answers every block about its keys, in the order in which they came.
However often a key occurs, a block mentions it once: hot keys weigh as much as there are blocks.

With N blocks and buckets there are N * N messages. Beyond `DIRECT` of them on a side, neighbouring buckets (and neighbouring blocks) form
groups of about sqrt(N): a block sends one envelope to each group of buckets, a relay for each pair of groups sorts what is
in the envelopes, and so back. That makes N * sqrt(N) messages each way, of many keys each.

All sides are groups of bounded size (see common.block_count), and every step is a function of a block's rows,
so that a lost executor's work is simply done again. Rows that share a doc_id (or have none) are in one block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from . import common, kernel

BLOCK = "_block"
#: Blocks or buckets from which messages go through relays; cuts of doc_ids that the driver holds.
DIRECT, COARSE = 4096, 1024


def with_blocks(docs: DataFrame, doc_id: str, blocks: int) -> DataFrame:
    """docs with the number of the doc_id range each row falls in (null ids: the first).

    The driver sees COARSE cuts at most; finer ones are a small table that is joined.
    """
    coarse = min(blocks, COARSE)
    cuts: list = []
    if coarse > 1:
        share = [k / coarse for k in range(1, coarse)]
        got = docs.agg(F.percentile_approx(doc_id, share, max(10_000, 20 * coarse)).alias("q")).first()["q"]
        cuts = sorted(set(got or []))
    if not cuts:
        return docs.withColumn(BLOCK, F.lit(0))
    at = _how_many(F.lit(cuts), F.lit(len(cuts)), F.col(doc_id), len(cuts))
    if blocks <= COARSE:
        return docs.withColumn(BLOCK, at)
    fine = -(-blocks // coarse)
    share = [k / fine for k in range(1, fine)]
    inner = docs.select(at.alias("_coarse"), F.col(doc_id).alias("_id")).groupBy("_coarse").agg(F.percentile_approx("_id", share, max(1_000, 20 * fine)).alias("_cuts"))
    inner = common.written(inner.select("_coarse", F.array_distinct(F.coalesce("_cuts", F.array().cast(inner.schema["_cuts"].dataType))).alias("_cuts")), "cuts")
    both = docs.withColumn("_coarse", at).join(F.broadcast(inner), "_coarse")  # COARSE rows of 8 bytes for each block
    inside = _how_many(F.col("_cuts"), F.size("_cuts"), F.col(doc_id), fine)
    return both.withColumn(BLOCK, (F.col("_coarse") * fine + inside).cast("int")).select(*docs.columns, BLOCK)


def _how_many(bounds: Column, n: Column, value: Column, most: int) -> Column:
    """How many of the n ascending bounds (at most `most`) are at most value, by halving."""
    steps = [1 << k for k in range(max(most, 1).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, s: F.when((at + s <= n) & (F.get(bounds, at + s - 1) <= value), at + s).otherwise(at),
    )


def counts(docs: DataFrame, text: str) -> tuple[int, int]:
    """Numbers of blocks and buckets."""
    n = common.block_count(docs, text)
    return n, n


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The range of 64-bit values a hash lies in; ascending with the hash."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def cut(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the parts of a sorted array."""
    of = bucket_of(hashes, buckets)
    edge = np.flatnonzero(np.diff(of, prepend=-1))
    return list(zip(of[edge].tolist(), edge.tolist(), [*edge[1:].tolist(), len(of)]))


def envelope(parts: list[tuple[int, int, bytes]]) -> bytes:
    """Several (bucket, block, data) as one value."""
    numbers = np.array([(bucket, block, len(data)) for bucket, block, data in parts], "<i8")
    return np.int64(len(parts)).tobytes() + numbers.tobytes() + b"".join(data for _, _, data in parts)


def opened(data: bytes) -> list[tuple[int, int, bytes]]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    out, at = [], 8 + 24 * n
    for bucket, block, size in np.frombuffer(data, "<i8", 3 * n, 8).reshape(n, 3).tolist():
        out.append((bucket, block, data[at : at + size]))
        at += size
    return out


_ROW = "to int, bucket int, block int, kind int, data binary"


def _table(rows: list[tuple[int, int, int, int, bytes]]) -> pa.Table:
    columns = zip(*rows) if rows else ((),) * 5
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("to", "bucket", "block", "kind", "data"), columns, (pa.int32(),) * 4 + (pa.binary(),))})


def _rows(table: pa.Table) -> list[tuple[int, int, bytes]]:
    """The (bucket, block, data) of all messages, envelopes opened."""
    out = []
    for bucket, block, data in zip(table["bucket"].to_pylist(), table["block"].to_pylist(), table["data"].to_pylist()):
        if bucket < 0 or block < 0:
            out += opened(data)
        else:
            out.append((bucket, block, data))
    return out


def _grouped(parts, key) -> list[tuple]:
    found: dict = {}
    for part in parts:
        found.setdefault(key(part), []).append(part)
    return sorted(found.items())


class Exchange:
    """Messages between so many blocks and buckets, and answers to them.

    A row's `to` is the bucket, block or relay that gets it; a row with a negative bucket or block holds an envelope.
    """

    def __init__(self, blocks: int, buckets: int):
        self.relayed = max(blocks, buckets) > DIRECT
        self.block_group, self.bucket_group = (math.isqrt(n - 1) + 1 if n > 1 else 1 for n in (blocks, buckets))
        self.bucket_groups = -(-buckets // self.bucket_group)

    def _relay_of(self, bucket: int, block: int) -> int:
        return block // self.block_group * self.bucket_groups + bucket // self.bucket_group

    def _said(self, block: int, pairs) -> pa.Table:
        """What a block says, as rows for buckets or relays."""
        if not self.relayed:
            return _table([(bucket, bucket, block, 0, data) for bucket, data in pairs])
        parts = _grouped(((bucket, block, data) for bucket, data in pairs), lambda p: self._relay_of(p[0], p[1]))
        return _table([(relay, -1, block, 0, envelope(x)) for relay, x in parts])

    def _relayed(self, messages: DataFrame, onward) -> DataFrame:
        """Envelopes opened, and closed again for the next receiver: onward(part) names it."""
        if not self.relayed:
            return messages

        def run(key, table):
            kind = table["kind"][0].as_py()
            out = _table([(to, -1, -1, kind, envelope(x)) for to, x in _grouped(_rows(table), onward)])
            kernel.release()
            return out

        return messages.groupBy("to", "kind").applyInArrow(run, _ROW)

    def send(self, base: DataFrame, talk) -> DataFrame:
        """Messages of every block; talk(block, table) gives (bucket, data) pairs."""

        def run(key, table):
            block = key[0].as_py()
            out = self._said(block, talk(block, table))
            kernel.release()
            return out

        return self._relayed(base.groupBy(BLOCK).applyInArrow(run, _ROW), lambda part: part[0])

    def send_again(self, base: DataFrame, answers: DataFrame, talk) -> DataFrame:
        """Messages of every block that has heard answers; talk(block, table, answers by kind)."""

        def run(key, table, heard):
            if not table.num_rows:
                return _table([])
            block = key[0].as_py()
            out = self._said(block, talk(block, table, by_kind(heard)))
            kernel.release()
            return out

        return self._relayed(base.groupBy(BLOCK).cogroup(answers.groupBy("to")).applyInArrow(run, _ROW), lambda part: part[0])

    def answer(self, messages: DataFrame, reply, kind: int = 0) -> DataFrame:
        """Each bucket's answers; reply([(block, data), ...]) gives (block, data) pairs. kind numbers the round."""

        def run(key, table):
            bucket = key[0].as_py()
            said = sorted((block, data) for _, block, data in _rows(table))
            if self.relayed:
                parts = _grouped(((bucket, block, data) for block, data in reply(said)), lambda p: self._relay_of(p[0], p[1]))
                out = _table([(relay, bucket, -1, kind, envelope(x)) for relay, x in parts])
            else:
                out = _table([(block, bucket, block, kind, data) for block, data in reply(said)])
            kernel.release()
            return out

        return self._relayed(messages.groupBy("to").applyInArrow(run, _ROW), lambda part: part[1])

    def finish(self, base: DataFrame, answers: DataFrame, work, schema) -> DataFrame:
        """The rows of every block after the last answers; work(block, table, answers by kind) gives a table."""
        arrow_schema = to_arrow_schema(schema)

        def run(key, table, heard):
            if not table.num_rows:
                return pa.table({f.name: pa.array([], f.type) for f in arrow_schema})
            out = work(key[0].as_py(), table, by_kind(heard))
            kernel.release()
            return out

        return base.groupBy(BLOCK).cogroup(answers.groupBy("to")).applyInArrow(run, schema)


def by_kind(heard: pa.Table) -> dict[int, list[bytes]]:
    """Answers in bucket order, by kind."""
    out: dict[int, list[bytes]] = {}
    for kind in sorted(set(heard["kind"].to_pylist())):
        mine = heard.filter(pc.equal(heard["kind"], kind))
        out[kind] = [data for _, _, data in sorted(_rows(mine), key=lambda x: x[0])]
    return out


# --- Replies that several operators use: fixed-width keys, answered by bits --------------------------------


def pack(hashes: np.ndarray, width: int) -> bytes:
    """The upper width bytes of each hash."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, 8 - width :] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").reshape(-1).astype(np.uint64)


def bits(flags: np.ndarray) -> bytes:
    return np.int32(len(flags)).tobytes() + np.packbits(flags).tobytes()


def unbits(parts: list[bytes]) -> np.ndarray:
    """The flags of all parts, one after another."""
    out = [np.unpackbits(np.frombuffer(p, np.uint8)[4:], count=int(np.frombuffer(p[:4], np.int32)[0])).astype(bool) for p in parts]
    return np.concatenate(out) if out else np.zeros(0, bool)


def reply_repeated(width: int):
    """Each block hears which of its (distinct) keys another block has, too."""

    def reply(said):
        keys = [unpack(data, width) for _, data in said]
        every = np.sort(np.concatenate(keys))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        for (block, _), k in zip(said, keys):
            at = np.searchsorted(twice, k)
            yield block, bits((at < len(twice)) & (twice[np.minimum(at, len(twice) - 1)] == k) if len(twice) else np.zeros(len(k), bool))

    return reply
