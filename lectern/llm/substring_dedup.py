"""Substring deduplication with difference-cover anchors, on words.

A window is `WINDOW` consecutive words; a word goes if a window over it also starts earlier. The positions that
are 0, 1, 3 or 9 modulo 13 form a difference cover: for any two places in two documents some shift below 13
takes both to cover positions. So two equal windows of 20 words share an anchor, the 8 words at a cover position of
both, at the same distance from their starts. Only anchors are hashed first (4 of 13 places); those that occur
once settle every window that holds no other. Anchors that recur are then extended: each window of 20 words around
them is hashed to 96 bits, and its first place is found.

Blocks and buckets exchange distinct hashes only (see blocks), so a passage that stands in a third of all
documents costs what its length costs in each block.

Defined results: order is by doc_id, nulls first, then by text among rows of one doc_id, which count as documents of their own;
of rows that are equal in both any one comes first, and the others lose what it has. Null and empty texts have no words. An empty
table gives no rows. Texts of any length are taken whole; one text's words and hashes, about 40 bytes for each of its bytes, must
fit into a task. Other columns are passed through whatever their names; columns with the operator's own names are replaced.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks as B
from . import common
from . import kernel as K

OUTPUT = ("n_words", "removed", "kept_text")
WINDOW = 20
#: A perfect difference cover: every number below 13 is a difference of two of these, modulo 13.
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR_BYTES = 6


def ordered(table: pa.Table, doc_id: str, text: str) -> pa.Table:
    return table.take(pc.sort_indices(table.select([doc_id, text]), sort_keys=[(doc_id, "ascending"), (text, "ascending")], null_placement="at_start"))


class _Block:
    """Anchors and windows of a block's documents, in document order."""

    def __init__(self, table: pa.Table, doc_id: str, text: str, window: int):
        self.table, self.window = ordered(table, doc_id, text), window
        self.width = window - PERIOD + 1
        self.slices = [s for b in self.table.select([text]).combine_chunks().to_batches() for s in K.slices(b, text)]
        self.text = text

    def words(self):
        for s in self.slices:
            yield K.Words(s[self.text])

    def anchors(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Hash of every anchor, and the anchors' places in each slice."""
        on = np.zeros(PERIOD, bool)
        on[list(COVER)] = True
        found, places = [np.zeros(0, np.uint64)], []
        for w in self.words():
            inside = np.arange(len(w.start)) - np.repeat(w.ptr[:-1], w.counts)
            at = np.flatnonzero(on[inside % PERIOD] & w.room(self.width))
            found.append(K.window_hash(K.prefix_sums(w.hash), self.width)[at])
            places.append(at)
        return np.concatenate(found), places

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Distinct anchor keys, which of them the block itself repeats, each anchor's key, places."""
        hashes, places = self.anchors()
        hashes &= ~np.uint64((1 << (64 - 8 * ANCHOR_BYTES)) - 1)
        keys, inverse, count = np.unique(hashes, return_inverse=True, return_counts=True)
        return keys, count > 1, inverse, places

    def windows(self, heard: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Two hashes of every window around a recurring anchor, and the windows' places in each slice."""
        keys, own, inverse, places = self.keys()
        again = (own | B.unbits(heard))[inverse] if len(keys) else np.zeros(0, bool)
        first, second, out, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [], 0
        for w, anchors in zip(self.words(), places):
            hit = anchors[again[at : at + len(anchors)]]
            at += len(anchors)
            near = K.covered(len(w.start), np.maximum(hit - PERIOD + 1, 0), hit + 1) & w.room(self.window)
            start = np.flatnonzero(near)
            out.append(start)
            if len(start):
                first.append(K.window_hash(K.prefix_sums(w.hash), self.window)[start])
                second.append(K.window_hash(K.prefix_sums(K.mix(w.hash ^ K.U64(0xD6E8FEB86659FD93))), self.window)[start])
        return np.concatenate(first), np.concatenate(second), out


def substring_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with n_words, removed (first and last word of each removed run, flat) and kept_text (kept words joined by a space)."""
    if window < PERIOD:
        raise ValueError(f"a window has {PERIOD} words at least")
    c = common.Columns(docs, OUTPUT, doc_id=doc_id, text=text)
    n_blocks, n_buckets = B.counts(c.frame, "text")
    keep, base, ex = c.frame.columns, B.with_blocks(c.frame, "doc_id", n_blocks), B.Exchange(n_blocks, n_buckets)

    def say_anchors(block, table):
        keys, _, _, _ = _Block(table, "doc_id", "text", window).keys()
        for bucket, a, b in B.cut(keys, n_buckets):
            yield bucket, B.pack(keys[a:b], ANCHOR_BYTES)

    def say_windows(block, table, heard):
        first, second, _ = _Block(table, "doc_id", "text", window).windows(heard.get(0, []))
        keys, index = np.unique(first, return_index=True)
        check = (second[index] >> K.U64(32)).astype("<u4")
        for bucket, a, b in B.cut(keys, n_buckets):
            yield bucket, keys[a:b].astype("<u8").tobytes() + check[a:b].tobytes()

    def reply_earlier(said):
        """Which of a block's windows an earlier block has."""
        sizes = [len(data) // 12 for _, data in said]
        keys = np.concatenate([np.frombuffer(data, "<u8", n) for (_, data), n in zip(said, sizes)])
        check = np.concatenate([np.frombuffer(data, "<u4", n, 8 * n) for (_, data), n in zip(said, sizes)])
        order = np.lexsort((check, keys))  # stable: earlier blocks first
        k, c = keys[order], check[order]
        later = np.zeros(len(keys), bool)
        later[order[1:]] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
        at = 0
        for (block, _), n in zip(said, sizes):
            yield block, B.bits(later[at : at + n])
            at += n

    def remove(block, table, heard):
        b = _Block(table, "doc_id", "text", window)
        first, _, places = b.windows(heard.get(0, []))
        keys, index, inverse = np.unique(first, return_index=True, return_inverse=True)
        gone = np.ones(len(first), bool)
        gone[index] = False  # the first of the block stays
        if len(keys):
            gone |= B.unbits(heard.get(1, []))[inverse]
        counts, spans, kept, at = [], [], [], 0
        for w, start, part in zip(b.words(), places, b.slices):
            s = start[gone[at : at + len(start)]]
            at += len(start)
            n = len(w.start)
            off = K.covered(n, s, s + window)
            counts.append(w.counts)
            owner = w.owner()
            edge = np.concatenate(([False], off, [False]))
            fence = np.zeros(n + 1, bool)
            fence[w.ptr] = True
            begin = np.flatnonzero(off & (~edge[:-2] | fence[:-1]))
            end = np.flatnonzero(off & (~edge[2:] | fence[1:]))
            of = owner[begin]
            flat = np.stack([begin - w.ptr[of], end - w.ptr[of]], axis=1).astype(np.int32).reshape(-1)
            offsets = np.concatenate(([0], np.cumsum(2 * np.bincount(of, minlength=part.num_rows)))).astype(np.int32)
            spans.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
            any_off = K.per_text(off, w.ptr)
            on = ~off
            raw = w.buf.tobytes()
            for d in range(part.num_rows):
                words = raw[w.offsets[d] : w.offsets[d + 1]].split()
                kept.append(b" ".join(compress(words, on[w.ptr[d] : w.ptr[d + 1]].tolist()) if any_off[d] else words).decode())
        out = b.table.select(keep)
        out = out.append_column("n_words", pa.array(np.concatenate(counts), pa.int64()))
        out = out.append_column("removed", pa.chunked_array(spans, pa.list_(pa.int32())))
        return out.append_column("kept_text", pa.array(kept, pa.string()))

    anchors = ex.answer(ex.send(base, say_anchors), B.reply_repeated(ANCHOR_BYTES), 0)
    windows = ex.answer(ex.send_again(base, anchors, say_windows), reply_earlier, 1)
    schema = T.StructType([*base.drop(B.BLOCK).schema.fields, T.StructField("n_words", T.LongType()), T.StructField("removed", T.ArrayType(T.IntegerType())), T.StructField("kept_text", T.StringType())])
    return c.result(ex.finish(base, anchors.unionByName(windows), remove, schema))


def n_removed(spans: str = "removed"):
    """Words in the removed runs."""
    c = F.col(spans)
    pairs = F.when(F.size(c) > 0, F.sequence(F.lit(0), F.size(c) - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda a, i: a + F.get(c, i + 1) - F.get(c, i) + 1)
