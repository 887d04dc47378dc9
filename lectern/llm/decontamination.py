"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of `width` consecutive item words (an item with fewer words is one pattern of its
own length). Patterns of one length m form a table: `shift[block]` says how far a search window may move
when its last two words hash to block, and where the shift is 0 the block's bucket lists the patterns that end in it, ordered by a hash of their
first two words. The search runs over many stretches of text at once, each with its own place: stretches
whose shift is positive jump, the others look in their bucket for the patterns that begin like the window, and move by one. Such a pattern is
compared with the window word by word, first by the words' hashes and then by their bytes.

Tables are flat arrays of about 10 bytes for each byte of item text. Items are cut into pieces of `PIECE_WORDS` windows
in tasks, and the pieces into groups of at most `GROUP_BYTES` of text; one group's tables are broadcast at a time.
A larger benchmark becomes several scans in a row; between scans the rows are a written table, so that no process holds
two groups' tables.

Defined results: null texts have no words; items without words have no windows; items with a null id count
under the empty string; repeated items with one id count once; repeated documents each give a row; without documents there are no
rows, without items no hits. Texts of any length are searched whole, in memory of about 50 bytes for each of theirs.
Other columns are passed through, whatever their names; the operator's own names are replaced.
"""

from __future__ import annotations

import pickle
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from . import kernel as K

OUTPUT = ("n_words", "hit_words", "items")
WIDTH = 10
GROUP_BYTES = 8 << 20
PIECE_WORDS = 20_000
STRETCH = 96
_SHIFT_BITS = 18


class PatternTable:
    """Shift table and suffix buckets of all windows of m words."""

    def __init__(self, m: int, words: K.Words, starts: np.ndarray, items: np.ndarray, names: list[str]):
        """starts: the first word of each window; items: the number of its item among names."""
        self.m, self.block, self.names = m, min(2, m), names
        hashes = [words.hash[starts + k] for k in range(m)]
        far = m - self.block + 1
        self.shift = np.full(1 << _SHIFT_BITS, min(far, 255), dtype=np.uint8)
        for at in range(far):
            key = self.keys(hashes[at + self.block - 1], hashes[at])
            np.minimum.at(self.shift, key, min(m - self.block - at, 255))
        # Equal windows are one pattern: by two hashes of 64 bits.
        whole = _windows(words.hash, starts, m)
        second = _windows(K.mix(words.hash ^ K.U64(0x9FB21C651E98DF25)), starts, m)
        order = np.lexsort((items, second, whole))
        whole, second, items, starts = whole[order], second[order], items[order], starts[order]
        new = np.ones(len(order), bool)
        new[1:] = (whole[1:] != whole[:-1]) | (second[1:] != second[:-1])
        again = ~new
        again[1:] &= items[1:] == items[:-1]
        first, pattern = starts[new], np.cumsum(new) - 1
        # Patterns by bucket (the block that they end in), then by the hash of their first block.
        self.hash = words.hash
        bucket = self.bucket_keys(words.hash, first)
        by = np.argsort(bucket, kind="stable")
        self.bucket, self.first = bucket[by], first[by]
        of = np.argsort(by)[pattern[~again]]
        place = np.argsort(of, kind="stable")
        self.items = items[~again][place].astype(np.int32)
        self.ptr = np.searchsorted(of[place], np.arange(len(first) + 1))
        self.buf, self.start, self.end = words.buf, words.start, words.end

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i] : self.end[i]].tobytes()

    def keys(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        h = last if self.block == 1 else last ^ (before * K.U64(0x9E3779B97F4A7C15))
        return (h >> K.U64(64 - _SHIFT_BITS)).astype(np.int64)

    def bucket_keys(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of the windows that begin at these words: their last block, and in the lower 40 bits a hash of their first one."""
        last, begin = hashes[first + self.m - 1], hashes[first]
        suffix = self.keys(last, hashes[first + self.m - 2] if self.block == 2 else last)
        prefix = begin if self.block == 1 else begin ^ (hashes[first + 1] * K.U64(0xD1B54A32D192ED03))
        return (suffix << 40) | (prefix >> K.U64(24)).astype(np.int64)

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, pattern) for each pattern of a window's bucket that begins like it; windows by the place in first."""
        key = self.bucket_keys(hashes, first)
        low, high = np.searchsorted(self.bucket, key), np.searchsorted(self.bucket, key, side="right")
        window = np.repeat(np.arange(len(first)), high - low)
        return window, np.repeat(high - np.cumsum(high - low), high - low) + np.arange(len(window))

    def search(self, words: K.Words) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the occurrences and the pattern of each."""
        h, ptr, m = words.hash, words.ptr, self.m
        counts = np.diff(ptr)
        reach = np.maximum(counts - m + 1, 0)  # windows of each text
        lanes = -(-reach // STRETCH)
        if not lanes.sum() or not len(self.first):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(counts)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = ptr[text] + nth * STRETCH + m - 1  # the last word of the window
        end = np.minimum(at + STRETCH, ptr[text + 1])
        starts, found = [], []
        while len(at):
            skip = self.shift[self.keys(h[at], h[at - 1] if self.block == 2 else h[at])].astype(np.int64)
            stop = np.flatnonzero(skip == 0)
            if len(stop):
                first = at[stop] - m + 1
                window, pattern = self.candidates(h, first)
                for k in range(m):
                    same = h[first[window] + k] == self.hash[self.first[pattern] + k]
                    window, pattern = window[same], pattern[same]
                starts.append(first[window])
                found.append(pattern)
                skip[stop] = 1
            at = at + skip
            go = at < end
            at, end = at[go], end[go]
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        s, p = np.concatenate(starts), np.concatenate(found)
        each = ((i, f) for i, f in zip(s.tolist(), self.first[p].tolist()))
        same = np.fromiter((all(words.word(i + k) == self.word(f + k) for k in range(m)) for i, f in each), bool, len(s))
        return s[same], p[same]


def _windows(hashes: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    sums = K.prefix_sums(hashes)
    return K.mix((sums[starts + m] - sums[starts]) * K.powers(K._BASE_INV, len(sums))[starts])


def pattern_tables(ids: list, texts: list, width: int = WIDTH) -> list[PatternTable]:
    """One table for each pattern length among the items."""
    words = K.Words(pa.array(texts, pa.large_string()), K.ALNUM, lower=True)
    names = ["" if i is None else str(i) for i in ids]
    length = np.minimum(words.counts, width)
    reach = np.where(length > 0, words.counts - length + 1, 0)
    item = np.repeat(np.arange(len(ids)), reach)
    starts = words.ptr[:-1][item] + np.arange(len(item)) - np.repeat(np.cumsum(reach) - reach, reach)
    return [PatternTable(int(m), words, starts[length[item] == m], item[length[item] == m], names) for m in np.unique(length[length > 0])]


def pieces(benchmark: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """i, t: the items cut into pieces of at most PIECE_WORDS windows, so that each window stands in one piece."""

    def cut(batches):
        for whole in batches:
            for batch in K.slices(whole, "t"):
                w = K.Words(batch["t"], K.ALNUM, lower=True)
                ids, out = [], []
                for d, i in enumerate(batch["i"].to_pylist()):
                    a, b = int(w.ptr[d]), int(w.ptr[d + 1])
                    for at in range(a, max(b - width + 1, a + 1) if b > a else a, PIECE_WORDS):
                        to = min(b, at + PIECE_WORDS + width - 1)
                        ids.append(i)
                        out.append(w.buf[w.start[at] : w.end[to - 1]].tobytes().decode())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.string())], names=["i", "t"])

    items = common.Columns(benchmark, i=item_id, t=text).only()
    return items.select(F.col("i").cast("string").alias("i"), "t").mapInArrow(cut, "i string, t string")


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """docs with n_words, `hit_words` (the first and last word of each hit run, flat) and `items` (sorted ids as strings)."""
    c = common.Columns(docs, OUTPUT, text=text)
    out = c.frame.withColumns({"n_words": F.lit(0).cast("long"), "hit_words": F.array().cast("array<int>"), "items": F.array().cast("array<string>")})
    items = common.written(pieces(benchmark, item_id, item_text, width).distinct(), "patterns")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t") + F.octet_length(F.coalesce("i", F.lit("")))), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, -(-int(size) // group_bytes))
    for g in range(groups):
        # At most about group_bytes: pieces are distinct and small, and dealt by hash.
        got = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(groups)) == g).toArrow()
        shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(pattern_tables(got["i"].to_pylist(), got["t"].to_pylist(), width)))
        before, out = out, out.mapInArrow(_scanner(shared), out.schema)
        if g < groups - 1:
            out = common.written(out, "scanned")
            if g:
                common.drop_written(before)
    common.drop_written(items)
    return c.result(out)


def _scanner(shared):
    def run(batches):
        tables = pickle.loads(shared.value)
        for whole in batches:
            for batch in K.slices(whole, "text"):
                yield _scan(batch, tables)
            K.release()

    return run


def _scan(batch: pa.RecordBatch, tables: list[PatternTable]) -> pa.RecordBatch:
    words = K.Words(batch["text"], K.ALNUM, lower=True)
    n, docs = len(words.start), batch.num_rows
    step = np.zeros(n + 1, dtype=np.int32)
    owner = words.owner()
    old_hits, old_items = batch["hit_words"], batch["items"]
    items: dict[int, set[str]] = defaultdict(set)
    for d in np.flatnonzero(np.diff(np.asarray(old_hits.offsets)) > 0).tolist():
        spans, base = old_hits[d].as_py(), int(words.ptr[d])
        np.add.at(step, np.array(spans[::2]) + base, 1)
        np.add.at(step, np.array(spans[1::2]) + base + 1, -1)
        items[d].update(old_items[d].as_py())
    for t in tables:
        start, pattern = t.search(words)
        np.add.at(step, start, 1)
        np.add.at(step, start + t.m, -1)
        for d, p in set(zip(owner[start].tolist(), pattern.tolist())):
            items[d].update(t.names[k] for k in t.items[t.ptr[p] : t.ptr[p + 1]].tolist())
    hit = np.cumsum(step[:-1]) > 0
    edge = np.zeros(n + 2, dtype=np.int8)
    edge[1:-1] = hit
    # runs end where a text ends
    starts = np.flatnonzero(hit & ((edge[:-2] == 0) | np.isin(np.arange(n), words.ptr[:-1])))
    ends = np.flatnonzero(hit & ((edge[2:] == 0) | np.isin(np.arange(n) + 1, words.ptr[1:])))
    of = owner[starts]
    flat = np.stack([starts - words.ptr[of], ends - words.ptr[of]], axis=1).astype(np.int32).reshape(-1)
    offsets = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=docs) * 2))).astype(np.int32)
    new = {
        "n_words": pa.array(words.counts.astype(np.int64)),
        "hit_words": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
        "items": pa.array([sorted(items[d]) if d in items else [] for d in range(docs)], pa.list_(pa.string())),
    }
    return pa.RecordBatch.from_arrays([new.get(f.name, batch.column(i)) for i, f in enumerate(batch.schema)], names=batch.schema.names)


def contamination_report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each document."""
    found = find_contamination(common.Columns(docs, doc_id=doc_id, text=options.pop("text", "text")).only(), benchmark, **options)
    spans = F.sequence(F.lit(0), F.size("hit_words") - 1, F.lit(2))
    n_hit = F.when(F.size("hit_words") > 0, F.aggregate(spans, F.lit(0).cast("long"), lambda a, i: a + F.get("hit_words", i + 1) - F.get("hit_words", i) + 1)).otherwise(F.lit(0))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )
