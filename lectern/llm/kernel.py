"""Vectorised byte and word kernels shared by the corpus operators.

Everything here works on one Arrow slice inside a task: Spark deals out the rows, these
helpers turn a slice of texts into flat numpy arrays (bytes, word spans, rolling hashes).
Slices are cut by bytes so that the 8-byte-per-byte temporaries stay small and in cache.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 384 << 10
#: An odd multiplier has an inverse modulo 2**64, so a span hash does not depend on its place.
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base & (2**64 - 1), dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads polynomial hashes over all 64 bits."""
    h = h ^ (h >> U64(31))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(29)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(32)
    return h


def prefix_sums(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def byte_prefix(buf: np.ndarray) -> np.ndarray:
    return prefix_sums(_BYTE_VALUES[buf])


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end) of what prefix sums."""
    return mix((prefix[end] - prefix[start]) * powers(_BASE_INV, len(prefix))[start])


def window_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of width values; one entry for each start."""
    n = len(prefix) - width
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return mix((prefix[width:] - prefix[:-width]) * powers(_BASE_INV, n))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about limit bytes of text (a longer text stands alone)."""
    if not batch.num_rows:
        return
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0)).astype(np.int64) + 8)
    at = 0
    while at < len(size):
        to = int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, side="right"))
        to = max(to, at + 1)
        yield batch.slice(at, to - at)
        at = to


def buffers(texts: pa.Array, end: str = "") -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes one after another (null: empty), each followed by end, and n + 1 offsets."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.type != pa.large_binary():
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if end:
        texts = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar(end, pa.large_string()))
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return buf, off - off[0]


def _table(keep) -> np.ndarray:
    return np.array([keep(b) for b in range(256)], dtype=bool)


#: Bytes of words by white space only, and of words of letters, digits and all beyond ASCII.
PLAIN = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALNUM = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


class Words:
    """The words of a slice of texts: byte spans, hashes and each text's range of words."""

    def __init__(self, texts: pa.Array, kept: np.ndarray = PLAIN, lower: bool = False):
        self.buf, self.offsets = buffers(texts, " ")
        if lower:
            self.buf = LOWER[self.buf]
        edge = np.zeros(len(self.buf) + 2, dtype=np.int8)
        edge[1:-1] = kept[self.buf]
        step = np.diff(edge)
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.ptr = np.searchsorted(self.start, self.offsets)
        self._hash: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = span_hash(byte_prefix(self.buf), self.start, self.end)
        return self._hash

    def room(self, width: int) -> np.ndarray:
        """For each word, whether width words of its own text start there."""
        n = len(self.start)
        left = np.repeat(self.ptr[1:], self.counts) - np.arange(n)
        return left >= width

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i] : self.end[i]].tobytes()


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the spans [start, end)."""
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:-1]) > 0


def per_text(flags: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of flags over each range of ptr."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[ptr[1:]] - total[ptr[:-1]]


class OpenTable:
    """An open-addressing table from 64-bit keys to small numbers, looked up for whole arrays."""

    def __init__(self, bits: int):
        self.bits, self.n = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New and distinct keys."""
        if 2 * (self.n + len(keys)) > 1 << self.bits:
            old, there = (self.keys, self.values), self.values >= 0
            self.__init__(self.bits + 1)
            self.put(old[0][there], old[1][there])
            return self.put(keys, values)
        self.n += len(keys)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            at = slot[todo]
            free = self.values[at] < 0
            _, first = np.unique(at[free], return_index=True)
            won = todo[free][first]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        slot = self._slot(keys)
        out = self.values[slot]
        wrong = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            out[wrong] = self.values[slot[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.keys[slot[wrong]] != keys[wrong])]
        return out


def release() -> None:
    """Gives memory that Arrow and the C library hold for later back to the system; for the end of a group."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
