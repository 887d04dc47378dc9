"""Encoding by distinct stretches.

A byte-level tokenizer's pattern starts a new piece at certain places whatever stands further off, so a text can be cut
there and each distinct stretch encoded once. Cutting, hashing and putting ids together again run on whole slices in numpy;
only stretches that are new to the process reach the encoder. Stretches are known by two 64-bit hashes; their bytes are not
kept. At a fixed size the table drops those that it has met once.

The pattern must give contractions, letters, digits and other signs, each run with one space before it, and white space
(`'s|'t|...| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`). Sure starts of pieces are then:

* a space before a sign that is no white space: whatever white space precedes it ends there;
* a line end after a sign;
* a sign of another class than the one before (ASCII letters, digits, others), but for a letter after an apostrophe.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import kernel as K

MOST_BYTES = 48 << 20
#: What an entry takes besides its ids: its place in the open table (half full) and its own numbers.
ENTRY_BYTES = 24 + 33

_OTHER, _LETTER, _DIGIT, _SIGN, _APOSTROPHE, _SPACE, _LINE, _LEAD = range(8)


def _class(b: int) -> int:
    c = chr(b)
    if b >= 0xC3:  # a lead byte; characters of those left out may be white space
        return _OTHER if b in (0xE1, 0xE2, 0xE3) else _LEAD
    if b >= 0x80 or (b < 0x21 and c not in " \n") or b == 0x7F:
        return _OTHER
    return _SPACE if c == " " else _LINE if c == "\n" else _APOSTROPHE if c == "'" else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SIGN


CLASS = np.array([_class(b) for b in range(256)], np.uint8)
#: Whether a stretch starts at a byte of the second class after one of the first.
_STARTS = np.zeros((8, 8), bool)
_STARTS[[_LETTER, _DIGIT, _SIGN, _APOSTROPHE], _LINE] = True
for _a, _b in ((_LETTER, _DIGIT), (_LETTER, _SIGN), (_LETTER, _APOSTROPHE), (_DIGIT, _LETTER), (_DIGIT, _SIGN), (_DIGIT, _APOSTROPHE), (_SIGN, _LETTER), (_SIGN, _DIGIT), (_APOSTROPHE, _DIGIT)):
    _STARTS[_a, _b] = True
_STARTS = _STARTS.reshape(-1)
_NO_SPACE = np.isin(np.arange(8), [_LETTER, _DIGIT, _SIGN, _APOSTROPHE, _LEAD])
_SECOND = np.random.default_rng(20240913).integers(1, 1 << 63, 256, dtype=np.uint64) * K.U64(2) + K.U64(1)


def stretch_starts(buf: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where stretches start; texts of which whole holds are one stretch each."""
    if not len(buf):
        return np.zeros(0, np.int64)
    kind = CLASS[buf]
    cut = np.zeros(len(buf), bool)
    cut[1:] = _STARTS[(kind[:-1] << np.uint8(3)) | kind[1:]]
    cut[:-1] |= (kind[:-1] == _SPACE) & _NO_SPACE[kind[1:]]
    full = np.diff(offsets) > 0
    cut[offsets[1:][full] - 1] &= kind[offsets[1:][full] - 1] != _SPACE  # what follows there is another text
    for d in np.flatnonzero(whole & full).tolist():
        cut[offsets[d] : offsets[d + 1]] = False
    cut[offsets[:-1][full]] = True
    return np.flatnonzero(cut)


class StretchTable:
    """encode(list of texts) gives the ids of each; every stretch must encode as it does within its text. most: bytes that the table may take.

    whole: strings (special tokens, which end the pieces beside them) whose texts are one stretch.
    """

    def __init__(self, encode, most: int = MOST_BYTES, whole: tuple[str, ...] = ()):
        self.encode, self.most, self.whole = encode, most, whole
        self._fill(*(np.zeros(0, x) for x in (np.uint64, np.uint64, np.int64, np.int32)))

    def _fill(self, key: np.ndarray, check: np.ndarray, count: np.ndarray, store: np.ndarray) -> None:
        """The table of just these stretches, whose ids stand in store one after another."""
        n, room = len(key), max(1 << 14, len(key))
        self.at = K.OpenTable(16)
        self.at.put(key, np.arange(n, dtype=np.int32))
        self.n, self.used = n, len(store)
        grown = lambda x, to: np.concatenate([x, np.zeros(to - len(x), x.dtype)])
        self.key, self.check, self.count = grown(key, room), grown(check, room), grown(count, room)
        self.start = grown(np.cumsum(count) - count, room)
        self.seen = np.zeros(room, np.uint8)
        self.store = grown(store, max(1 << 16, len(store)))

    def _shrink(self) -> None:
        """Keeps what has been met again since the last time, if that is little enough."""
        again = np.flatnonzero(self.seen[: self.n] > 1)
        again = again[self.at.get(self.key[again]) == again]
        count = self.count[again]
        if ENTRY_BYTES * len(again) + 4 * int(count.sum()) > self.most // 2:
            again, count = again[:0], count[:0]
        ends = np.cumsum(count)
        flat = self.store[np.repeat(self.start[again] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)]
        self._fill(self.key[again], self.check[again], count, flat)

    def _add(self, key: np.ndarray, check: np.ndarray, texts: list[str]) -> np.ndarray:
        """Rows of texts that are new."""
        got = self.encode(texts)
        size = np.fromiter(map(len, got), np.int64, len(got))
        n, first, last = int(size.sum()), self.n, self.n + len(got)
        while self.used + n > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while last > len(self.start):
            self.key, self.check, self.count, self.start, self.seen = (np.concatenate([x, np.zeros_like(x)]) for x in (self.key, self.check, self.count, self.start, self.seen))
        self.store[self.used : self.used + n] = np.fromiter((i for x in got for i in x), np.int32, n)
        self.start[first:last] = self.used + np.cumsum(size) - size
        self.count[first:last], self.key[first:last], self.check[first:last] = size, key, check
        self.seen[first:last] = 0
        self.used, self.n = self.used + n, last
        return np.arange(first, last)

    def _rows(self, key: np.ndarray, check: np.ndarray, texts) -> np.ndarray:
        """Numbers of the stretches in the table; texts(places) gives those that are new."""
        out = self.at.get(key).astype(np.int64)
        new = np.flatnonzero(out < 0)
        if len(new):
            _, first = np.unique(key[new], return_index=True)
            first = new[first]
            self.at.put(key[first], self._add(key[first], check[first], texts(first)).astype(np.int32))
            out[new] = self.at.get(key[new])
        odd = np.flatnonzero(self.check[out] != check)  # another stretch of the same first hash: on its own, each time
        if len(odd):
            out[odd] = self._add(key[odd], check[odd], texts(odd))
        self.seen[out] += self.seen[out] < 2
        twice = np.bincount(out, minlength=self.n)[: self.n] > 1
        self.seen[: self.n][twice] = 2
        return out

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another (null: none) and the texts' n + 1 offsets."""
        if ENTRY_BYTES * self.n + 4 * self.used > self.most:
            self._shrink()
        buf, off = K.buffers(texts)
        whole = np.zeros(len(off) - 1, bool)
        for x in self.whole:
            whole |= np.asarray(pc.fill_null(pc.match_substring(texts, x), False))
        start = stretch_starts(buf, off, whole)
        end = np.append(start[1:], len(buf)) if len(start) else start
        key, check = K.span_hash(K.byte_prefix(buf), start, end), K.span_hash(K.prefix_sums(_SECOND[buf]), start, end)

        def some(places: np.ndarray) -> list[str]:
            raw = buf.tobytes()
            return [raw[a:b].decode() for a, b in zip(start[places].tolist(), end[places].tolist())]

        rows = self._rows(key, check, some)
        count = self.count[rows]
        ends = np.cumsum(count)
        flat = self.store[np.repeat(self.start[rows] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return flat, np.concatenate(([0], ends))[np.searchsorted(start, off)]
