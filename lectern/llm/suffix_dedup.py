"""Suffix-array deduplication of repeated byte strings, with deep-shallow sorting.

A byte goes if a string of `LENGTH` bytes over it also starts in a document with a smaller doc_id.

Sorting every suffix of the corpus would move each byte LENGTH times, so only suffixes that can matter are sorted:

1. Sampling. Every string of 50 bytes is represented by its anchor, the 16-byte substring of the least hash in it
   (a minimiser): equal strings have equal anchors at equal distances. About one position in 18 is an anchor. A string's key is its
   anchor with the 16 bytes behind it or, where these are not all inside the string, with the 16 before it: a frequent phrase
   of 16 bytes has as many keys, in as many buckets, as it has surroundings.
   Blocks and buckets exchange the keys' hashes; strings whose key occurs once are done.
2. Suffixes. The strings of a key that recurs start in a row; this context (99 bytes at most) is sent
   to the key's bucket, once for each block however often it occurs there.
3. Sorting. A bucket sorts the suffixes that start at these places: a multikey sort on 8-byte characters to the depth
   `SHALLOW`, all groups of a level at once; the groups that still share a prefix are ordered by blind tries,
   which hold only branching depths and bytes and compare each new suffix with one leaf. Runs that are equal to the full
   length name the first document of each string.
4. Each block hears, for each context and start, which of its documents is the first, or that an earlier block has it.

Defined results: null and empty texts have no bytes. Rows of one doc_id (repeated rows, too) do not take bytes from each other; a null
doc_id is smaller than all others. Strings never cross documents. An empty table gives no rows. Texts of any length are cut
into overlapping segments, so only their bytes themselves must fit into a task. Other columns are passed through whatever their names; columns with the operator's own names are replaced.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import blocks as B
from . import common
from . import kernel as K
from .substring_dedup import ordered

OUTPUT = ("n_bytes", "removed", "kept")
LENGTH = 50
ANCHOR, EXTENDED = 16, 32
SORTED_AT_ONCE = 1 << 17
SHALLOW = 32
ANCHOR_BYTES = 6
SEGMENT = 1 << 20
_PLACE_BITS = 28
_MASK = np.uint64((1 << _PLACE_BITS) - 1)


# --- deep-shallow suffix sorting ---------------------------------------------------------------------------


def characters(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one big-endian number (zeros beyond the end)."""
    wide = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for j in range(8):
        out |= wide[j : j + len(text)] << np.uint64(56 - 8 * j)
    return out


def _key(chars: np.ndarray, pos: np.ndarray, depth: int, upto: int) -> np.ndarray:
    at = pos + depth
    key = np.where(at < len(chars), chars[np.minimum(at, len(chars) - 1)], np.uint64(0))
    left = upto - depth
    return key if left >= 8 else key >> np.uint64(8 * (8 - left))


class BlindTrie:
    """A trie of strings that stores only where they branch; strings are compared with one leaf each."""

    __slots__ = ("depth", "children", "leaf")

    def __init__(self, depth: int, leaf: int):
        self.depth, self.leaf, self.children = depth, leaf, {}

    @staticmethod
    def order(strings: list[bytes]) -> list[list[int]]:
        """Numbers of the strings in ascending order, equal strings together."""
        size = max(map(len, strings))
        equal: dict[int, list[int]] = {0: [0]}
        root = BlindTrie(size, 0)
        for i in range(1, len(strings)):
            s = strings[i]
            node = root
            while node.children:  # blindly: follow what branches match, else any
                node = node.children.get(s[node.depth : node.depth + 1]) or next(iter(node.children.values()))
            other = strings[node.leaf]
            common = next((k for k in range(size) if s[k : k + 1] != other[k : k + 1]), size)
            if common == size:
                equal[node.leaf].append(i)
                continue
            equal[i] = [i]
            node, above = root, None
            while node.children and node.depth < common:
                above, node = node, node.children[s[node.depth : node.depth + 1]]
            new = BlindTrie(size, i)
            if node.children and node.depth == common:
                node.children[s[common : common + 1]] = new
                continue
            split = BlindTrie(common, node.leaf)
            split.children = {strings[node.leaf][common : common + 1]: node, s[common : common + 1]: new}
            if above is None:
                root = split
            else:
                above.children[s[above.depth : above.depth + 1]] = split
        out, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.children:
                stack += [node.children[c] for c in sorted(node.children, reverse=True)]
            else:
                out.append(equal[node.leaf])
        return out


def deep_shallow_sort(text: np.ndarray, pos: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at pos by their first length bytes, and where in that order a new string begins."""
    n = len(pos)
    order = np.arange(n)
    fresh = np.zeros(n, bool)
    if not n:
        return order, fresh
    fresh[0] = True
    chars = characters(text)
    shallow = min(shallow, length)
    for depth in range(0, shallow, 8):
        group = np.cumsum(fresh) - 1
        size = np.bincount(group)
        open_ = np.flatnonzero(size[group] > 1)
        if not len(open_):
            break
        key = _key(chars, pos[order[open_]], depth, shallow)
        by = np.lexsort((key, group[open_]))
        order[open_] = order[open_][by]
        key, of = key[by], group[open_]
        fresh[open_[1:]] |= (key[1:] != key[:-1]) | (of[1:] != of[:-1])
    if shallow == length:
        return order, fresh
    # Deep: groups whose members are all equal are done; blind tries order the others.
    start = np.flatnonzero(fresh)
    group = np.cumsum(fresh) - 1
    same = np.ones(n, bool)
    leader = pos[order[start]][group]
    for depth in range(shallow, length, 8):
        same &= _key(chars, pos[order], depth, length) == _key(chars, leader, depth, length)
    mixed = np.flatnonzero(np.bincount(group[~same], minlength=len(start)))
    end = np.append(start[1:], n)
    raw = text.tobytes()
    for g in mixed.tolist():
        a, b = int(start[g]), int(end[g])
        members = order[a:b].tolist()
        at = a
        for equal in BlindTrie.order([raw[p + shallow : p + length] for p in pos[members].tolist()]):
            fresh[at] = True
            order[at : at + len(equal)] = [members[k] for k in equal]
            at += len(equal)
    return order, fresh


# --- anchors and contexts ----------------------------------------------------------------------------------


class _Segments:
    """Stretches of documents, each with all strings that start in it; long documents have several."""

    def __init__(self, table: pa.Table, text: str, length: int):
        self.rows: list[list[tuple[int, int, np.ndarray]]] = []
        held, size, row = [], 0, 0
        for batch in table.select([text]).combine_chunks().to_batches():
            buf, off = K.buffers(batch[text])
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                for at in range(a, max(b - length + 1, a), SEGMENT):
                    part = buf[at : min(b, at + SEGMENT + length - 1)]
                    held.append((row, at - a, part))
                    size += len(part)
                    if size >= K.SLICE_BYTES:
                        self.rows.append(held)
                        held, size = [], 0
                row += 1
        if held:
            self.rows.append(held)


class _Contexts:
    """A block's keys (anchors with what stands beside them) and the row of strings that each represents."""

    def __init__(self, table: pa.Table, doc_id: str, text: str, length: int):
        self.table, self.length = ordered(table, doc_id, text), length
        ids = self.table[doc_id].combine_chunks().dictionary_encode()
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        # Rows are in doc_id order, so equal ids stand together.
        codes = np.asarray(ids.indices.fill_null(-1))
        self.ordinal = np.cumsum(np.diff(codes, prepend=codes[:1]) != 0).astype(np.int64)
        self.slices = _Segments(self.table, text, length).rows
        self._found: list[tuple] = []

    def each(self) -> list[tuple]:
        """For each slice: keys, anchors, first and last start of the strings, row and place of the first; found once, about 3 bytes for each of the text's.

        In a string the anchor stands d bytes from its start. With d at most `near` the bytes behind the anchor are inside, else those before it.
        """
        if self._found or not self.slices:
            return self._found
        span = self.length - ANCHOR + 1
        near = farthest(self.length)
        wide = self.length - near
        for held in self.slices:
            sizes = np.array([len(p) for _, _, p in held])
            off = np.concatenate(([0], np.cumsum(sizes)))
            buf = np.concatenate([p for _, _, p in held])
            sums = K.byte_prefix(buf)
            h = K.window_hash(sums, ANCHOR)
            v = (h & ~_MASK) | np.arange(len(h), dtype=np.uint64)
            width, least = 1, v
            while 2 * width <= span:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < span:
                least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
            seg = np.repeat(np.arange(len(held)), sizes)[: len(least)]
            starts = np.flatnonzero(off[seg + 1] - np.arange(len(least)) >= self.length)
            anchor = (least[starts] & _MASK).astype(np.int64)
            seg = seg[starts]
            cut = np.ones(len(starts), bool)
            cut[1:] = (anchor[1:] != anchor[:-1]) | (seg[1:] != seg[:-1])
            first = np.flatnonzero(cut)
            last = np.append(first[1:], len(starts)) - 1 if len(first) else first
            anchor, first, last, of = anchor[first], starts[first], starts[last], seg[first]
            behind, before = np.flatnonzero(anchor - last <= near), np.flatnonzero(anchor - first > near)
            h = K.window_hash(sums, wide)
            keys = np.concatenate([K.mix(h[anchor[behind]] ^ K.U64(0xA24BAED4963EE407)), K.mix(h[anchor[before] - (wide - ANCHOR)] ^ K.U64(0x9FB21C651E98DF25))])
            first = np.concatenate([np.maximum(first[behind], anchor[behind] - near), first[before]])
            last = np.concatenate([last[behind], np.minimum(last[before], anchor[before] - near - 1)])
            both = np.concatenate([behind, before])
            anchor, of = anchor[both], of[both]
            rows = np.array([r for r, _, _ in held])
            shift = np.array([s for _, s, _ in held])
            self._found.append((keys, *[x.astype(np.int32) for x in (anchor, first, last, rows[of], first - off[of] + shift[of])]))
        return self._found

    def keys(self):
        """Distinct keys, which recur in the block, each entry's key."""
        hashes = np.concatenate([np.zeros(0, np.uint64), *[x[0] for x in self.each()]])
        hashes &= ~np.uint64((1 << (64 - 8 * ANCHOR_BYTES)) - 1)
        keys, inverse, count = np.unique(hashes, return_inverse=True, return_counts=True)
        return keys, count > 1, inverse

    def contexts(self, heard: list[bytes]) -> dict[str, np.ndarray]:
        """The recurring keys' contexts: a matrix of bytes, places of the starts, and the distinct ones."""
        keys, own, inverse = self.keys()
        again = (own | B.unbits(heard))[inverse] if len(keys) else np.zeros(0, bool)
        wide = context_width(self.length)
        parts, at = [], 0
        for held, (hashes, anchor, first, last, row, place) in zip(self.slices, self.each()):
            hit = np.flatnonzero(again[at : at + len(anchor)])
            at += len(anchor)
            if not len(hit):
                continue
            padded = np.concatenate([*[p for _, _, p in held], np.zeros(wide, np.uint8)])
            size = last[hit] - first[hit] + self.length
            m = padded[first[hit][:, None] + np.arange(wide)]
            m[np.arange(wide) >= size[:, None]] = 0
            parts.append((hashes[hit], (anchor - first)[hit].astype(np.uint8), (anchor - last)[hit].astype(np.uint8), row[hit].astype(np.int64), place[hit].astype(np.int64), m))
        if not parts:
            parts = [(np.zeros(0, np.uint64), *[np.zeros(0, np.uint8)] * 2, *[np.zeros(0, np.int64)] * 2, np.zeros((0, wide), np.uint8))]
        hashes, high, low, row, place, m = (np.concatenate(x) for x in zip(*parts))
        index, group = distinct(hashes, high, low, m)
        return {"hash": hashes, "high": high, "low": low, "row": row, "place": place, "bytes": m, "index": index, "group": group}


def farthest(length: int) -> int:
    """The most bytes before an anchor with which what stands behind it is still inside the string."""
    return length - min(EXTENDED, (length + ANCHOR) // 2)


def context_width(length: int) -> int:
    """Longest context, in whole 8-byte characters."""
    near = farthest(length)
    return -(-(length + max(near, length - ANCHOR - near - 1)) // 8) * 8


def distinct(hashes: np.ndarray, high: np.ndarray, low: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First of each distinct context in the order of keys, and each context's number among these."""
    if not len(m):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = m.view(np.uint64)
    odd = K.powers(0xC2B2AE3D27D4EB4F, words.shape[1] + 2)[1:]
    key = (high.astype(np.uint64) * np.uint64(256) + low) * odd[-1]
    for j in range(words.shape[1]):
        key += words[:, j] * odd[j]
    key = K.mix(key)
    order = np.lexsort((key, hashes))  # stable: the first in document order leads
    k, h = key[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    index = order[new]
    leader = index[group]
    other = (high != high[leader]) | (low != low[leader])
    for j in range(words.shape[1]):
        other |= words[:, j] != words[leader, j]
    if other.any():  # equal hashes of different contexts: these stay on their own
        extra = np.flatnonzero(other)
        index = np.concatenate([index, extra])
        by = np.argsort(hashes[index], kind="stable")
        rank = np.empty(len(index), np.int64)
        rank[by] = np.arange(len(index))
        group[extra] = len(index) - len(extra) + np.arange(len(extra))
        index, group = index[by], rank[group]
    return index, group


def _pack(c: dict[str, np.ndarray], pick: np.ndarray, ordinal: np.ndarray, length: int) -> bytes:
    high, low, m = c["high"][pick], c["low"][pick], c["bytes"][pick]
    size = high.astype(np.int64) - low + length
    flat = m[np.arange(m.shape[1]) < size[:, None]]
    raw = np.int64(len(pick)).tobytes() + c["hash"][pick].astype("<u8").tobytes() + ordinal[c["row"][pick]].astype("<u4").tobytes() + high.tobytes() + low.tobytes() + flat.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(data: bytes, length: int):
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    hashes = raw[8 : 8 + 8 * n].view("<u8").astype(np.uint64)
    ordinal = raw[8 + 8 * n : 8 + 12 * n].copy().view("<u4").astype(np.int64)
    high, low, flat = raw[8 + 12 * n : 8 + 13 * n], raw[8 + 13 * n : 8 + 14 * n], raw[8 + 14 * n :]
    size = high.astype(np.int64) - low + length
    m = np.zeros((n, context_width(length)), np.uint8)
    m[np.arange(m.shape[1]) < size[:, None]] = flat
    return hashes, ordinal, high, low, m


def first_documents(said: list[tuple[int, bytes]], length: int, shallow: int = SHALLOW):
    """For each block the answer about its contexts: 0 for a start whose string an earlier block has, else 1 + ordinal of its first document."""
    parts = [_unpack(data, length) for _, data in said]
    block = np.repeat([b for b, _ in said], [len(p[0]) for p in parts])
    hashes, ordinal, high, low, m = (np.concatenate(x) for x in zip(*parts))
    index, group = distinct(hashes, high, low, m)
    rank = (block.astype(np.int64) << 32) | ordinal
    first = np.full(len(index), np.iinfo(np.int64).max)
    np.minimum.at(first, group, rank)
    # Starts of every distinct context; only contexts that share their key with another are sorted, some keys at a time.
    h = hashes[index]
    _, of, count = np.unique(h, return_inverse=True, return_counts=True)
    width = high[index].astype(np.int64) - low[index] + 1
    begin = np.cumsum(width) - width
    value = np.repeat(first, width)
    shared = np.flatnonzero(count[of] > 1)
    ends = np.cumsum(width[shared])
    new = np.diff(of[shared], prepend=-1) != 0
    part = ((ends - width[shared])[np.flatnonzero(new)] // SORTED_AT_ONCE)[np.cumsum(new) - 1] if len(shared) else ends
    for sort in np.split(shared, np.flatnonzero(np.diff(part)) + 1) if len(shared) else ():
        w = width[sort]
        inside = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
        slot = np.repeat(begin[sort], w) + inside
        pos = np.repeat(np.arange(len(sort)) * m.shape[1], w) + inside
        order, fresh = deep_shallow_sort(m[index[sort]].reshape(-1), pos, length, shallow)
        least = np.minimum.reduceat(value[slot[order]], np.flatnonzero(fresh))
        value[slot[order]] = least[np.cumsum(fresh) - 1]
    at = 0
    for (b, _), p in zip(said, parts):
        n = len(p[0])
        g = group[at : at + n]
        at += n
        w = width[g]
        slot = np.repeat(begin[g] - (np.cumsum(w) - w), w) + np.arange(int(w.sum()))
        v = value[slot]
        out = np.where((v >> 32) < b, 0, 1 + (v & 0xFFFFFFFF)).astype("<u4")
        yield b, zstandard.ZstdCompressor(level=1).compress(out.tobytes())


def suffix_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """docs with n_bytes, removed (start and end of each removed run, flat) and kept (the remaining bytes).

    as_text: kept is a string instead, the text without the characters all of whose bytes are removed (null for null).
    """
    if not 2 * ANCHOR <= length <= 128:
        raise ValueError("length lies between 32 and 128 bytes")
    # A start takes several numbers of memory while it is sorted, so blocks and buckets are smaller than elsewhere.
    c = common.Columns(docs, OUTPUT, doc_id=doc_id, text=text)
    n_blocks, n_buckets = (common.block_count(c.frame, "text", k) for k in (2, 4))
    keep, base, ex = c.frame.columns, B.with_blocks(c.frame, "doc_id", n_blocks), B.Exchange(n_blocks, n_buckets)

    def say_anchors(block, table):
        keys, _, _ = _Contexts(table, "doc_id", "text", length).keys()
        for bucket, a, b in B.cut(keys, n_buckets):
            yield bucket, B.pack(keys[a:b], ANCHOR_BYTES)

    def say_contexts(block, table, heard):
        b = _Contexts(table, "doc_id", "text", length)
        c = b.contexts(heard.get(0, []))
        index = c["index"]
        for bucket, x, y in B.cut(c["hash"][index], n_buckets):
            yield bucket, _pack(c, index[x:y], b.ordinal, length)

    def remove(block, table, heard):
        b = _Contexts(table, "doc_id", "text", length)
        c = b.contexts(heard.get(0, []))
        got = [np.frombuffer(zstandard.ZstdDecompressor().decompress(x), "<u4") for x in heard.get(1, [])]
        value = np.concatenate([np.zeros(0, np.uint32), *got])
        del got
        index, group = c["index"], c["group"]
        width = c["high"].astype(np.int64) - c["low"] + 1
        begin = np.cumsum(width[index]) - width[index]
        texts = [(x or "").encode() for x in b.table["text"].to_pylist()]
        offset = np.concatenate(([0], np.cumsum([len(x) for x in texts], dtype=np.int64)))
        hit = np.zeros(int(offset[-1]), bool)  # starts of strings that an earlier document has
        for k in range(0, len(group), 16_384):
            some = slice(k, k + 16_384)
            w = width[some]
            inside = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
            v = value[np.repeat(begin[group[some]], w) + inside]
            row = np.repeat(c["row"][some], w)
            gone = (v == 0) | (b.ordinal[row] >= v)
            hit[(offset[row] + np.repeat(c["place"][some], w) + inside)[gone]] = True
        del c
        spans, kept = [], []
        for d, raw in enumerate(texts):
            at = np.flatnonzero(hit[offset[d] : offset[d + 1]])
            if not len(at):
                spans.append([])
                kept.append(raw)
                continue
            new = np.flatnonzero(np.diff(at, prepend=-(1 << 40)) > length)
            start, end = at[new], at[np.append(new[1:], len(at)) - 1] + length
            spans.append(np.stack([start, end], axis=1).reshape(-1).tolist())
            edge = [0, *(_whole_characters(raw, spans[-1]) if as_text else spans[-1]), len(raw)]
            kept.append(b"".join(raw[x:y] for x, y in zip(edge[::2], edge[1::2])))
        out = b.table.select(keep)
        out = out.append_column("n_bytes", pa.array([len(x) for x in texts], pa.int64()))
        out = out.append_column("removed", pa.array(spans, pa.list_(pa.int64())))
        kept = pa.array(kept, pa.binary())
        if as_text:
            kept = pc.if_else(pc.is_null(b.table["text"].combine_chunks()), None, kept.cast(pa.string()))
        return out.append_column("kept", kept)

    anchors = ex.answer(ex.send(base, say_anchors), B.reply_repeated(ANCHOR_BYTES), 0)
    contexts = ex.answer(ex.send_again(base, anchors, say_contexts), lambda said: first_documents(said, length), 1)
    schema = T.StructType([*base.drop(B.BLOCK).schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("removed", T.ArrayType(T.LongType())), T.StructField("kept", T.StringType() if as_text else T.BinaryType())])
    return c.result(ex.finish(base, anchors.unionByName(contexts), remove, schema))


def _whole_characters(raw: bytes, runs: list[int]) -> list[int]:
    """The runs without the bytes of characters that go on before or behind them."""
    out: list[int] = []
    for start, end in zip(runs[::2], runs[1::2]):
        while start < end and raw[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        out += [start, end] if start < end else []
    return out
