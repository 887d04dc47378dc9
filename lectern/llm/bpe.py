"""Byte-level BPE by prefix dynamic programming, and its decoding.

For every prefix of a piece exactly one token can come last in that prefix's encoding. Storing it for each
byte makes the encoding of a prefix a walk backwards, an append a continuation of the same table, and an edit
a re-run from the edited byte until the stored tokens agree again. A token ending at byte i is the last one
if it may follow the last token of the prefix before it, that is, if encoding the two tokens' bytes together
gives just these two.

Texts are split by the tokenizer's pattern; pieces never cross a single space between two words, so texts
are cut there and each distinct stretch is split and encoded once per task (the table of stretches is
emptied at a fixed size). Nothing shuffles.

Defined results: a null text is empty and has no ids; the digest of no ids is that of the empty string. Each row is encoded on its own,
repeated rows alike; null doc_ids stay null. An empty table gives no rows. Texts of any length are encoded whole; one text's
hashes, about 50 bytes for each of its bytes, must fit into a task, and so must its longest piece's table. Other columns are passed through whatever their names; columns with the operator's own names are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import os
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from . import kernel as K
from .stretches import StretchTable

#: Bounds of what a process keeps: pairs of tokens in the two tables, bytes of encoded stretches.
KNOWN_PAIRS, BATCH_PAIRS, STRETCH_BYTES = 50_000, 250_000, 20 << 20
SLICE_BYTES = 1 << 20
VOCABULARY_BYTES = 64 << 20
_NEVER = 1 << 40


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 bytes and ranks."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class Vocabulary:
    """Ranks with what the prefix tables need: each token's parts, and which tokens may follow each other."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._follows: dict[int, bool] = {}
        #: The tokens whose merge makes each token, -1 for single bytes: left and right parts.
        self.parts = np.full((2, max(self.bytes, default=0) + 1), -1, np.int32)
        pairs, made = array("Q"), array("i")
        for data, rank in ranks.items():
            for k in range(1, len(data)):
                a, b = ranks.get(data[:k]), ranks.get(data[k:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    made.append(rank)
            if len(data) > 1:
                self.parts[:, rank] = self._last_merge(data)
        #: Rank of the token that two tokens' bytes make together, whichever merge makes it.
        self.joined = K.OpenTable(18)
        self.joined.put(np.array(pairs, np.uint64), np.array(made, np.int32))

    def _last_merge(self, data: bytes) -> tuple[int, int]:
        rank, pieces = self.ranks.get, [data[i : i + 1] for i in range(len(data))]
        while len(pieces) > 2:
            _, at = min((rank(pieces[i] + pieces[i + 1], _NEVER), i) for i in range(len(pieces) - 1))
            pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        return self.ranks[pieces[0]], self.ranks[pieces[1]]

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether left and right stay apart when encoded side by side, pair by pair.

        While a token is built, ever larger parts stand at its edge, each until the merge that absorbs it. Whatever meets at the
        border merges if that merge ranks below the one that absorbs the left part and not above the one that
        absorbs the right part (of equal ranks, the leftmost goes first). Parts are tried from large to small on either side.
        """
        out = np.ones(len(left), bool)
        at, a, until_a = np.arange(len(left)), left, np.full(len(left), _NEVER)
        while len(at):
            on, b, until_b, a_, ua_ = at, right[at], np.full(len(at), _NEVER), a, until_a
            while len(on):
                joined = self.joined.get((a_.astype(np.uint64) << K.U64(32)) | b.astype(np.uint64))
                merges = (joined >= 0) & (joined < ua_) & (joined <= until_b)
                out[on[merges]] = False
                inner = self.parts[0, b]
                go = (inner >= 0) & ~merges
                on, until_b, b, a_, ua_ = on[go], b[go], inner[go], a_[go], ua_[go]
            inner = self.parts[1, a]
            go = (inner >= 0) & out[at]
            at, until_a, a = at[go], a[go], inner[go]
        return out

    def follows(self, left: int, right: int) -> bool:
        """apart() for one pair; answers are kept up to a number."""
        key = left << 32 | right
        known = self._follows.get(key)
        if known is None:
            if len(self._follows) >= KNOWN_PAIRS:
                self._follows.clear()
            known = self._follows[key] = bool(self.apart(np.array([left]), np.array([right]))[0])
        return known


class PrefixTable:
    """The last token of every prefix of one piece; bytes can be appended and edited."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _extend(self, end: int) -> None:
        """Entries up to byte end; longer tokens are tried first."""
        data, last, longest = self.data, self.last, self.v.longest
        rank, known, follows = self.v.ranks.get, self.v._follows.get, self.v.follows
        for i in range(len(last) + 1, end + 1):
            for j in range(i - longest if i > longest else 0, i):
                token = rank(data[j:i])
                if token is not None:
                    if not j:
                        break
                    before = last[j - 1]
                    apart = known(before << 32 | token)
                    if apart or (apart is None and follows(before, token)):
                        break
            else:
                raise ValueError("a byte is not in the vocabulary")
            last.append(token)

    def append(self, data: bytes) -> PrefixTable:
        self.data += data
        self._extend(len(self.data))
        return self

    def replace(self, start: int, end: int, data: bytes) -> PrefixTable:
        """Put data in place of bytes [start, end) and renew only the entries near the edit."""
        tail = self.last[end:]
        self.data = self.data[:start] + data + self.data[end:]
        del self.last[start:]
        self._extend(start + len(data))
        same = 0
        for k, token in enumerate(tail):
            self._extend(len(self.last) + 1)
            same = same + 1 if self.last[-1] == token else 0
            if same >= self.v.longest:  # no entry further right sees what has changed
                self.last += tail[k + 1 :]
                break
        return self

    def ids(self) -> list[int]:
        out, i = [], len(self.last)
        while i:
            out.append(self.last[i - 1])
            i -= len(self.v.bytes[out[-1]])
        return out[::-1]


class PieceBatch:
    """The same prefix tables for many short pieces at once: byte i of every piece, token sizes from long to short."""

    LONGEST = 48

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        short = [(t, r) for t, r in vocabulary.ranks.items() if len(t) <= self.LONGEST]
        buf, off = K.buffers(pa.array([t for t, _ in short], pa.binary()).cast(pa.large_binary()))
        self.tokens = K.OpenTable(18)
        self.tokens.put(K.span_hash(K.byte_prefix(buf), off[:-1], off[1:]), np.array([r for _, r in short], np.int32))
        self.sizes = sorted({len(t) for t, _ in short}, reverse=True)
        self.length = np.zeros(max(vocabulary.bytes, default=0) + 1, np.int64)
        for t, r in short:
            self.length[r] = len(t)
        self.apart = K.OpenTable(18)

    def _follows(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.uint64) << K.U64(32)) | right.astype(np.uint64)
        got = self.apart.get(key)
        if (got < 0).any():
            new = np.unique(key[got < 0])
            if self.apart.n + len(new) > BATCH_PAIRS:
                self.apart = K.OpenTable(18)
                new = np.unique(key)
            answers = self.v.apart((new >> K.U64(32)).astype(np.int64), (new & K.U64(0xFFFFFFFF)).astype(np.int64))
            self.apart.put(new, answers.astype(np.int32))
            got = self.apart.get(key)
        return got > 0

    def ids(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        n = len(pieces)
        if not n:
            return []
        size = np.fromiter(map(len, pieces), np.int64, n)
        order = np.argsort(-size, kind="stable")
        size = size[order]
        buf = np.frombuffer(b"".join([pieces[k] for k in order.tolist()]), np.uint8)
        base = np.cumsum(size) - size
        sums = K.byte_prefix(buf)
        inverse = K.powers(K._BASE_INV, len(sums))
        last = np.full(len(buf), -1, np.int64)
        for i in range(1, int(size[0]) + 1):
            open_ = base[: np.searchsorted(-size, -i, side="right")] + i
            for s in self.sizes:
                if s > i or not len(open_):
                    continue
                start = open_ - s
                token = self.tokens.get(K.mix((sums[open_] - sums[start]) * inverse[start]))
                good = np.flatnonzero(token >= 0)
                if s < i and len(good):
                    good = good[self._follows(last[start[good] - 1], token[good])]
                if len(good):
                    last[open_[good] - 1] = token[good]
                    open_ = open_[last[open_ - 1] < 0]
            if len(open_):
                raise ValueError("a byte is not in the vocabulary")
        # Walk back from every piece's end.
        found: list[tuple[np.ndarray, np.ndarray]] = []
        which, end = np.arange(n), base + size
        while len(which):
            token = last[end - 1]
            found.append((which, token))
            end = end - self.length[token]
            more = end > base[which]
            which, end = which[more], end[more]
        steps = np.concatenate([np.full(len(w), -k) for k, (w, _) in enumerate(found)])
        which, token = (np.concatenate(x) for x in zip(*found))
        by = np.lexsort((steps, which))
        flat, ends = token[by].tolist(), np.cumsum(np.bincount(which, minlength=n)).tolist()
        out: list[tuple[int, ...]] = [()] * n
        a = 0
        for k, e in zip(order.tolist(), ends):
            out[k] = tuple(flat[a:e])
            a = e
        return out


class Encoder:
    """Encodes texts, each distinct stretch once while it is in the table."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.v, self.split = vocabulary, regex.compile(pattern)
        self.batch = PieceBatch(vocabulary)
        self.table = StretchTable(self._encode, STRETCH_BYTES)

    def _encode(self, stretches: list[str]) -> list[list[int]]:
        ranks = self.v.ranks
        cut = [[p.encode() for p in self.split.findall(s)] for s in stretches]
        new = list({p for pieces in cut for p in pieces if p not in ranks})
        short = [p for p in new if len(p) <= PieceBatch.LONGEST]
        got = dict(zip(short, self.batch.ids(short)))
        got |= {p: tuple(PrefixTable(self.v, p).ids()) for p in new if len(p) > PieceBatch.LONGEST}
        return [[i for p in pieces for i in (got[p] if p in got else (ranks[p],))] for pieces in cut]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        flat, off = self.table.ids(pa.array(texts, pa.large_string()))
        return [flat[a:b].tolist() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.v.bytes.__getitem__, ids))


_encoders: dict[tuple[bytes, str], Encoder] = {}


def encoder(ranks: bytes, pattern: str) -> Encoder:
    """The process's encoder for the content of a vocabulary file; built once in each Python worker."""
    key = hashlib.sha256(ranks).digest(), pattern
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Vocabulary(parse_ranks(ranks)), pattern)
    return _encoders[key]


def shared_file(spark: SparkSession, path: str, most: int = VOCABULARY_BYTES):
    """A vocabulary file's content for all tasks: only the driver opens the path. A vocabulary does not grow with the data; its size is checked."""
    if os.path.getsize(path) > most:
        raise ValueError(f"a vocabulary of more than {most} bytes")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, vocabulary: str, pattern: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with the ids of each text as an array column."""
    data, c = shared_file(docs.sparkSession, vocabulary), common.Columns(docs, (ids,), text=text)

    def run(batches):
        e = encoder(data.value, pattern)
        for whole in batches:
            for batch in K.slices(whole, "text", SLICE_BYTES):
                flat, off = e.table.ids(batch["text"])
                got = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, ids])
            K.release()

    return c.result(c.frame.mapInArrow(run, c.frame.withColumn(ids, F.array().cast("array<int>")).schema))


def decode(rows: DataFrame, vocabulary: str, pattern: str, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """rows with the bytes that the ids stand for (null for null)."""
    data, c = shared_file(rows.sparkSession, vocabulary), common.Columns(rows, (out,), ids=ids)

    def run(batches):
        e = encoder(data.value, pattern)
        for batch in batches:
            got = pa.array([None if x is None else e.decode(x) for x in batch["ids"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, out])
            K.release()

    return c.result(c.frame.mapInArrow(run, c.frame.withColumn(out, F.lit(None).cast("binary")).schema))


def token_digests(docs: DataFrame, vocabulary: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: each text is encoded and decoded, only digests leave the task."""
    data = shared_file(docs.sparkSession, vocabulary)

    def run(batches):
        e = encoder(data.value, pattern)
        for whole in batches:
            for batch in K.slices(whole, "text", SLICE_BYTES):
                a, b = [], []
                flat, off = e.table.ids(batch["text"])
                for x, y in zip(off[:-1].tolist(), off[1:].tolist()):
                    ids = flat[x:y].tolist()
                    a.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                    b.append(hashlib.sha256(e.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.diff(off)), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            K.release()

    rows = common.Columns(docs, doc_id=doc_id, text=text).only()
    schema = rows.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256")).schema
    return rows.mapInArrow(run, schema)
