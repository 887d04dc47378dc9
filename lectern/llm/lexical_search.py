"""Ranked lexical search with Block-Max WAND.

The index is a table of segments, each of so many documents as come to about `segment_bytes` of text. Inside a segment the documents are numbered by
length, so that a block's documents have like impacts. A term's posting list is cut into blocks of `BLOCK` postings; a
block holds gaps and frequencies as variable-length bytes, and beside it stand its first and last document and the greatest impact in it.

Search looks at all items of a group side by side, one lane for each. A lane's terms are ordered by the document they point at; the pivot is the first at which
the lists' greatest scores sum up to the lane's threshold. All terms up to it move their block pointers (no block is unpacked for
that), which gives a range of documents over which the blocks stay the same. If the blocks' maxima stay below the threshold, the whole range is skipped; else
the blocks are unpacked, once for all lanes, the range's documents are scored exactly and the pointers move to real postings behind it. The threshold is
the lane's tenth best score so far. About the root of all segments are searched first; their tenth best scores are where
all other segments start, so that far from every segment has ten results to send.

Scores are whole numbers: weight * (10**9 * tf div (1000 * tf + 8 * m)), see `norms` and `weights`. A document whose bound equals the threshold is scored, so that ties are
settled by the smallest doc_id.

Items are searched in groups of at most `GROUP_BYTES` of text (the broadcast part), each against the whole index, `LANES` at a time.

Defined results: null and empty texts have no terms, are found by nothing and do not count in N; items without terms have no result; items with equal ids are
one item with the terms of all; a null item_id is an item, too; repeated rows of documents are documents of their own (with one doc_id, equal scores
in any order); an empty table on either side gives no rows. doc_id is of any type with an order. Texts of any length count whole; a segment,
about 12 bytes for each of its text's and at least one document, must fit into a task. Terms of a segment are told apart by hashes of 64 bits.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from . import common
from . import kernel as K

BLOCK, TOP, LANES = 64, 10, 256
GROUP_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


# --- Scores ------------------------------------------------------------------------------------------------


def norms(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """m of documents with n terms, from the number of documents and of all terms."""
    return 100 - 90 + (90 * n.astype(np.int64) * documents) // max(length, 1)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence count is worth in a document, before the term's weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# --- Packed numbers ----------------------------------------------------------------------------------------


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length bytes (seven bits each, the lowest first) of all values, and where each begins, with the end."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        more = v >= K.U64(1 << (7 * k))
        if not more.any():
            break
        size += more
    at = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(int(at[-1]), np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        here = np.flatnonzero(size > k)
        byte = (v[here] >> K.U64(7 * k)) & K.U64(127)
        out[at[here] + k] = byte.astype(np.uint8) | np.where(size[here] > k + 1, 128, 0).astype(np.uint8)
    return out, at


def unpacked(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    begins = np.concatenate(([0], ends[:-1] + 1))
    size = ends - begins + 1
    out = (data[begins] & 127).astype(np.int64)
    for k in range(1, int(size.max()) if len(size) else 0):
        here = np.flatnonzero(size > k)
        out[here] |= (data[begins[here] + k] & 127).astype(np.int64) << (7 * k)
    return out


def _gathered(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of buf one after another, and where each begins, with the end."""
    at = np.concatenate(([0], np.cumsum(size)))
    return buf[np.repeat(start - at[:-1], size) + np.arange(int(at[-1]))], at


# --- The index ---------------------------------------------------------------------------------------------


@dataclass
class Index:
    """The segments' table, the number of documents with terms and of all their terms, and the type of doc_id.

    A segment has a row without term, with its documents' ids and (in data) their m, and a row for each of its terms: n documents,
    and of each block the first and last document, the greatest impact and the place of its bytes in data.
    """

    table: DataFrame
    documents: int
    length: int
    segments: int
    id_type: DataType


class _Segment:
    """Collects a segment's texts, slice by slice."""

    def __init__(self):
        self.size, self.docs = 0, 0
        self.ids, self.n, self.hash, self.words, self.pairs = [], [], [], [], []

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        w = K.Words(texts, K.ALNUM, lower=True)
        known, first, of = np.unique(w.hash, return_index=True, return_inverse=True)
        data, at = _gathered(w.buf, w.start[first], w.end[first] - w.start[first])
        self.words.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(known), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]))
        key, tf = np.unique(of.astype(np.int64) * (len(texts) + 1) + w.owner(), return_counts=True)
        self.pairs.append((key // (len(texts) + 1), key % (len(texts) + 1) + self.docs, tf))
        self.hash.append(known)
        self.ids.append(ids)
        self.n.append(w.counts)
        self.size += len(w.buf)
        self.docs += len(texts)

    def rows(self, number: int, documents: int, length: int, schema: pa.Schema):
        """The segment's record batches."""
        ids, n = pa.chunked_array(self.ids).combine_chunks(), np.concatenate(self.n)
        order = np.asarray(pc.sort_indices(pa.table({"n": n, "id": ids}), [("n", "ascending"), ("id", "ascending")])).astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        m = norms(n[order], documents, length)
        terms, first, of = np.unique(np.concatenate(self.hash), return_index=True, return_inverse=True)
        base = np.cumsum([0, *(len(h) for h in self.hash)])
        term = np.concatenate([of[base[k] + t] for k, (t, _, _) in enumerate(self.pairs)])
        doc = rank[np.concatenate([d for _, d, _ in self.pairs])]
        tf = np.concatenate([f for _, _, f in self.pairs])
        by = np.argsort(term * len(order) + doc)
        term, doc, tf = term[by], doc[by], tf[by].astype(np.int64)
        many = np.bincount(term, minlength=len(terms))
        begin = np.cumsum(many) - many
        place = np.arange(len(doc)) - begin[term]
        starts = np.flatnonzero(place % BLOCK == 0)  # of the blocks
        ends = np.append(starts[1:], len(doc)) if len(starts) else starts
        greatest = np.maximum.reduceat(impact(tf, m[doc]), starts) if len(starts) else np.zeros(0, np.int64)
        gap = np.diff(doc, prepend=0)
        gap[starts] = 0  # a block's first document stands beside it
        data, at = packed(np.stack([gap, tf], axis=1).reshape(-1))
        blocks = -(-many // BLOCK)
        off = np.concatenate(([0], np.cumsum(blocks))).astype(np.int32)
        byte = at[2 * np.append(begin, len(doc))]
        lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(off), pa.array(values, kind))
        where = at[2 * starts] - byte[term[starts]]
        binary = pa.Array.from_buffers(pa.binary(), len(terms), [None, pa.py_buffer(byte.astype(np.int32)), pa.py_buffer(data)])
        names = pa.concat_arrays(self.words).take(pa.array(first)).cast(pa.large_string()).cast(pa.string())
        t = len(terms)
        yield self._batch(schema, [pa.array([number]), pa.array([None], pa.string()), pa.array([len(order)], pa.int32()), *[pa.array([[]], schema.field(k).type) for k in (3, 4, 5, 6)], pa.array([m.tobytes()], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), ids.take(pa.array(order)))])
        columns = [pa.array(np.full(t, number, np.int64)), names, pa.array(many, pa.int32()), lists(doc[starts], pa.int32()), lists(doc[ends - 1], pa.int32()), lists(greatest, pa.int32()), lists(where, pa.int32()), binary, pa.nulls(t, schema.field("ids").type)]
        for k in range(0, t, 20_000):
            yield self._batch(schema, [c.slice(k, 20_000) for c in columns])

    @staticmethod
    def _batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def segment_bytes(docs: DataFrame, text: str) -> int:
    """Both the number and the size of segments grow with the root of the input."""
    size = common.estimated_bytes(docs.select(text))
    return min(max(8 << 20, int(100 * math.sqrt(size))), 64 << 20)


def build(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int | None = None) -> Index:
    """The index of all documents, a written table. Terms are counted first, since impacts need the average length."""
    rows = common.Columns(docs, doc_id=doc_id, text=text).only().select("doc_id", "text")
    size = size or segment_bytes(docs, text)

    def count(batches):
        for whole in batches:
            for batch in K.slices(whole, "text"):
                n = K.Words(batch["text"], K.ALNUM, lower=True).counts
                yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], names=["documents", "length"])
        K.release()

    got = rows.select("text").mapInArrow(count, "documents long, length long").agg(F.sum("documents").alias("d"), F.sum("length").alias("l")).first()
    documents, length = int(got["d"] or 0), int(got["l"] or 0)
    id_type = rows.schema["doc_id"].dataType
    ids = to_arrow_type(id_type)
    schema = pa.schema([("segment", pa.int64()), ("term", pa.string()), ("n", pa.int32()), *((k, pa.list_(pa.int32())) for k in ("first", "last", "impact", "at")), ("data", pa.binary()), ("ids", pa.list_(ids))])

    def segments(batches):
        part, held, segment = TaskContext.get().partitionId(), 0, _Segment()
        for whole in batches:
            for batch in K.slices(whole, "text", min(K.SLICE_BYTES, size)):
                segment.add(batch["doc_id"], batch["text"])
                if segment.size >= size:
                    yield from segment.rows((part << 32) + held, documents, length, schema)
                    held, segment = held + 1, _Segment()
        if segment.docs:
            yield from segment.rows((part << 32) + held, documents, length, schema)
        K.release()

    ddl = f"segment long, term string, n int, first array<int>, last array<int>, impact array<int>, at array<int>, data binary, ids array<{id_type.simpleString()}>"
    table = common.written(rows.mapInArrow(segments, ddl), "postings")
    return Index(table, documents, length, table.where("term IS NULL").count(), id_type)


# --- Search ------------------------------------------------------------------------------------------------


@dataclass
class Group:
    """Items that are searched together: of each its terms' numbers, thresholds to start from, and all terms' weights."""

    terms: dict[str, int]
    items: list[list[int]]
    weights: np.ndarray
    least: np.ndarray


class Lists:
    """The posting lists of a segment that a group of items asks for; blocks are unpacked when they are needed."""

    def __init__(self, table: pa.Table, terms: dict[str, int]):
        head = table.filter(pc.is_null(table["term"]))
        rows = table.filter(pc.is_valid(table["term"])).combine_chunks()
        self.m = np.frombuffer(head["data"][0].as_py(), np.int64)
        self.ids = head["ids"].combine_chunks().flatten()
        by_id = np.asarray(pc.sort_indices(self.ids)).astype(np.int64)
        self.id_rank = np.empty(len(by_id), np.int64)
        self.id_rank[by_id] = np.arange(len(by_id))
        self.number = np.full(len(terms), -1)
        self.number[[terms[t] for t in rows["term"].to_pylist()]] = np.arange(rows.num_rows)
        flat = lambda name: np.asarray(_one(rows[name]).flatten()).astype(np.int64)
        self.first, self.last, self.impact, at = flat("first"), flat("last"), flat("impact"), flat("at")
        many = np.asarray(pc.list_value_length(_one(rows["at"]))).astype(np.int64)
        self.begin = np.concatenate(([0], np.cumsum(many)))  # blocks of each list
        of = np.repeat(np.arange(len(many)), many)
        data = _one(rows["data"])
        off = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64) if len(data) else np.zeros(1, np.int64)
        self.data = np.frombuffer(data.buffers()[2], np.uint8) if len(data) and data.buffers()[2] is not None else np.zeros(0, np.uint8)
        self.at = np.append(off[of] + at, off[-1])
        n = np.asarray(rows["n"]).astype(np.int64)
        self.postings = np.minimum(n[of] - (np.arange(len(of)) - self.begin[of]) * BLOCK, BLOCK)
        self.docs = np.full((len(of), BLOCK), len(self.m), np.int32)
        self.worth = np.zeros((len(of), BLOCK), np.int32)
        self.open = np.zeros(len(of), bool)
        self.key = of * (len(self.m) + 1) + self.last  # ascending over all lists
        self.greatest = np.maximum.reduceat(self.impact, self.begin[:-1]) if len(many) else np.zeros(0, np.int64)

    def unpack(self, blocks: np.ndarray) -> None:
        """The documents and impacts of these blocks, unless they are there already."""
        need = np.unique(blocks[~self.open[blocks]])
        if not len(need):
            return
        data, _ = _gathered(self.data, self.at[need], self.at[need + 1] - self.at[need])
        pair = unpacked(data).reshape(-1, 2)
        many = self.postings[need]
        begin = np.cumsum(many) - many
        block = np.repeat(need, many)
        total = np.cumsum(pair[:, 0])
        doc = total - total[begin][np.repeat(np.arange(len(need)), many)] + self.first[block]
        place = np.arange(len(block)) - np.repeat(begin, many)
        self.docs[block, place] = doc
        self.worth[block, place] = impact(pair[:, 1], self.m[doc])
        self.open[need] = True

    def block_of(self, lists: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The block of each list in which the first posting at or behind doc is; the next list's first block if there is none."""
        return np.searchsorted(self.key, lists * (len(self.m) + 1) + doc)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def block_max_wand(lists: Lists, items: list[list[int]], weights: np.ndarray, least: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, document, score) of the top documents of each item whose score is at least its `least`; equal scores by doc_id."""
    end = len(lists.m)
    own = [[t for t in terms if lists.number[t] >= 0] for terms in items]
    lane = np.array([q for q, terms in enumerate(own) if terms], np.int64)
    out_q, out_d, out_s = (np.zeros(0, np.int64),) * 3
    if not len(lane):
        return out_q, out_d, out_s
    wide = max(len(t) for t in own)
    lst, w = np.full((len(lane), wide), -1), np.zeros((len(lane), wide), np.int64)
    for k, q in enumerate(lane.tolist()):
        lst[k, : len(own[q])] = lists.number[own[q]]
        w[k, : len(own[q])] = weights[own[q]]
    here = lst >= 0
    bound = np.where(here, w * lists.greatest[lst], 0)
    block = np.where(here, lists.begin[lst], 0)
    beyond = lists.begin[lst + 1]  # the first block that is not the list's own
    point = np.where(here, lists.first[block], end)  # no posting of the list lies before it
    tail = np.where(here, lists.last[block], end)  # of the block pointed at: its last document and greatest score
    most = np.where(here, w * lists.impact[block], 0)
    theta = np.maximum(least[lane], 1)
    best_s, best_d = np.zeros((len(items), top), np.int64), np.full((len(items), top), end)
    id_rank = np.append(lists.id_rank, np.iinfo(np.int64).max)

    def move(r: np.ndarray, c: np.ndarray, b: np.ndarray, doc: np.ndarray) -> None:
        """Points lists at their blocks b, and at doc or what comes first behind it."""
        over = b >= beyond[r, c]
        b = np.where(over, 0, b)
        to = np.maximum(lists.first[b], doc)
        real = np.flatnonzero(lists.open[b] & ~over)
        at = (lists.docs[b[real]] < to[real][:, None]).sum(1)
        to[real] = np.where(at < BLOCK, lists.docs[b[real], np.minimum(at, BLOCK - 1)], to[real])
        block[r, c], point[r, c] = np.where(over, block[r, c], b), np.where(over, end, to)
        tail[r, c], most[r, c] = np.where(over, end, lists.last[b]), np.where(over, 0, w[r, c] * lists.impact[b])

    while True:
        order = np.argsort(point, axis=1, kind="stable")
        reach = np.cumsum(np.take_along_axis(bound, order, 1), axis=1) >= theta[:, None]
        pivot = np.take_along_axis(point, np.take_along_axis(order, reach.argmax(1)[:, None], 1), 1)[:, 0]
        going = reach[:, -1] & (pivot < end)
        if not going.all():
            lane, lst, w, bound, block, beyond, point, tail, most, theta, pivot = (x[going] for x in (lane, lst, w, bound, block, beyond, point, tail, most, theta, pivot))
            if not len(lane):
                break
        # Shallow moves: block pointers go on to the pivot, nothing is unpacked.
        r, c = np.nonzero((point <= pivot[:, None]) & (tail < pivot[:, None]))
        if len(r):
            move(r, c, lists.block_of(lst[r, c], pivot[r]), pivot[r])
        np.copyto(point, pivot[:, None], where=point < pivot[:, None])
        # The range behind the pivot in which all lists stay in the blocks that they point at, and the lists that have postings there;
        # and the shorter range in which only those up to the pivot have any.
        inside = point <= pivot[:, None]
        stop = np.where(inside, tail, end - 1).min(1)
        stop = np.where(point <= stop[:, None], tail, end - 1).min(1)
        wide = point <= stop[:, None]
        scored = np.where(inside, most, 0).sum(1) >= theta
        none = np.where(wide, most, 0).sum(1) < theta
        stop = np.where(scored | none, stop, np.where(inside, tail, point - 1).min(1))
        if scored.any():
            r, c = np.nonzero(wide & scored[:, None])
            b = block[r, c]
            lists.unpack(b)
            docs = lists.docs[b]
            row, col = np.nonzero((docs >= pivot[r][:, None]) & (docs <= stop[r][:, None]))
            q, found = r[row], docs[row, col].astype(np.int64)
            score = w[q, c[row]] * lists.worth[b[row], col]
            key, at = np.unique(q * (end + 1) + found, return_inverse=True)
            score = _sums(at, score, len(key))
            q, found = key // (end + 1), key % (end + 1)
            good = score >= theta[q]
            if good.any():
                _keep(best_s, best_d, lane[q[good]], found[good], score[good], id_rank)
                theta = np.maximum(theta, best_s[lane, top - 1])
        r, c = np.nonzero(point <= stop[:, None])
        move(r, c, block[r, c] + (tail[r, c] <= stop[r]), stop[r] + 1)
    q, k = np.nonzero(best_s >= np.maximum(least, 1)[:, None])
    return q, best_d[q, k], best_s[q, k]


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    order = np.argsort(at, kind="stable")
    return np.add.reduceat(values[order], np.searchsorted(at[order], np.arange(n)))


def _keep(best_s: np.ndarray, best_d: np.ndarray, item: np.ndarray, doc: np.ndarray, score: np.ndarray, id_rank: np.ndarray) -> None:
    """Puts new documents among the best of their items: highest score first, then smallest doc_id."""
    which, top = np.unique(item), best_s.shape[1]
    q = np.concatenate((np.repeat(which, top), item))
    s, d = np.concatenate((best_s[which].reshape(-1), score)), np.concatenate((best_d[which].reshape(-1), doc))
    order = np.lexsort((id_rank[d], -s, q))
    q, s, d = q[order], s[order], d[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < top
    best_s[q[keep], place[keep]], best_d[q[keep], place[keep]] = s[keep], d[keep]


def _searcher(shared, ids: pa.DataType):
    def run(key, table):
        group: Group = pickle.loads(shared.value)
        lists = Lists(table, group.terms)
        found = [(np.zeros(0, np.int64),) * 3]
        for k in range(0, len(group.items), LANES):
            q, d, s = block_max_wand(lists, group.items[k : k + LANES], group.weights, group.least[k : k + LANES])
            found.append((q + k, d, s))
        q, d, s = (np.concatenate(x) for x in zip(*found))
        K.release()
        return pa.table({"q": pa.array(q, pa.int64()), "doc_id": lists.ids.take(pa.array(d)).cast(ids), "score": pa.array(s, pa.int64())})

    return run


def queries(items: DataFrame, *, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, terms: the distinct terms of each item."""
    rows = common.Columns(items, item_id=item_id, text=text).only()
    terms = F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0)))
    each = rows.select("item_id", terms.alias("terms")).groupBy("item_id")
    return each.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"))


def best_of(found: DataFrame, top: int = TOP) -> DataFrame:
    """Of each q the top rows, with their rank; every task sends at most so many rows of a q."""
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(index: Index, items: DataFrame, *, item_id: str = "item_id", text: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ten best documents of each item."""
    spark: SparkSession = items.sparkSession
    asked = common.written(queries(items, item_id=item_id, text=text), "items")
    size = asked.agg(F.sum(F.aggregate("terms", F.lit(16).cast("long"), lambda a, t: a + F.octet_length(t) + 24))).first()[0] or 0
    groups, out = max(1, -(-int(size) // group_bytes)), None
    for g in range(groups):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(groups)) == g)
        part = _search_group(spark, index, mine)
        out = part if out is None else out.unionByName(part)
    return out


def _search_group(spark: SparkSession, index: Index, asked: DataFrame) -> DataFrame:
    got = asked.toArrow()
    texts = got["terms"].to_pylist()
    names = sorted({t for terms in texts for t in terms})
    number = {t: k for k, t in enumerate(names)}
    words = F.broadcast(spark.createDataFrame(pa.table({"term": pa.array(names, pa.string())})))
    hits = index.table.join(words, "term", "left_semi")
    df = {r["term"]: r["df"] for r in hits.groupBy("term").agg(F.sum("n").alias("df")).toLocalIterator()}
    weights = np.array([weight(index.documents, df.get(t, 0)) for t in names], np.int64)
    lanes = [[number[t] for t in terms] for terms in texts]
    with_heads = hits.unionByName(index.table.where("term IS NULL"))
    root = math.isqrt(max(index.segments - 1, 0)) + 1
    first = F.pmod(F.xxhash64("segment"), F.lit(root)) == 0

    def over(rows: DataFrame, least: np.ndarray) -> DataFrame:
        shared = spark.sparkContext.broadcast(pickle.dumps(Group(number, lanes, weights, least)))
        found = rows.groupBy("segment").applyInArrow(_searcher(shared, to_arrow_type(index.id_type)), f"q long, doc_id {index.id_type.simpleString()}, score long")
        return common.written(found, "found")

    least = np.zeros(len(lanes), np.int64)
    early = over(with_heads.where(first), least)
    for r in best_of(early).where(F.col("rank") == TOP).toLocalIterator():
        least[r["q"]] = r["score"]
    found = early.unionByName(over(with_heads.where(~first), least))
    ids = spark.createDataFrame(got.select(["item_id"]).append_column("q", pa.array(range(got.num_rows), pa.int64())), f"item_id {asked.schema['item_id'].dataType.simpleString()}, q long")
    return best_of(found).join(F.broadcast(ids), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int | None = None) -> DataFrame:
    """item_id, rank, doc_id, score of the ten best documents of each item, by an index built for it."""
    return search(build(docs, doc_id=doc_id, text=text, size=size), items, item_id=item_id, text=item_text)
