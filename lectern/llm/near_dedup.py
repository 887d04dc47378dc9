"""Near-duplicate groups with SuperMinHash signatures, banding, verification on full sets and union-find.

A document's set holds its distinct 5-word shingles (fewer words: the whole sequence). Steps:

1. Signatures. SuperMinHash walks each element through a random permutation of the slots; in level j an element offers
   j + a random fraction to the j-th slot of its permutation. Levels run for all elements of a slice at once and stop for
   a document as soon as all its slots are filled, since later levels offer only larger values.
2. Classes. Documents with equal sets (128-bit set hash and size) are one class; its least doc_id stands for it.
3. Bands. Representatives that share a band key are candidates. Nothing is paired inside a bucket yet.
4. Bounds. Shingles that no other candidate holds cannot be shared: a document with n shingles, u of them its own, overlaps
   any other in n - u at most. Blocks and buckets exchange distinct shingle hashes to count u (see blocks). Documents
   for which this bound rules out every link leave.
5. Stars. In each bucket the document with the least share of own shingles is the hub; all others are verified against it.
   A hub's text goes once to each of the groups into which its partners are dealt.
6. Rest. Pairs of one bucket that are still in different components and whose bounds allow a link are verified too, a large
   bucket's in many groups. Here a third bound helps: with each shingle flipping one of 1,024 bits, two documents' bits differ in at most as many
   places as their sets do. So every pair that shares a band is either confirmed, ruled out by its bound, or already connected: there is no cap.
7. Components of the confirmed links; members of a class follow its representative.

At a similarity of 0.85 a pair shares none of the 32 bands of 4 slots with a probability of about 6e-11.

Null and empty texts have empty sets and are linked with nothing. Rows that share a doc_id are one document and get one result (if their
texts differ, links are confirmed on the least text that is not null). Of documents that are alike in all else the least id is kept.
A null doc_id counts as the least id and its component_id is null. An empty table gives no rows. Texts of any length are taken whole: a
text's shingles, 8 bytes for each word and several times that while they are sorted, must fit into a task. Other columns are passed through whatever their names;
columns with the operator's own names are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks as B
from . import common
from . import kernel as K
from .components import components

SHINGLE = 5
BANDS, ROWS = 32, 4
SIMILARITY = 85  # percent
OUTPUT = ("n_shingles", "component_id", "kept")
NULL_ID = -(1 << 63)
_KEY_BYTES = 6
#: Shingles and partners of one document that a task verifies at a time; members of a bucket that a task compares with as many others.
GROUP_SHINGLES, GROUP_MEMBERS, COMPARED = 250_000, 128, 4096
PARITY = 1024


# --- sets and signatures -----------------------------------------------------------------------------------


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and their n + 1 offsets."""
    w = K.Words(texts, K.PLAIN, lower=True)
    sums, counts = K.prefix_sums(w.hash), w.counts
    whole = np.flatnonzero(w.room(width))
    short = np.flatnonzero((counts > 0) & (counts < width))
    first = np.concatenate([whole, w.ptr[short]])
    size = np.concatenate([np.full(len(whole), width), counts[short]])
    h = K.span_hash(sums, first, first + size) if len(first) else np.zeros(0, np.uint64)
    doc = w.owner()[first] if len(first) else np.zeros(0, np.int64)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(counts)))))


def super_min_hash(h: np.ndarray, offsets: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash signatures, one row of slots for each set (infinity for empty sets)."""
    n = np.diff(offsets)
    sig = np.full(len(n) * slots, np.inf)
    doc, element = np.repeat(np.arange(len(n)), n), h
    permutation = None
    for level in range(slots):
        if not len(element):
            break
        x = K.mix(element + K.U64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1)))
        r = (x >> K.U64(24)).astype(np.float64) * 2.0**-40
        k = level + (((x & K.U64(0xFFFFFF)) * K.U64(slots - level)) >> K.U64(24)).astype(np.int64)
        if level == 0:
            slot = k
        else:
            rows = np.arange(len(element))
            slot = permutation[rows, k].astype(np.int64)
            permutation[rows, k] = permutation[rows, level]
        np.minimum.at(sig, doc * slots + slot, level + r)
        open_ = ~np.isfinite(sig.reshape(-1, slots)).all(axis=1)
        go = open_[doc]
        if level == 0:
            permutation = np.tile(np.arange(slots, dtype=np.uint16), (int(go.sum()), 1))
            permutation[np.arange(len(permutation)), k[go]] = 0
        elif not go.all():
            permutation = permutation[go]
        if not go.all():
            doc, element = doc[go], element[go]
    return sig.reshape(-1, slots)


def _signed(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """node, n, the set's two hashes and its band keys (none for an empty set); docs has node and text."""
    schema = "node long, n long, s1 long, s2 long, bands array<long>"

    def run(batches):
        for whole in batches:
            for batch in K.slices(whole, "text"):
                h, off = shingle_sets(batch["text"], width)
                n = np.diff(off)
                sums = []
                for salt in (0x51ED270B, 0xA0761D6478BD642F):
                    total = np.concatenate(([0], np.cumsum(K.mix(h ^ K.U64(salt)), dtype=np.uint64))).astype(np.uint64)
                    sums.append((total[off[1:]] - total[off[:-1]]).view(np.int64))
                sig = super_min_hash(h, off, bands * rows)
                v = sig.view(np.uint64).reshape(len(n), bands, rows)
                key = K.mix((v * K.powers(0xC2B2AE3D27D4EB4F, rows + 1)[1:]).sum(axis=2, dtype=np.uint64)).view(np.int64)
                offsets = np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0)))).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(key[n > 0].reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch["node"], pa.array(n), pa.array(sums[0]), pa.array(sums[1]), keys], names=["node", "n", "s1", "s2", "bands"])
            K.release()

    return docs.mapInArrow(run, schema)


# --- bounds ------------------------------------------------------------------------------------------------


def _bounds(candidates: DataFrame, width: int) -> DataFrame:
    """node, n, o (the most shingles a candidate can share with any other) and bits (parity of its shingles by hash)."""
    n_blocks, n_buckets = B.counts(candidates, "text")
    base = candidates.withColumn(B.BLOCK, F.pmod(F.xxhash64("node"), F.lit(n_blocks)).cast("int"))

    def each(table):
        at = 0
        for b in table.select(["text"]).combine_chunks().to_batches():
            for s in K.slices(b, "text"):
                h, off = shingle_sets(s["text"], width)
                yield h, np.repeat(np.arange(len(off) - 1), np.diff(off)) + at
                at += len(off) - 1

    def places(table):
        """Each row's place by node: the two rounds read a block's rows in any order."""
        out = np.empty(table.num_rows, np.int64)
        out[np.argsort(np.asarray(table["node"]))] = np.arange(table.num_rows)
        return out

    def talk(block, table):
        """Every distinct key once, with its document's place if the block holds it once."""
        h, doc = (np.concatenate(x) for x in zip(*each(table)))
        keys, index, count = np.unique(h & ~np.uint64(0xFFFF), return_index=True, return_counts=True)
        owner = np.where(count == 1, places(table)[doc[index]], -1).astype("<i4")
        for bucket, a, b in B.cut(keys, n_buckets):
            yield bucket, B.pack(keys[a:b], _KEY_BYTES) + owner[a:b].tobytes()

    def reply(said):
        parts = [(b, B.unpack(d[: len(d) // 10 * 6], 6), np.frombuffer(d[len(d) // 10 * 6 :], "<i4")) for b, d in said]
        keys = np.concatenate([k for _, k, _ in parts])
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        alone = np.ones(len(k), bool)
        alone[1:] &= k[1:] != k[:-1]
        alone[:-1] &= k[1:] != k[:-1]
        single = np.zeros(len(k), bool)
        single[order] = alone
        at = 0
        for block, key, owner in parts:
            mine = owner[single[at : at + len(key)]]
            at += len(key)
            yield block, np.bincount(mine[mine >= 0]).astype("<i4").tobytes()

    def work(block, table, heard):
        own = np.zeros(table.num_rows, np.int64)
        for part in heard.get(0, []):
            got = np.frombuffer(part, "<i4")
            own[: len(got)] += got
        own = own[places(table)]
        parity = np.zeros((table.num_rows, PARITY), np.uint8)
        for h, doc in each(table):
            np.bitwise_xor.at(parity, (doc, (h & K.U64(PARITY - 1)).astype(np.int64)), 1)
        words = np.packbits(parity, axis=1).view(np.int64).reshape(-1)
        offsets = pa.array(np.arange(table.num_rows + 1, dtype=np.int32) * (PARITY // 64))
        return pa.table({"node": table["node"], "n": table["n"], "o": pa.array(np.asarray(table["n"]) - own), "bits": pa.ListArray.from_arrays(offsets, pa.array(words))})

    schema = T.StructType([*[T.StructField(x, T.LongType()) for x in ("node", "n", "o")], T.StructField("bits", T.ArrayType(T.LongType()))])
    ex = B.Exchange(n_blocks, n_buckets)
    return ex.finish(base, ex.answer(ex.send(base, talk), reply), work, schema)


def _possible(n: Column, o: Column, m: Column, p: Column, percent: int) -> Column:
    """Whether sets of n and m elements that overlap in o and p at most can be similar enough."""
    most = F.least(o, p)
    return (100 * most >= percent * (n + m - most)) & (100 * F.least(n, m) >= percent * F.greatest(n, m))


def _differences(a: Column, b: Column) -> Column:
    """At least so many shingles are in one set only."""
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(PARITY // 64)), F.lit(0))


# --- verification ------------------------------------------------------------------------------------------


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, a written table; a is the side that stands in many pairs. pairs and texts are written tables, too.

    Pairs are dealt into groups of about GROUP_SHINGLES shingles by a; an a with more has several groups. Each group gets a's text once
    and the texts of its partners, so that no row carries a hub's text and no task a whole star.
    """
    sizes = texts.select(F.col("node").alias("b"), "n")
    load = common.written(pairs.join(sizes, "b").groupBy("a").agg((F.floor(F.greatest(F.sum("n") / GROUP_SHINGLES, F.count(F.lit(1)) / GROUP_MEMBERS)) + 1).cast("int").alias("parts"), F.sum("n").alias("load")), "loads")
    total = load.agg(F.coalesce(F.sum("load"), F.lit(0)).alias("n")).first()["n"]
    groups = max(common.shuffle_width(pairs.sparkSession), int(total) // GROUP_SHINGLES + 1)
    group = lambda part: F.pmod(F.xxhash64("a", part), F.lit(groups)).cast("int").alias("_group")
    members = pairs.join(load, "a").select(group(F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")), "a", "b")
    members = members.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").select("_group", "a", "b", "text_b")
    hubs = load.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select(group(F.col("part")), "a").distinct()
    hubs = hubs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").select("_group", "a", "text_a")

    def run(key, left, right):
        sets: dict[int, np.ndarray] = {}
        for batch in right.to_batches():
            for s in K.slices(batch, "text_a"):
                h, off = shingle_sets(s["text_a"], width)
                sets |= {x: h[off[k] : off[k + 1]] for k, x in enumerate(s["a"].to_pylist())}
        out = []
        for batch in left.to_batches():
            for s in K.slices(batch, "text_b"):
                h, off = shingle_sets(s["text_b"], width)
                for k, (x, y) in enumerate(zip(s["a"].to_pylist(), s["b"].to_pylist())):
                    t = h[off[k] : off[k + 1]]
                    both = _overlap(sets[x], t)
                    if both > 0 and 100 * both >= percent * (len(sets[x]) + len(t) - both):
                        out.append((x, y))
        del sets
        K.release()
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    found = common.written(members.groupBy("_group").cogroup(hubs.groupBy("_group")).applyInArrow(run, "a long, b long"), "links")
    common.drop_written(load)
    return found


def _overlap(s: np.ndarray, t: np.ndarray) -> int:
    if len(s) > len(t):
        s, t = t, s
    if not len(s):
        return 0
    at = np.searchsorted(t, s)
    at[at == len(t)] = 0
    return int((t[at] == s).sum())


# --- the operator ------------------------------------------------------------------------------------------


def near_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """docs with n_shingles, component_id (least doc_id that links reach) and kept (whether that is its own id)."""
    c = common.Columns(docs, OUTPUT, doc_id=doc_id, text=text)
    named = c.frame.withColumn("node", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
    plain = named.select("node", "text")
    signed = common.written(_signed(plain, width, bands, rows), "signatures")
    sets = ["s1", "s2", "n"]
    classes = signed.where("n > 0").groupBy(*sets).agg(F.min("node").alias("rep"), F.min_by("bands", "node").alias("bands"))
    classes = common.written(classes, "classes")

    keys = classes.select(F.col("rep").alias("node"), F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("band", "key").agg(F.min("node").alias("_a"), F.max("node").alias("_b")).where("_a < _b").select("band", "key")
    members = common.written(keys.join(shared, ["band", "key"]), "members")
    wanted = members.select("node").distinct().join(classes.select(F.col("rep").alias("node"), "n"), "node").groupBy("node").agg(F.min("n").alias("n"))
    texts = plain.join(wanted, "node").groupBy("node", "n").agg(F.min("text").alias("text"))
    texts = common.written(texts, "candidates")

    bounds = common.written(_bounds(texts, width).where(F.col("o") * 100 >= F.col("n") * percent), "bounds")
    inside = common.written(members.join(bounds.select("node", "n", "o"), "node"), "bounded")
    own = ((F.col("n") - F.col("o")) * 1_000_000 / F.col("n")).cast("long")
    hubs = inside.groupBy("band", "key").agg(F.min(F.struct(own.alias("own"), "node", "n", "o")).alias("hub"))
    star = inside.join(hubs, ["band", "key"]).where(F.col("hub.node") != F.col("node")).where(_possible(F.col("n"), F.col("o"), F.col("hub.n"), F.col("hub.o"), percent))
    star = star.select(F.least("node", "hub.node").alias("x"), F.greatest("node", "hub.node").alias("y"), F.col("hub.node").alias("hub")).groupBy("x", "y").agg(F.min("hub").alias("a"))
    star = common.written(star.select("x", "y", "a", F.when(F.col("a") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("b")), "stars")
    links = _verified(star.select("a", "b"), texts, width, percent)
    labels = components(links)

    labelled = inside.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("band", "key").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a < _b").select("band", "key")
    mixed = mixed.join(labelled.groupBy("band", "key").agg(F.ceil(F.count(F.lit(1)) / COMPARED).cast("int").alias("parts")), ["band", "key"])
    rest = labelled.join(mixed, ["band", "key"]).join(bounds.select("node", "bits"), "node")
    rest = rest.select("band", "key", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node", "n", "o", "component", "bits")
    # A large bucket's members are dealt into parts, and every two parts meet in a group of their own.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    x = rest.select("*", F.col("part").alias("i"), other.alias("j")).alias("x")
    y = rest.select("*", F.col("part").alias("j"), other.alias("i")).alias("y")
    pair = (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component")) & _possible(F.col("x.n"), F.col("x.o"), F.col("y.n"), F.col("y.o"), percent)
    # |A| + |B| - 2 * overlap is at least the differences, and must be at most (100 - percent) / (100 + percent) of |A| + |B|
    pair = pair & ((100 + percent) * _differences(F.col("x.bits"), F.col("y.bits")) <= (100 - percent) * (F.col("x.n") + F.col("y.n")))
    for name in ("band", "key", "i", "j"):
        pair = pair & (F.col(f"x.{name}") == F.col(f"y.{name}"))
    more = x.join(y, pair).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    done = star.select(F.col("x").alias("a"), F.col("y").alias("b"))
    untried = common.written(more.join(done, ["a", "b"], "left_anti"), "pairs")
    more = _verified(untried, texts, width, percent)
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    # What follows reads signatures, classes and labels only.
    common.drop_written(members, texts, bounds, inside, star, links, untried, more)

    of_class = classes.join(labels, classes["rep"] == labels["node"], "left").select(*sets, F.coalesce("component", "rep").alias("component"))
    found = signed.where("n > 0").join(of_class, sets, "left").select("node", "n", F.coalesce("component", "node").alias("component"))
    found = found.unionByName(signed.where("n = 0").select("node", "n", F.col("node").alias("component")))  # no words, one key: they stay where they are
    found = found.groupBy("node").agg(F.max("n").alias("n_shingles"), F.min("component").alias("_c"))
    found = found.select("node", "n_shingles", F.when(F.col("_c") != NULL_ID, F.col("_c")).alias("component_id"), (F.col("_c") == F.col("node")).alias("kept"))
    return c.result(named.join(found, "node"))
