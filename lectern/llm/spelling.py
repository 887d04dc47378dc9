"""Spelling variants: a trie self-join with active-node sets over the vocabulary, distance one.

A pair of words at distance one (of lengths n and n or n + 1) shares its first n // 2 code points or its last n - n // 2. So the
vocabulary trie is partitioned by prefixes of half a word's length, and so is the trie of the reversed words: a word goes to two
partitions for each length that its partner may make the shorter one. Partitions of more than `GROUP` words are parted again by half of what is
left below their prefix, until they fit or two code points are left. What a partition holds follows from the words, and a frequent
word is one row of it.

A task builds the tries of many partitions at once, level by level, and hands active-node sets down: a node's set holds the nodes whose
paths are within distance one of its own. Because that is symmetrical, a set is kept as pairs of nodes of one depth (one code point
replaced) and pairs of a node and one a level deeper (one inserted). Children of a pair of nodes are a pair if they have the same code point;
siblings, and a node with its child, start new pairs. Two terminal nodes in a pair are words at distance one.

Defined results: null and empty texts have no words; a null doc_id hashes as an empty id; repeated rows count each time; equal counts take the
smallest word in code-point order; an empty table gives no rows. Texts and words of any length count whole. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from . import kernel as K

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
GROUP = 200_000
CHUNK = 60_000
_ROW = "key string, rest string, short int, word string, n long"


# --- The vocabulary ----------------------------------------------------------------------------------------


def misspelt(doc_id: Column, run: Column, every: int = 31) -> Column:
    """The run, with one code point left out where the checksum of `<doc_id>:<run>` is divisible by every."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, shorter).otherwise(run)


def vocabulary(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words of enough code points and occurrences. Runs that are too short for any word are not even cut out."""
    rows = common.Columns(docs, doc_id=doc_id, text=text).only()
    runs = rows.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"))
    words = runs.select(misspelt(F.col("doc_id"), F.translate("run", UPPER, LOWER)).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# --- Partitions of the trie --------------------------------------------------------------------------------


def halved(rows: DataFrame) -> DataFrame:
    """Each row twice: below the first half of its rest, and, the rest reversed, below the last half. short: the lesser length of a partition's rests."""
    half, other = F.floor(F.col("short") / 2).cast("int"), F.ceil(F.col("short") / 2).cast("int")
    back = F.reverse("rest")

    def below(mark: str, rest: Column, shared: Column, left: Column) -> Column:
        key = F.concat("key", F.lit(mark), F.substring(rest, F.lit(1), shared), F.lit(" "))
        return F.struct(key.alias("key"), F.substring(rest, shared + 1, F.length(rest)).alias("rest"), left.alias("short"), "word", "n")

    both = F.array(below("<", F.col("rest"), half, other), below(">", back, other, half))
    return rows.select(F.explode(both).alias("p")).select("p.*")


def partitions(words: DataFrame, group: int = GROUP) -> DataFrame:
    """Rows of key, rest, short, word, n: the partitions in which pairs of words meet, none of more than group words if it can be parted."""
    short = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("short")
    rows = halved(words.select("word", "n", short).where("short > 0").select(F.concat(F.col("short").cast("string"), F.lit(":")).alias("key"), F.col("word").alias("rest"), "short", "word", "n"))
    done = None
    while True:
        large = common.written(rows.where("short > 2").groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > group).select("key"), "large")
        if large.isEmpty():
            common.drop_written(large)
            return rows if done is None else done.unionByName(rows)
        fits = rows.join(large, "key", "left_anti")
        done = fits if done is None else done.unionByName(fits)
        rows = common.written(halved(rows.join(large, "key", "left_semi")), "parted")


# --- Tries and active-node sets ----------------------------------------------------------------------------


class Trie:
    """The tries of many partitions side by side; a partition's root is a node of depth 0.

    Nodes are numbered level by level, and within a level as their paths sort, so that the children of a node stand together.
    """

    def __init__(self, group: np.ndarray, rests: pa.Array):
        """group: the partition of each rest, ascending; the rests of a partition ascend and are distinct."""
        size = np.asarray(pc.utf8_length(rests)).astype(np.int64)
        codes = np.frombuffer("".join(rests.to_pylist()).encode("utf-32-le"), "<u4").astype(np.int64)
        begin = np.cumsum(size) - size
        node = group.astype(np.int64)  # of each row at the present depth
        total = int(group[-1]) + 1 if len(group) else 0
        self.level = [0, total]
        word = np.full(total, -1)
        at = np.flatnonzero(size == 0)
        word[node[at]] = at
        words, keys, row, depth = [word], [], np.arange(len(size)), 0
        while True:
            keep = size[row] > depth
            row, node = row[keep], node[keep]
            if not len(row):
                break
            key = (node << 21) | codes[begin[row] + depth]
            new = np.ones(len(row), bool)
            new[1:] = key[1:] != key[:-1]
            depth += 1
            node = total + np.cumsum(new) - 1
            keys.append(key[new])
            total += len(keys[-1])
            word = np.full(len(keys[-1]), -1)
            ends = size[row] == depth
            word[node[ends] - self.level[-1]] = row[ends]
            words.append(word)
            self.level.append(total)
        #: Of every node the row that ends there (-1: none); of every node but the roots its parent and code point.
        self.word, self.key = np.concatenate(words), np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.roots = self.level[1]
        self.first = np.searchsorted(self.key, np.arange(total + 1) << 21) + self.roots

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All children of the nodes, and for each the place of its parent among nodes."""
        many = self.first[nodes + 1] - self.first[nodes]
        of = np.repeat(np.arange(len(nodes)), many)
        return self.first[nodes][of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many), of

    def below(self, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a child of u and a child of v that have the same code point, for every pair (u, v)."""
        fewer = self.first[u + 1] - self.first[u] <= self.first[v + 1] - self.first[v]
        a, b = np.where(fewer, u, v), np.where(fewer, v, u)
        child, of = self.children(a)
        want = (b[of] << 21) | (self.key[child - self.roots] & ((1 << 21) - 1))
        place = np.searchsorted(self.key, want)
        found = np.flatnonzero(place < len(self.key))
        found = found[self.key[place[found]] == want[found]]
        x, y, fewer = child[found], place[found] + self.roots, fewer[of[found]]
        return np.where(fewer, x, y), np.where(fewer, y, x)

    def siblings(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of nodes of this depth with one parent."""
        nodes = np.arange(self.level[depth], self.level[depth + 1])
        before = nodes - self.first[self.key[nodes - self.roots] >> 21]
        v = np.repeat(nodes, before)
        return v - 1 - (np.arange(len(v)) - np.repeat(np.cumsum(before) - before, before)), v

    def near(self, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows at distance one, the first of which has the length that short gives for its partition's rows."""
        none = np.zeros(0, np.int64)
        replaced, inserted, out = (none, none), (none, none), []
        for depth in range(len(self.level) - 1):
            nodes = np.arange(self.level[depth], self.level[depth + 1])
            if depth:
                replaced = _both(self.below(*replaced), self.siblings(depth))
                inserted = self.below(*inserted)
            child, of = self.children(nodes)
            inserted = _both(inserted, (nodes[of], child))
            for u, v in (replaced, inserted):
                a, b = self.word[u], self.word[v]
                both = (a >= 0) & (b >= 0)
                a, b = a[both], b[both]
                right = short[a] == depth
                out.append((a[right], b[right]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (none, none)


def _both(p: tuple, q: tuple) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate((p[0], q[0])), np.concatenate((p[1], q[1]))


def _joined(rows: pa.Table) -> pa.RecordBatch:
    """Near pairs within the partitions of rows, which are sorted by key and rest and hold each partition whole."""
    key = rows["key"].combine_chunks()
    new = np.ones(len(key), bool)
    new[1:] = np.asarray(pc.not_equal(key[1:], key[:-1]))
    group = np.cumsum(new) - 1
    alone = np.bincount(group)[group] == 1
    rows, group = rows.filter(pa.array(~alone)), group[~alone]
    group = np.unique(group, return_inverse=True)[1] if len(group) else group
    a, b = Trie(group, rows["rest"].combine_chunks()).near(np.asarray(rows["short"]))
    word, n = rows["word"].combine_chunks(), rows["n"].combine_chunks()
    return pa.RecordBatch.from_arrays([word.take(pa.array(a)), n.take(pa.array(a)), word.take(pa.array(b)), n.take(pa.array(b))], names=["a", "n_a", "b", "n_b"])


def _join(batches):
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK:
            rows = pa.Table.from_batches(held)
            key = rows["key"].combine_chunks()
            other = np.flatnonzero(np.asarray(pc.not_equal(key, key[len(key) - 1])))  # all but the last partition, which may go on
            if len(other):
                whole = int(other[-1]) + 1
                yield _joined(rows.slice(0, whole))
                held = rows.slice(whole).combine_chunks().to_batches()
                size = sum(b.num_rows for b in held)
    if size:
        yield _joined(pa.Table.from_batches(held))
    K.release()


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """a, n_a, b, n_b: each pair of words (word, n) at distance one, once."""
    rows = partitions(words, group).repartition("key").sortWithinPartitions("key", "rest")
    return rows.mapInArrow(_join, "a string, n_a long, b string, n_b long").distinct()


# --- Forms and roots ---------------------------------------------------------------------------------------


def forms(words: DataFrame, times: int = TIMES, group: int = GROUP) -> DataFrame:
    """word, n, n_near, form, form_n: how many words are near, and the most frequent of them if it is so many times as frequent."""
    pair = near_words(words, group)
    each = pair.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))).alias("p")).select("p.*")
    best = each.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    out = words.join(best, "word", "left")
    much = -F.col("best.m") >= times * F.col("n")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(much, F.col("best.other")).alias("form"), F.when(much, -F.col("best.m")).alias("form_n"))


def with_roots(found: DataFrame) -> DataFrame:
    """found with root, the end of each word's chain of forms.

    A step leads to a word of several times the count, so chains end; pointers are doubled until none moves on. Only words
    with a form take part.
    """
    links = common.written(found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = common.written(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        common.drop_written(links)
        links = after.select("word", "root")
        if after.where("moved").isEmpty():
            return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", times: int = TIMES, group: int = GROUP) -> DataFrame:
    """word, n, n_near, form, form_n, root of the whole vocabulary."""
    words = common.written(vocabulary(docs, doc_id=doc_id, text=text), "vocabulary")
    return with_roots(common.written(forms(words, times, group), "forms"))
