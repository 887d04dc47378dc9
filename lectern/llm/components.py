"""Connected components of a link table, without bringing links or components to the driver.

Each partition first contracts its links with a union-find forest. Rounds of large-star and small-star then hang every
node below the least node it can reach; a round's edges are a written table, so that lineage stays short. The least
neighbour of a node is a pre-aggregated minimum, so a node with very many links is no single task's work.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def union_find(pairs) -> dict[int, int]:
    """The least node that each node reaches."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _contract(batches):
    """Each batch's links as a forest of depth one."""
    for batch in batches:
        found = [(x, r) for x, r in union_find(zip(batch["u"].to_pylist(), batch["v"].to_pylist())).items() if x != r]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], names=["u", "v"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of links; the component is its least node. Links of a node with itself do nothing.

    Rounds go on until one changes nothing; their number grows with the logarithm of the longest path.
    """
    edges = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    edges = common.written(edges.mapInArrow(_contract, "u long, v long").distinct(), "forest")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: all neighbours are smaller here, each hangs below the least of them
        down = large.where("u <> v").distinct()
        root = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(root.select("u", F.col("m").alias("v")))
        after = common.written(small.where("u <> v").distinct(), "forest")
        if _digest(after) == _digest(edges):
            roots = after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        common.drop_written(edges)
        edges = after


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
