"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the words (lower case, letters and digits), word pairs and pairs with one word between, hashed to
2**20 places; each counts once a document. Training runs over a bounded sample example by example: every coordinate has its own learning rate,
and the L1 term leaves most weights at exactly zero. The sample holds at most `SAMPLE` labelled rows and `PLACES` features of them all (rows of
the least id hashes), so that neither many rows nor long ones make it large.

Rate, L1 strength and number of passes are chosen inside the sample, from the grid `RATES` x `STRENGTHS` x 1 to `PASSES`: each pair is learnt in a
Spark task from four fifths of the sample, and what loses least on the other fifth, after so many passes, is then learnt from all of it. No other
labels take part in that. The few weights that are not zero are broadcast (at most 2**20 of 8 bytes) and looked up for all features of a slice at once.

Defined results: null and empty texts have no features and get the intercept's score. Equal texts have equal scores, so repeated rows do. An
empty table gives no rows. Of several labels of one id the greatest counts, of several texts the least; a sample without labels gives
0.5 to every text. Texts of any length count whole; one text's features, about 60 bytes for each of its bytes, must fit into a task.
Other columns are passed through whatever their names; columns with the operator's own names are replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from . import kernel as K
from .sampling import labelled_sample

BITS = 20
SAMPLE, PLACES = 12_000, 20_000_000
RATES, STRENGTHS, PASSES = (0.05, 0.2, 0.8, 3.2), (0.5, 2.0, 8.0, 32.0), 4


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a slice of texts, with the text of each (repeats are kept)."""
    w = K.Words(texts, K.ALNUM, lower=True)
    h, owner = w.hash, w.owner()
    parts = [(h, owner)]
    for gap, salt in ((1, 0x8CB92BA72F3D8DD7), (2, 0xD1B54A32D192ED03)):
        if len(h) > gap:
            same = owner[:-gap] == owner[gap:]
            parts.append((K.mix(h[:-gap] * K.U64(salt) + h[gap:])[same], owner[:-gap][same]))
    hashed, owner = (np.concatenate(x) for x in zip(*parts))
    return (hashed >> K.U64(64 - bits)).astype(np.int64), owner


@dataclass
class FTRL:
    """FTRL-proximal for logistic loss; place 2**bits is the intercept, which L1 spares."""

    bits: int = BITS
    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0

    def __post_init__(self):
        self.z = np.zeros((1 << self.bits) + 1)
        self.n = np.zeros((1 << self.bits) + 1)
        self.spare = np.full((1 << self.bits) + 1, self.l1)
        self.spare[-1] = 0.0

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = self.spare[at]
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        """One example: distinct places, the intercept last."""
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


@dataclass
class Model:
    """The weights that are not zero, and the intercept."""

    place: np.ndarray
    weight: np.ndarray
    intercept: float
    bits: int = BITS


class Examples:
    """Labels and distinct places of examples, in one array each."""

    def __init__(self, places: np.ndarray, ptr: np.ndarray, labels: np.ndarray, bits: int):
        self.places, self.ptr, self.labels, self.bits = places, ptr, labels, bits

    def __len__(self):
        return len(self.labels)

    def example(self, k: int) -> tuple[np.ndarray, int]:
        return np.append(self.places[self.ptr[k] : self.ptr[k + 1]], 1 << self.bits), int(self.labels[k])

    def loss(self, model: FTRL, some: range) -> float:
        """Mean logarithmic loss on some examples."""
        total = np.array([model.weights(self.example(k)[0]).sum() for k in some])
        sign = 1.0 - 2.0 * self.labels[some.start : some.stop]
        return float(np.logaddexp(0, sign * np.clip(total, -35, 35)).mean())


def passes_over(examples: Examples, some: range, passes: int, **options):
    """A model after each pass over some examples, each time in another order."""
    model, order = FTRL(examples.bits, **options), np.random.default_rng(7)
    for _ in range(passes):
        for k in (some.start + order.permutation(len(some))).tolist():
            model.learn(*examples.example(k))
        yield model


def chosen(spark: SparkSession, shared, n: int) -> dict:
    """alpha, l1 and passes: what loses least on the first fifth of n examples when learnt from the others. A task for each alpha and l1."""
    fifth = n // 5
    if not fifth:
        return {"alpha": 0.2, "l1": 0.5, "passes": 1}

    def run(batches):
        examples: Examples = shared.value
        for batch in batches:
            for alpha, l1 in zip(batch["alpha"].to_pylist(), batch["l1"].to_pylist()):
                got = [examples.loss(m, range(fifth)) for m in passes_over(examples, range(fifth, n), PASSES, alpha=alpha, l1=l1)]
                yield pa.RecordBatch.from_pydict({"loss": got, "alpha": [alpha] * PASSES, "l1": [l1] * PASSES, "passes": list(range(1, PASSES + 1))})
        K.release()

    grid = [(a, s) for a in RATES for s in STRENGTHS]
    cells = spark.createDataFrame(spark.sparkContext.parallelize(grid, len(grid)), "alpha double, l1 double")
    found = cells.mapInArrow(run, "loss double, alpha double, l1 double, passes long")
    best = min(map(tuple, found.collect()))  # a row for each of the grid's 64 cells
    return dict(zip(("alpha", "l1", "passes"), best[1:]))


def hashed_sample(sample: DataFrame, bits: int, most: int) -> Examples:
    """The sample's features. Rows are ordered by a checksum of their id; those behind the first `most` features are left out."""

    def hashed(batches):
        for whole in batches:
            for batch in K.slices(whole, "text"):
                at, owner = features(batch["text"], bits)
                key = np.unique((owner << bits) | at)
                off = np.searchsorted(key >> bits, np.arange(batch.num_rows + 1)).astype(np.int32)
                places = pa.ListArray.from_arrays(pa.array(off), pa.array((key & ((1 << bits) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch["_id"].cast(pa.string()), batch["label"], places], names=["id", "label", "places"])
        K.release()

    rows = common.written(sample.mapInArrow(hashed, "id string, label int, places array<int>"), "features")
    order = Window.orderBy(F.crc32(F.col("id").cast("binary")), "id")
    sizes = rows.select("id", F.size("places").alias("n"))  # SAMPLE rows at most
    inside = sizes.withColumn("n", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("n") <= most)
    got = rows.join(F.broadcast(inside.select("id")), "id", "left_semi").select("id", "label", "places").toArrow().combine_chunks()
    common.drop_written(rows)
    ids = got["id"].to_pylist()
    by = pa.array(sorted(range(len(ids)), key=lambda k: (zlib.crc32(ids[k].encode()), ids[k])), pa.int64())
    got = got.take(by)
    places = got["places"].combine_chunks()
    if isinstance(places, pa.ChunkedArray):
        places = places.chunk(0) if places.num_chunks else pa.array([], pa.list_(pa.int32()))
    size = np.asarray(places.value_lengths()).astype(np.int64)
    return Examples(np.asarray(places.flatten()), np.concatenate(([0], np.cumsum(size))), np.asarray(got["label"]), bits)


def train(sample: DataFrame, bits: int = BITS, most: int = PLACES, **options) -> Model:
    """sample: a bounded table of _id, text and label. options: alpha, l1 and passes, if they are not to be chosen."""
    spark, examples = sample.sparkSession, hashed_sample(sample, bits, most)
    if not {"alpha", "l1", "passes"} <= options.keys():
        shared = spark.sparkContext.broadcast(examples)
        options = chosen(spark, shared, len(examples)) | options
        shared.unpersist()
    model = FTRL(bits)
    for model in passes_over(examples, range(len(examples)), options.pop("passes"), **options):
        pass
    w = model.weights(slice(None))
    place = np.flatnonzero(w[:-1])
    return Model(place.astype(np.int32), w[place].astype(np.float32), float(w[-1]), bits)


def score(docs: DataFrame, model: Model, *, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a score from 0 to 1."""
    shared, c = docs.sparkSession.sparkContext.broadcast(model), common.Columns(docs, (out,), text=text)

    def run(batches):
        m = shared.value
        table = np.zeros(1 << m.bits, np.float32)
        table[m.place] = m.weight
        for whole in batches:
            for batch in K.slices(whole, "text"):
                at, owner = features(batch["text"], m.bits)
                hit = np.flatnonzero(table[at])
                key = np.unique((owner[hit] << m.bits) | at[hit])
                total = np.bincount(key >> m.bits, weights=table[key & ((1 << m.bits) - 1)], minlength=batch.num_rows) + m.intercept
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))], names=[*batch.schema.names, out])
            K.release()

    return c.result(c.frame.mapInArrow(run, c.frame.withColumn(out, F.lit(0.0)).schema))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, *, label: str = "toxic", sample: int = SAMPLE, **options) -> Model:
    return train(labelled_sample(docs, labels, label, learn, sample), **options)
