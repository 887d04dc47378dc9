"""The registered model queries against plain-Python versions of their learners, on the smallest tables."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lectern.llm import quality_model, toxicity
from lectern.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tables():
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    labels = pq.read_table(f"{SF}/labels.parquet").to_pylist()
    return dict(zip(docs["doc_id"], docs["text"])), labels


def crc(i):
    return zlib.crc32(str(i).encode())


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


class PlainFTRL:
    def __init__(self, alpha, l1):
        self.z, self.n, self.alpha, self.l1 = {}, {}, alpha, l1

    def weight(self, i):
        z, l1 = self.z.get(i, 0.0), 0.0 if i == "bias" else self.l1
        if abs(z) <= l1:
            return 0.0
        return -(z - math.copysign(l1, z)) / ((1.0 + math.sqrt(self.n.get(i, 0.0))) / self.alpha + 1.0)

    def total(self, places):
        return sum(self.weight(i) for i in places)

    def learn(self, places, y):
        weights = {i: self.weight(i) for i in places}
        g = sigmoid(sum(weights.values())) - y
        for i, w in weights.items():
            n = self.n.get(i, 0.0)
            self.z[i] = self.z.get(i, 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / self.alpha * w
            self.n[i] = n + g * g


def plain_toxicity():
    texts, labels = tables()
    places = {i: [*sorted(set(toxicity.features(pa.array([t], pa.string()))[0].tolist())), "bias"] for i, t in texts.items()}
    known = {}
    for r in labels:
        if r["doc_id"] in texts and r["toxic"] is not None and crc(r["doc_id"]) % 4 != 2:
            known[r["doc_id"]] = max(known.get(r["doc_id"], 0), r["toxic"])
    examples = [(places[i], known[i]) for i in sorted(known, key=lambda i: (crc(i), str(i)))]

    def after_passes(some, passes, alpha, l1):
        model, order = PlainFTRL(alpha, l1), np.random.default_rng(7)
        for _ in range(passes):
            for k in order.permutation(len(some)).tolist():
                model.learn(*some[k])
            yield model

    fifth = len(examples) // 5
    tried = []
    for alpha in (0.05, 0.2, 0.8, 3.2):
        for l1 in (0.5, 2.0, 8.0, 32.0):
            for k, m in enumerate(after_passes(examples[fifth:], 4, alpha, l1)):
                loss = sum(math.log1p(math.exp(max(-35.0, min(35.0, m.total(p))) * (1 - 2 * y))) for p, y in examples[:fifth]) / fifth
                tried.append((loss, alpha, l1, k + 1))
    _, alpha, l1, passes = min(tried)
    *_, model = after_passes(examples, passes, alpha, l1)
    return {i: sigmoid(model.total(p)) for i, p in places.items()}


def quantiles(values, bins):
    values, out = sorted(values), []
    for k in range(1, bins):
        at = k / bins * (len(values) - 1)
        low = int(at)
        high = min(low + 1, len(values) - 1)
        out.append(values[low] + (values[high] - values[low]) * (at - low))
    return sorted(set(out))


def bin_of(edges, x):
    return sum(e <= x for e in edges)


def plain_tree(g, h):
    """Up to three cuts of the bins, each where the gain is greatest."""
    gain = lambda a, b: sum(g[a:b]) ** 2 / (sum(h[a:b]) + 2)
    parts = [(0, len(g))]
    for _ in range(3):
        cuts = [(gain(a, c) + gain(c, b) - gain(a, b), -k, -c) for k, (a, b) in enumerate(parts) for c in range(a + 1, b)]
        best = max(cuts, default=(0, 0, 0))
        if best[0] <= 1e-9:
            break
        a, b = parts.pop(-best[1])
        parts += [(a, -best[2]), (-best[2], b)]
    out = [0.0] * len(g)
    for a, b in parts:
        for k in range(a, b):
            out[k] = sum(g[a:b]) / (sum(h[a:b]) + 2)
    return out


def plain_quadrants(g, h):
    rows, cols = len(g), len(g[0])
    best, found = 0.0, None
    part = lambda m, r, c: sum(m[i][j] for i in r for j in c)
    for i in range(1, rows):
        for j in range(1, cols):
            quads = [(r, c) for r in (range(i), range(i, rows)) for c in (range(j), range(j, cols))]
            gain = sum(part(g, r, c) ** 2 / (part(h, r, c) + 2) for r, c in quads)
            if found is None or gain > best + 1e-12:
                best, found = gain, quads
    out = [[0.0] * cols for _ in range(rows)]
    for r, c in found or []:
        leaf = part(g, r, c) / (part(h, r, c) + 2)
        for i in r:
            for j in c:
                out[i][j] = leaf
    return best, out


def plain_additive(x, y, score, rounds, pair_rounds, n_pairs):
    """Cyclic boosting of tables, then of pair tables; the scores of the rows of score."""
    n, width = len(y), len(x[0])
    edges, coarse = [quantiles([r[f] for r in x], 32) for f in range(width)], [quantiles([r[f] for r in x], 8) for f in range(width)]
    fine, rough = [[bin_of(edges[f], r[f]) for r in x] for f in range(width)], [[bin_of(coarse[f], r[f]) for r in x] for f in range(width)]
    p = min(max(sum(y) / n, 1e-3), 1 - 1e-3)
    base = math.log(p / (1 - p))
    total, tables = [base] * n, [[0.0] * (len(e) + 1) for e in edges]

    def slopes():
        q = [sigmoid(t) for t in total]
        return [a - b for a, b in zip(y, q)], [b * (1 - b) for b in q]

    for _ in range(rounds):
        for f in range(width):
            g, h = slopes()
            sums = [[0.0] * len(tables[f]) for _ in range(2)]
            for k, b in enumerate(fine[f]):
                sums[0][b] += g[k]
                sums[1][b] += h[k]
            step = [0.15 * v for v in plain_tree(*sums)]
            tables[f] = [a + s for a, s in zip(tables[f], step)]
            total = [t + step[b] for t, b in zip(total, fine[f])]

    def grid(a, b, values):
        m = [[0.0] * (len(coarse[b]) + 1) for _ in range(len(coarse[a]) + 1)]
        for k, v in enumerate(values):
            m[rough[a][k]][rough[b][k]] += v
        return m

    g, h = slopes()
    gains = sorted(((plain_quadrants(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(width) for b in range(a + 1, width) if coarse[a] and coarse[b]), reverse=True)
    pairs = [(a, b) for _, a, b in gains[:n_pairs]]
    pair_tables = {c: [[0.0] * (len(coarse[c[1]]) + 1) for _ in range(len(coarse[c[0]]) + 1)] for c in pairs}
    for _ in range(pair_rounds):
        for a, b in pairs:
            g, h = slopes()
            step = plain_quadrants(grid(a, b, g), grid(a, b, h))[1]
            t = pair_tables[a, b]
            pair_tables[a, b] = [[v + 0.15 * s for v, s in zip(r, q)] for r, q in zip(t, step)]
            total = [v + 0.15 * step[rough[a][k]][rough[b][k]] for k, v in enumerate(total)]
    out = []
    for r in score:
        v = base + sum(tables[f][bin_of(edges[f], r[f])] for f in range(width))
        out.append(sigmoid(v + sum(pair_tables[a, b][bin_of(coarse[a], r[a])][bin_of(coarse[b], r[b])] for a, b in pairs)))
    return out


def run(spark, name, folder=SF):
    return {r.doc_id: r for r in QUERIES[name](spark, folder).select("doc_id", "held_out", "score", "predicted").collect()}


def test_toxicity_query_equals_a_plain_learner(spark):
    want, got = plain_toxicity(), run(spark, "op2_toxicity")
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert r.held_out == (crc(i) % 4 == 2) and r.score == pytest.approx(want[i], abs=1e-5) and r.predicted == int(r.score >= 0.3)


def test_options_come_from_learning_rows_only(spark, tmp_path):
    """Held-out labels turned around: rate, strength and passes are the same. And the sample keeps to its bound of features."""
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    turned = labels.withColumn("toxic", F.when(held_out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    found = []
    for known in (labels, turned):
        sample = toxicity.labelled_sample(docs, known, "toxic", ~held_out, toxicity.SAMPLE)
        e = toxicity.hashed_sample(sample, toxicity.BITS, toxicity.PLACES)
        found.append(toxicity.chosen(spark, spark.sparkContext.broadcast(e), len(e)))
    assert found[0] == found[1] and set(found[0]) == {"alpha", "l1", "passes"}
    small = toxicity.hashed_sample(sample, toxicity.BITS, 20_000)
    assert 0 < len(small) < len(e) and len(small.places) <= 20_000 and small.places.tolist() == e.places[: len(small.places)].tolist()


def test_additive_model_equals_a_plain_learner():
    rng = np.random.default_rng(3)
    x = np.round(rng.random((120, 4)), 2)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4)).astype(float)
    model = quality_model.boost(x, y, rounds=12, pair_rounds=6, n_pairs=2)
    want = plain_additive(x.tolist(), y.tolist(), x.tolist(), 12, 6, 2)
    assert model.probability(x) == pytest.approx(want, abs=1e-9) and len(model.pairs) == 2


def test_quality_query_equals_its_contract(spark):
    texts, labels = tables()
    known = {r["doc_id"]: r["quality"] for r in labels if r["doc_id"] in texts and crc(r["doc_id"]) % 3 != 1}
    ids = sorted(known, key=str)
    x = quality_model.measure(pa.array([texts[i] for i in ids], pa.string()))
    model = quality_model.boost(x, np.array([known[i] for i in ids], float))
    got = run(spark, "op7_quality_model")
    every = sorted(texts)
    want = dict(zip(every, model.probability(quality_model.measure(pa.array([texts[i] for i in every], pa.string()))).tolist()))
    for i, r in got.items():
        assert r.held_out == (crc(i) % 3 == 1) and r.score == pytest.approx(want[i], abs=1e-9) and r.predicted == int(r.score >= 0.5)


@pytest.mark.parametrize(("name", "label", "modulus", "remainder"), [("op2_toxicity", "toxic", 4, 2), ("op7_quality_model", "quality", 3, 1)])
def test_held_out_labels_are_not_read(name, label, modulus, remainder, spark, tmp_path):
    docs, labels = pq.read_table(f"{SF}/documents.parquet"), pq.read_table(f"{SF}/labels.parquet").to_pylist()
    for r in labels:
        if crc(r["doc_id"]) % modulus == remainder:
            r[label] = 1 - r[label]
    pq.write_table(docs, f"{tmp_path}/documents.parquet")
    pq.write_table(pa.Table.from_pylist(labels), f"{tmp_path}/labels.parquet")
    assert run(spark, name, str(tmp_path)) == run(spark, name)
