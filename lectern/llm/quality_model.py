"""Quality scores: a generalised additive model with pairwise interactions.

Each feature is cut into bins; the model is a table of additive scores for each feature and for the most useful pairs of
features. Tables are learnt by cyclic boosting: round after round each feature in turn gets a shallow tree on its bins,
fitted to what the other tables leave over, and a small share of it is added to the table. Pairs follow on the residuals, with
trees of one cut on either axis. Scoring is a bin look-up and an addition for each table, over whole slices.

Training uses a bounded sample (`SAMPLE` labelled rows) of 16 numbers each.

Defined results: null and empty texts have all features 0. Equal texts have equal scores, so repeated rows do. An empty table gives no
rows. Of several labels of one id the greatest counts, of several texts the least; a sample without labels gives 0.5 to every text. Of
cuts that gain alike the first is taken. Texts of any length count whole; one text's words and hashes, about 60 bytes for each of its
bytes, must fit into a task. Other columns are passed through whatever their names; columns with the operator's own names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from . import kernel as K
from .sampling import labelled_sample

SAMPLE = 20_000
BINS, PAIR_BINS = 32, 8
FEATURES = (
    "log_words", "word_bytes", "upper", "digits", "symbols", "marks", "exclamations", "pipes", "line_ends",
    "beyond_ascii", "short_words", "distinct_words", "repeated_lines", "spaces", "longest_word", "repeated_triples",
)


def _of(chars: str) -> np.ndarray:
    return K._table(lambda b: chr(b) in chars)


_CLASSES = {
    "upper": K._table(lambda b: 65 <= b <= 90),
    "digits": K._table(lambda b: 48 <= b <= 57),
    "symbols": _of("#*$%&|<>@^~{}[]\\/=+_"),
    "marks": _of(".,;:?"),
    "exclamations": _of("!"),
    "pipes": _of("|"),
    "line_ends": _of("\n"),
    "beyond_ascii": K._table(lambda b: b >= 128),
    "spaces": _of(" \t"),
}


def measure(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text."""
    w = K.Words(texts)
    n = np.maximum(np.diff(w.offsets) - 1, 0)  # without the added space
    size, words = np.maximum(n, 1), np.maximum(w.counts, 1)
    out = {}
    for name, kind in _CLASSES.items():
        out[name] = K.per_text(kind[w.buf], w.offsets) / size
    out["spaces"] = np.maximum(out["spaces"] - 1 / size, 0)
    length, owner = w.end - w.start, w.owner()
    out["log_words"] = np.log1p(w.counts)
    out["word_bytes"] = K.per_text(length, w.ptr) / words
    out["short_words"] = K.per_text(length <= 3, w.ptr) / words
    longest = np.zeros(len(words))
    np.maximum.at(longest, owner, length)
    out["longest_word"] = longest
    out["distinct_words"] = _distinct(w.hash, owner, len(words)) / words
    triples = K.window_hash(K.prefix_sums(w.hash), 3)
    inside = w.room(3)[: len(triples)]
    n_triples = np.bincount(owner[: len(triples)][inside], minlength=len(words))
    out["repeated_triples"] = 1 - _distinct(triples[inside], owner[: len(triples)][inside], len(words)) / np.maximum(n_triples, 1)
    out["repeated_triples"][n_triples == 0] = 0
    ends = np.flatnonzero((w.buf == 10) | np.isin(np.arange(len(w.buf)), w.offsets[1:] - 1))
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    full = ends > starts
    starts, ends = starts[full], ends[full]
    of = np.searchsorted(w.offsets, starts, side="right") - 1
    lines = np.bincount(of, minlength=len(words))
    h = K.span_hash(K.byte_prefix(w.buf), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    out["repeated_lines"] = 1 - _distinct(h, of, len(words)) / np.maximum(lines, 1)
    out["repeated_lines"][lines == 0] = 0
    return np.stack([out[f] for f in FEATURES], axis=1)


def _distinct(h: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    order = np.lexsort((h, owner))
    h, o = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=texts)


@dataclass
class Additive:
    """Bin edges and tables; pairs use coarser edges."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    intercept: float

    def decision(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for f, (e, t) in enumerate(zip(self.edges, self.tables)):
            out += t[np.searchsorted(e, x[:, f], side="right")]
        for (f, g), t in zip(self.pairs, self.pair_tables):
            out += t[np.searchsorted(self.coarse[f], x[:, f], side="right"), np.searchsorted(self.coarse[g], x[:, g], side="right")]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.decision(x), -35, 35)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def _leaf(g, h, l2: float = 2.0):
    return g / (h + l2)


def _tree(g: np.ndarray, h: np.ndarray, splits: int = 3) -> np.ndarray:
    """Leaf value of each bin: the bins are cut up to splits times where the gain is greatest."""
    parts = [(0, len(g))]
    gain_of = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 2.0)
    for _ in range(splits):
        best = (1e-9, None, 0)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            cg, ch = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            tg, th = g[a:b].sum(), h[a:b].sum()
            gain = cg**2 / (ch + 2.0) + (tg - cg) ** 2 / (th - ch + 2.0) - gain_of(a, b)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], k, a + at + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree with one cut on either axis: its gain and leaf values."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a, b, c, d = (cg[:-1, :-1], cg[:-1, -1:] - cg[:-1, :-1], cg[-1:, :-1] - cg[:-1, :-1], None)
    d = cg[-1, -1] - a - b - c
    ha, hb, hc = ch[:-1, :-1], ch[:-1, -1:] - ch[:-1, :-1], ch[-1:, :-1] - ch[:-1, :-1]
    hd = ch[-1, -1] - ha - hb - hc
    gain = sum(x**2 / (y + 2.0) for x, y in ((a, ha), (b, hb), (c, hc), (d, hd)))
    out = np.zeros(g.shape)
    if not gain.size:
        return 0.0, out
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = _leaf(g[rows, cols].sum(), h[rows, cols].sum())
    return float(gain[i, j]), out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 40, n_pairs: int = 6, rate: float = 0.15) -> Additive:
    """Learns the tables from features x and labels y (0 or 1)."""
    p = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    m = Additive([_edges(x[:, f], BINS) for f in range(x.shape[1])], [], [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])], [], [], float(np.log(p / (1 - p))))
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(m.edges)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    total = np.full(len(y), m.intercept)

    def slopes():
        q = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for f, b in enumerate(bins):
            g, h = slopes()
            n = len(m.tables[f])
            step = rate * _tree(np.bincount(b, g, n), np.bincount(b, h, n))
            m.tables[f] += step
            total += step[b]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(m.coarse)]
    sizes = [len(e) + 1 for e in m.coarse]

    def grid(f, g_, values):
        return np.bincount(coarse[f] * sizes[g_] + coarse[g_], values, sizes[f] * sizes[g_]).reshape(sizes[f], sizes[g_])

    g, h = slopes()
    gains = sorted(((_quadrants(grid(a, b, g), grid(a, b, h))[0], a, b) for a, b in combinations(range(x.shape[1]), 2) if sizes[a] > 1 and sizes[b] > 1), reverse=True)
    m.pairs = [(a, b) for _, a, b in gains[:n_pairs]]
    m.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in m.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(m.pairs):
            g, h = slopes()
            step = rate * _quadrants(grid(a, b, g), grid(a, b, h))[1]
            m.pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return m


def train(sample: DataFrame, **options) -> Additive:
    """sample: a bounded table of text and label, measured in tasks; the boosting runs here."""

    def measured(batches):
        for whole in batches:
            for batch in K.slices(whole, "text"):
                x = measure(batch["text"])
                yield pa.RecordBatch.from_arrays([batch["_id"].cast(pa.string()), batch["label"], pa.array(list(x), pa.list_(pa.float64()))], names=["id", "label", "x"])

    got = sample.mapInArrow(measured, "id string, label int, x array<double>").toPandas().sort_values("id")
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, len(FEATURES)))
    return boost(x, got["label"].to_numpy(dtype=float), **options)


def score(docs: DataFrame, model: Additive, *, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a score from 0 to 1."""
    shared, c = docs.sparkSession.sparkContext.broadcast(model), common.Columns(docs, (out,), text=text)

    def run(batches):
        m = shared.value
        for whole in batches:
            for batch in K.slices(whole, "text"):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(m.probability(measure(batch["text"])))], names=[*batch.schema.names, out])
            K.release()

    return c.result(c.frame.mapInArrow(run, c.frame.withColumn(out, F.lit(0.0)).schema))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, *, label: str = "quality", sample: int = SAMPLE, **options) -> Additive:
    return train(labelled_sample(docs, labels, label, learn, sample), **options)
