"""Language by cross-parsing: the language whose labelled text parses a text into the fewest phrases wins.

For each language a suffix automaton of a bounded sample of its labelled texts is built in a task. A text is read from left to right; a
phrase goes on as long as it occurs in the sample, which the automaton knows from one transition for each symbol, so that phrases are the longest
matches. With c phrases over n symbols and a sample of m symbols, the text costs c * (log2(m + 1) + log2(155)) / n bits a symbol, for a place in the
sample and one of the 155 symbols with each phrase, so that small samples gain nothing; the language with the lowest cost is predicted (ties: the smallest name). The score says how much lower it is than the second, as a share of that: 0 for a
tie, towards 1 for a clear case; 1 if only one language was learnt.

Symbols are the bytes of the lower-cased text, each run of ASCII characters other than letters being one space. Texts are parsed in stretches of
`STRETCH` symbols, many side by side in one array; at a stretch's end the phrase ends, too. Every stretch of a text counts.

The sample: of each language the rows of the least id hashes, at most `ROWS` and until `SAMPLE_BYTES` of text are reached (rows that are longer
alone are passed over). With very many languages each gets less, so that all automata together stay within `MODEL_BYTES`; more than `LANGUAGES`
are an error.

Defined results: null texts and texts without a letter are `und` with score 0; rows without id, language or text teach nothing; equal texts get equal
results, so repeated rows do; with nothing learnt all are `und`; an empty table gives no rows. Texts of any length count whole. Other columns are
passed through whatever their names; columns with the operator's own names are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from . import kernel as K

SAMPLE_BYTES, ROWS = 32 << 10, 400
MODEL_BYTES, LANGUAGES = 192 << 20, 5_000
STRETCH = 256
UNKNOWN = "und"
OUTPUT = ("lang_pred", "score")
#: Bytes to symbols: letters of ASCII, one space, and each byte beyond.
_CODE = np.array([b - 0x60 if 0x61 <= b <= 0x7A else b - 0x80 + 27 if b >= 0x80 else 0 for b in range(256)], dtype=np.uint8)
_CODES = 27 + 128


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts (lower case already) one after another, and where each text begins."""
    buf, off = K.buffers(texts)
    code = _CODE[buf]
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    keep[off[:-1][off[:-1] < len(code)]] = True
    return code[keep], np.concatenate(([0], np.cumsum(keep)))[off]


class SuffixAutomaton:
    """All factors of a sequence, built symbol by symbol: states are sets of equal end positions, with links to longer suffixes' sets."""

    def __init__(self, sequence):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        last = 0
        for c in sequence:
            last = self._extend(last, c)

    def _state(self, size: int, link: int, follow: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(follow)
        return len(self.size) - 1

    def _extend(self, last: int, c: int) -> int:
        new, p = self._state(self.size[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p < 0:
            return new
        q = self.next[p][c]
        if self.size[q] != self.size[p] + 1:
            # q's longer factors do not end where the new one does: the shorter ones get a state of their own
            part = self._state(self.size[p] + 1, self.link[q], dict(self.next[q]))
            while p >= 0 and self.next[p].get(c) == q:
                self.next[p][c] = part
                p = self.link[p]
            self.link[q] = q = part
        self.link[new] = q
        return new


def steps(automaton: SuffixAutomaton, used: np.ndarray) -> np.ndarray:
    """A table over (state, symbol): the place of the next state's row times 4, plus the phrases that end. Symbol 0 is any that the sample has not; used[i] is symbol i + 1."""
    wide = len(used) + 1
    number = np.zeros(_CODES + 1, np.int64)
    number[used] = np.arange(1, wide)
    root = np.zeros(wide, np.int64)
    for c, to in automaton.next[0].items():
        if c < _CODES:
            root[number[c]] = to
    # A phrase that cannot go on ends (not at the root, where none has begun); a symbol that no phrase begins with is one itself.
    table = np.tile(root * wide * 4 + 1 + (root == 0), (len(automaton.next), 1))
    table[0] = np.where(root == 0, 1, root * wide * 4)
    for state, follow in enumerate(automaton.next):
        for c, to in follow.items():
            if c < _CODES:
                table[state, number[c]] = to * wide * 4
    return table.astype(np.int32)


@dataclass
class Model:
    """Of each language its name, symbols, size of sample and table."""

    names: list[str]
    used: list[np.ndarray]
    sizes: list[int]
    tables: list[np.ndarray]


def sample(rows: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """lang and text of the rows (_id, lang, text) to learn from. counts: lang, n.

    Rows are ordered by a hash of id and text. Of each language only the share with the lowest hashes that holds about twice as many rows as are
    wanted is ranked, so that a task ranks few rows however many there are.
    """
    rows = rows.where(F.octet_length("text") <= size).withColumn("_hash", F.xxhash64("_id", "text"))
    ids = rows.join(F.broadcast(counts), "lang").where(F.shiftrightunsigned("_hash", 1) / float(1 << 63) * F.col("n") <= 2 * ROWS + 200)
    ids = ids.select("lang", "_id", "_hash", F.octet_length("text").alias("_size")).distinct()
    order = Window.partitionBy("lang").orderBy("_hash", "_id")
    ids = ids.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= ROWS)
    ids = ids.withColumn("_before", F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    chosen = ids.where(F.col("_before") < size).select("lang", "_id", "_hash")
    return rows.join(F.broadcast(chosen), ["lang", "_id", "_hash"], "left_semi").select("lang", "_hash", "text").distinct()


def _learnt(key, table):
    """One language's automaton as a table of steps."""
    table = table.sort_by([("_hash", "ascending"), ("text", "ascending")])
    code, ptr = symbols(pc.utf8_lower(table["text"].combine_chunks()))
    used = np.unique(code).astype(np.int64)
    end = _CODES  # between texts; no text holds it
    sequence: list[int] = []
    for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist()):
        sequence += [*code[a:b].tolist(), end]
    found = steps(SuffixAutomaton(sequence), used)
    K.release()
    return pa.table({"lang": [key[0].as_py()], "used": pa.array([used.tolist()], pa.list_(pa.int64())), "size": [len(code)], "steps": pa.array([found.tobytes()], pa.binary())})


def fit(docs: DataFrame, learn: Column, *, size: int = SAMPLE_BYTES, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Automata of all languages among the rows where learn holds."""
    c = common.Columns(docs.withColumn("_learn", learn), _id=doc_id, text=text, lang=lang, _may="_learn")
    rows = c.only().where("_may AND _id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").select("_id", F.col("lang").cast("string").alias("lang"), "text")
    counts = common.written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    languages = counts.count()
    if languages > LANGUAGES:
        raise ValueError(f"{languages} languages: the automata of more than {LANGUAGES} do not fit")
    size = min(size, MODEL_BYTES // (8 * (_CODES + 1) * max(languages, 1)))  # at most two states for each byte of text, 4 bytes for each symbol
    got = sample(rows, counts, size).groupBy("lang").applyInArrow(_learnt, "lang string, used array<long>, size long, steps binary").where("size > 0").toArrow().sort_by("lang")
    used = [np.array(u, np.int64) for u in got["used"].to_pylist()]
    return Model(got["lang"].to_pylist(), used, got["size"].to_pylist(), [np.frombuffer(s, np.int32) for s in got["steps"].to_pylist()])


class Parser:
    """Phrases of many texts at once."""

    def __init__(self, model: Model):
        self.model = model
        self.codes = []
        for used in model.used:
            code = np.zeros(_CODES, np.int32)
            code[used] = np.arange(1, len(used) + 1)
            self.codes.append(code)

    def phrases(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(phrases of each text and language, symbols of each text)."""
        code, ptr = symbols(texts)
        length = np.diff(ptr)
        lanes = -(-length // STRETCH)
        text = np.repeat(np.arange(len(length)), lanes)
        start = ptr[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * STRETCH
        size = np.minimum(ptr[1:][text] - start, STRETCH)
        order = np.argsort(-size, kind="stable")
        text, start, size = text[order], start[order], size[order]
        alive = len(size) - np.searchsorted(size[::-1], np.arange(STRETCH), side="right")  # lanes longer than k
        # symbol k of every lane stands together
        lane = np.minimum(start + np.arange(STRETCH)[:, None], max(len(code) - 1, 0)) if len(code) else np.zeros((STRETCH, 0), np.int64)
        ordered = code[lane]
        out = np.zeros((len(length), len(self.model.names)), np.int64)
        for k, (number, table) in enumerate(zip(self.codes, self.model.tables)):
            mine = number[ordered]
            state, count = np.zeros(len(text), np.int32), np.zeros(len(text), np.int64)
            for j in range(STRETCH):
                n = int(alive[j])
                if not n:
                    break
                step = table[state[:n] + mine[j, :n]]
                count[:n] += step & 3
                state[:n] = step >> 2
            count += state > 0
            out[:, k] = np.bincount(text, weights=count, minlength=len(length)).astype(np.int64)
        return out, length

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of the best language, score) of each text."""
        found, length = self.phrases(texts)
        cost = found * np.array([math.log2(m + 1) + math.log2(_CODES) for m in self.model.sizes]) / np.maximum(length, 1)[:, None]
        best = np.argmin(cost, axis=1)
        if cost.shape[1] == 1:
            return best, np.ones(len(best))
        least = np.partition(cost, 1, axis=1)
        return best, 1.0 - least[:, 0] / np.maximum(least[:, 1], 1e-9)


def predict(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """docs with lang_pred and score."""
    c = common.Columns(docs, OUTPUT, text=text)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    frame = c.frame.withColumn("_lettered", lettered)
    schema = c.frame.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    if not model.names:
        return c.result(c.frame.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)}))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        parser = Parser(shared.value)
        names = np.array([*shared.value.names, UNKNOWN], dtype=object)
        for whole in batches:
            for batch in K.slices(whole, "text", 1 << 20):
                best, score = parser.predict(pc.utf8_lower(batch["text"]))
                known = np.asarray(batch["_lettered"])
                columns = batch.columns[:-1]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(names[np.where(known, best, len(names) - 1)], pa.string()), pa.array(np.where(known, score, 0.0))], names=schema.names)
            K.release()

    return c.result(frame.mapInArrow(run, schema))
