"""The pipeline against a brute-force version of its stages, on a small corpus."""

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
import public_tokenizers as P
from lectern.llm import components, quality_rules
from tests.llm.test_operators import reference_bpe, split  # noqa: F401


def corpus():
    rng = random.Random(11)
    words = ["the", "of", "and", "stone", "été", "größe", "river", "house", "is", "tree", "walk", "green", "that", "seven"]
    make = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) if rng.random() < 0.6 else rng.choice(words) for _ in range(n))
    passage, item = make(60), make(30)
    texts = [make(rng.randint(60, 200)) for _ in range(12)]
    near = texts[0].split(" ")
    near[5] = "other"
    texts += [texts[0], " ".join(near), make(80) + "\n" + passage, passage + "\n" + make(70), make(90) + " " + item.upper() + " " + make(20), make(10), "", None, "$$$ ### " * 80, make(70) + " 日本é " + passage[:90]]
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], [(1, item), (2, "never seen words in any of these texts at all here")]


def kept_by_rules(t):
    w = split(t)
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    if len(w) < 50 or 100 * len(again) > 50 * len(w):
        return False
    stop = {x for ws in quality_rules.STOP_WORDS.values() for x in ws}
    lines = [x for x in t.split("\n") if split(x)]
    m = {
        "n_words": len(w), "repeat_ratio": len(again) / len(w), "mean_word_chars": sum(map(len, w)) / len(w), "symbol_ratio": len(re.findall(r"[#*$%&|<>]", t)) / len(w),
        "stop_ratio": sum(x.lower() in stop for x in w) / len(w), "dup_line_ratio": (len(lines) - len(set(lines))) / max(len(lines), 1),
    }
    return all((r.low is None or m[r.measure] >= r.low) and (r.high is None or m[r.measure] <= r.high) for r in quality_rules.RULES)


def brute(rows, items, encode):
    rows = [(i, t) for i, t, *_ in rows if t is not None and kept_by_rules(t)]
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in rows for w in [split(t.lower())]}
    root = components.union_find([(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])])
    rows = [(i, t) for i, t in rows if root.get(i, i) == i]
    first, cut = {}, []
    for i, t in sorted(rows):
        raw = t.encode()
        for s in range(len(raw) - 49):
            first.setdefault(raw[s : s + 50], i)
    for i, t in sorted(rows):
        raw, gone = t.encode(), set()
        for s in range(len(raw) - 49):
            if first[raw[s : s + 50]] < i:
                gone |= set(range(s, s + 50))
        out, at = [], 0
        for c in t:
            n = len(c.encode())
            if not all(k in gone for k in range(at, at + n)):
                out.append(c)
            at += n
        if not gone or out:
            cut.append((i, "".join(out)))
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)}))
    windows = {tuple(words(t)[k : k + 10]) for _, t in items for k in range(len(words(t)) - 9)}
    clean = [(i, t) for i, t in cut if not any(tuple(words(t)[k : k + 10]) in windows for k in range(len(words(t)) - 9))]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return [(i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(t.encode())) for i, t in clean for ids in [encode(t)]]


def test_pipeline(spark, tmp_path, reference_bpe):  # noqa: F811
    rows, items = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.PATTERN and [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "decontamination", "tokens"]
    want = brute(rows, items, reference_bpe.encode_ordinary)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(want) and 12 <= len(want) < 16


def test_near_duplicates_from_four_fifths(spark):
    """Pairs with similarities of 86 / 106 and 76 / 96: the first loses its copy, the second stays."""
    rows = []
    for i, n in enumerate((100, 90)):
        words = [f"w{i}x{k}" for k in range(n)]
        near = list(words)
        near[20], near[60] = "other", "another"
        rows += [(2 * i, " ".join(words), "en", "s", 1), (2 * i + 1, " ".join(near), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == [0, 2, 3]


def test_odd_documents(spark, tmp_path, reference_bpe):  # noqa: F811
    """Clashing names, null ids and texts, repeated rows, no rows, no benchmark items."""
    rows, items = corpus()
    names = ["doc_id", "Text", "kept", "text", "n_words", "removed", "hit_words", "component_id", "n_chars", "_node"]
    odd = [(i, "T", "k", t, 5, "r", None, "c", n, 1.5) for i, t, _, _, n in rows] + [(None, None, None, rows[0][1] + " of no id", None, None, None, None, None, None), (0, "T", "k", rows[0][1], 5, "r", None, "c", rows[0][4], 1.5)]
    docs = spark.createDataFrame(odd, "a long, b string, c string, d string, e int, f string, g string, h string, i long, j double").toDF(*names)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/full/benchmark.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    for folder in ("full", "none"):
        at = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, at, f"{tmp_path}/{folder}")
            assert out.columns == names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
            assert stage(spark, docs.limit(0), f"{tmp_path}/{folder}").count() == 0
            at = corpus_pipeline.common.written(out.toDF(*[f"x{i}" for i in range(len(names))]), "odd").toDF(*names)
        got = [tuple(r) for r in at.collect()]
        assert all(g[1:3] in (("T", "k"), (None, None)) for g in got) and {g[8] for g in got if g[3]} == {len(g[3]) if g[0] is not None else None for g in got if g[3]}
        tokens = corpus_pipeline.tokens(spark, at, "").collect()
        assert sorted(r.n_tokens for r in tokens) == sorted(len(reference_bpe.encode_ordinary(g[3] or "")) for g in got) and len(got) >= 12
    # the document without an id is the least, and document 0 its near copy
    assert None in {g[0] for g in got} and 0 not in {g[0] for g in got}
