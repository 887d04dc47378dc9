"""Alert simulation: one pass over the texts, and all of it against plain Python."""

import random
import re

from lectern.functions import text as T
from lectern.operators.alerts import AlertConfig, simulate

CONFIG = AlertConfig({"g": ("reform", "un reform"), "h": ("peace",)})


def made(n, seed=3):
    rng = random.Random(seed)
    texts = [None, "", "  \n", "reform", " UN \nReform "]
    for _ in range(n - len(texts)):
        texts.append(rng.choice(["", " "]) + rng.choice([" ", "  "]).join(rng.choice(["word", "reform", "UN", "peace", "x,"]) for _ in range(rng.randint(1, 200))) + rng.choice(["", "\n"]))
    return [(f"d{i % 3}", f"{i:012d}", t) for i, t in enumerate(texts)]


def plain(rows):
    hits, clock = set(), {}
    for day, slug, text in sorted(rows):
        w = [x for x in re.split(r"\s+", text or "") if x]
        n = 1 + max(0, -(-(len(w) - CONFIG.window) // CONFIG.hop)) if w else 0
        for c in range(n):
            chunk = " ".join(w[c * CONFIG.hop : c * CONFIG.hop + CONFIG.window])
            for k in CONFIG.keywords:
                found = len(re.findall(rf"(?i)\b{re.escape(k)}\b", chunk))
                if found:
                    hits.add((day, slug, c, k, found, clock.get(day, 0) + c * CONFIG.hop))
        clock[day] = clock.get(day, 0) + n * CONFIG.hop + CONFIG.gap
    picks, last = set(), {}
    for day, _, _, k, _, t in sorted(hits, key=lambda h: h[5]):
        if t - last.get((day, k), -1e9) >= CONFIG.cooldown:
            last[day, k] = t
            picks.add((day, k, t))
    return hits, picks


def test_simulation_equals_plain_python(spark):
    rows = made(60)
    got = simulate(spark.createDataFrame(rows, "day string, slug string, text string"), CONFIG)
    hits, picks = plain(rows)
    assert {tuple(r) for r in got["hits"].select("day", "slug", "chunk", "keyword", "hits", "t").collect()} == hits
    assert {tuple(r) for r in got["picks"].select("day", "keyword", "t").collect()} == picks


def test_simulation_reads_texts_once(spark, tmp_path):
    """Hits, starts and picks come from what one pass has stored; no later step goes back to the texts."""
    source = f"{tmp_path}/speeches"
    spark.createDataFrame(made(20), "day string, slug string, text string").write.parquet(source)
    got = simulate(spark.read.parquet(source), CONFIG)
    for name in ("hits", "picks"):
        assert got[name].inputFiles() and not [f for f in got[name].inputFiles() if source in f]


def test_words(spark):
    d = spark.createDataFrame([(None,), ("",), ("  \n",), (" a b \n c",), ("a  b",)], "t string")
    assert [r.w for r in d.select(T.words("t").alias("w")).collect()] == [[], [], [], ["a", "b", "c"], ["a", "b"]]
