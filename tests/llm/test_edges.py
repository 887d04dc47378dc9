"""Every operator on awkward tables: clashing names, nulls in any column, repeated rows, ties, very long texts, no rows."""

import hashlib
import os
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from lectern.llm import bpe, common, decontamination, near_dedup, quality_model, quality_rules, substring_dedup, suffix_dedup, token_files, toxicity, warc
from lectern.llm.queries import QUERIES
from tests.llm.test_operators import reference_bpe, split  # noqa: F401

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
NAMES = ["Text", "_text", "doc_id", "text", "_node", "_block", "c0", "C3", "node", "DOC_ID"]
KINDS = "string, string, long, string, long, int, string, double, string, string"
LONG = " ".join(f"w{i * 7919 % 50_021}x" for i in range(400_000))


def rows():
    texts = ["one two three four five six", None, "", "  ", "one two three four five six", "a\nb\na\n" + "same words again " * 30, LONG, "tail " + LONG[:3000], "é" * 60, "one two three four five six"]
    out = [(f"T{i}", None if i % 2 else "keep", None if i == 1 else i, t, i * 10, None, f"c{i}", 0.5, None, "id") for i, t in enumerate(texts)]
    return [*out, out[0], out[5], (None, None, None, "text of a null id", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    kinds = KINDS.split(", ")
    return spark.createDataFrame(rows(), ", ".join(f"x{i} {k}" for i, k in enumerate(kinds))).toDF(*NAMES).repartition(3)


def plain_model():
    rng = np.random.default_rng(1)
    return quality_model.boost(rng.random((40, len(quality_model.FEATURES))), rng.integers(0, 2, 40).astype(float), rounds=2, pair_rounds=1)


def bench(spark):
    items = [("i1", "one two three four five six", "x"), (None, "é" * 60, "y"), ("i1", "one two three four five six", "z"), ("i2", None, None), ("i3", LONG[5000:9000], "long")]
    return spark.createDataFrame(items, "a string, b string, c string").toDF("item_id", "text", "Text")


def operators(spark):
    return {
        "substring": (substring_dedup.substring_dedup, substring_dedup.OUTPUT),
        "toxicity": (lambda d: toxicity.score(d, toxicity.Model(np.array([5], np.int32), np.array([0.5], np.float32), 0.1)), ("score",)),
        "encode": (lambda d: bpe.encode(d, RANKS, P.PATTERN), ("ids",)),
        "rules": (quality_rules.quality_rules, quality_rules.OUTPUT),
        "suffix": (suffix_dedup.suffix_dedup, suffix_dedup.OUTPUT),
        "quality": (lambda d: quality_model.score(d, plain_model()), ("score",)),
        "near": (near_dedup.near_groups, near_dedup.OUTPUT),
        "contamination": (lambda d: decontamination.find_contamination(d, bench(spark)), decontamination.OUTPUT),
    }


@pytest.mark.parametrize("name", ["substring", "toxicity", "encode", "rules", "suffix", "quality", "near", "contamination"])
def test_callers_columns_stay(name, spark, docs):
    run, outputs = operators(spark)[name]
    found = run(docs)
    assert found.columns == [*NAMES, *outputs]
    got = [tuple(r) for r in found.collect()]
    assert sorted((g[: len(NAMES)] for g in got), key=repr) == sorted(rows(), key=repr)
    # repeated rows have equal results, and the same comes of the two columns alone
    plain = docs.toDF(*[f"x{i}" for i in range(len(NAMES))]).select(F.col("x2").alias("doc_id"), F.col("x3").alias("text"))
    alone = [tuple(r) for r in run(plain).collect()]
    assert sorted(((g[2], g[3], *g[len(NAMES) :]) for g in got), key=repr) == sorted(alone, key=repr)
    assert run(docs.limit(0)).count() == 0 and run(docs.limit(0)).columns == found.columns
    # a column with an output's own name is replaced
    other = plain.withColumn(outputs[0], F.lit("old"))
    assert run(other).columns == ["doc_id", "text", *outputs] and run(other).count() == len(rows())


def test_missing_and_near_names(spark):
    d = spark.createDataFrame([(1, "a b")], "Doc_ID long, TEXT string")
    assert quality_rules.quality_rules(d).first().n_words == 2
    with pytest.raises(ValueError, match="no column"):
        quality_rules.quality_rules(d.drop("TEXT"))


def test_long_texts_whole(spark, docs):
    """The long text's counts are those of the whole text."""
    x = docs.toDF(*[f"x{i}" for i in range(len(NAMES))]).select(F.col("x2").alias("doc_id"), F.col("x3").alias("text")).where("doc_id = 6")
    assert substring_dedup.substring_dedup(x).first().n_words == 400_000
    assert quality_rules.quality_rules(x).first().n_words == 400_000
    assert near_dedup.near_groups(x).first().n_shingles == len({tuple(w) for w in zip(*[LONG.split()[k:] for k in range(5)])})
    assert suffix_dedup.suffix_dedup(x).first().n_bytes == len(LONG)
    assert decontamination.find_contamination(x, bench(spark)).first().items == ["i3"]


def test_long_texts_in_tokens(spark, docs, reference_bpe, tmp_path):  # noqa: F811
    x = spark.createDataFrame([(6, LONG[:400_000]), (7, "ab" * 40_000), (7, "ab" * 40_000), (None, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.token_digests(x, RANKS, P.PATTERN).collect()}
    assert got[6].n_tokens == len(reference_bpe.encode_ordinary(LONG[:400_000])) and got[7].n_tokens == len(reference_bpe.encode_ordinary("ab" * 40_000))
    assert got[6].decoded_sha256 == hashlib.sha256(LONG[:400_000].encode()).hexdigest() and got[None].n_tokens == 0
    path = f"file://{tmp_path}/t"
    token_files.write_tokens(x.withColumns({"t": F.lit("other"), "_file": F.lit(1)}).toDF("doc_id", "text", "Text", "_file"), path, JSON)
    index = token_files.token_index(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in index] == [None, 6, 7, 7] and [r.start for r in index] == [0, *np.cumsum([r.n_tokens for r in index])[:-1].tolist()]
    assert index[0].ids_crc32 == zlib.crc32(bytes(4))


def test_file_numbers_not_names_order_tokens(spark, tmp_path):
    """Names are padded to five digits: part-100000 stands before part-99999."""
    for number, ids in ((99_999, [1, 2]), (100_000, [3])):
        spark.createDataFrame([(number, ids)], "doc_id long, ids array<int>").coalesce(1).write.orc(f"file://{tmp_path}/w{number}")
        made = next(f for f in os.listdir(f"{tmp_path}/w{number}") if f.endswith(".orc"))
        os.makedirs(f"{tmp_path}/all", exist_ok=True)
        os.rename(f"{tmp_path}/w{number}/{made}", f"{tmp_path}/all/part-{number:05d}{made[made.index('-', 5):]}")
    assert {r.doc_id: r.start for r in token_files.token_index(spark, f"file://{tmp_path}/all").collect()} == {99_999: 0, 100_000: 2}


def test_pages_with_clashing_names(spark, tmp_path):
    html = "x" * 1500
    some = [(i, f"u{i}", html if i % 2 else "y", f"other{i}", i, "d") for i in range(8)] + [(None, None, html, None, None, None)]
    pages = spark.createDataFrame(some, "a long, b string, c string, d string, e long, f string").toDF("page_id", "url", "html", "Html", "_kept", "payload_digest")
    got = warc.read_packages(spark, warc.write_packages(pages, f"file://{tmp_path}/w")).collect()
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {1: 7, 3: 7, 5: 7, None: 7} and len(got) == 9


@pytest.mark.parametrize("fit", [toxicity.fit, quality_model.fit])
def test_models_of_odd_samples(fit, spark):
    """No labels, labels of one kind, several rows and labels of one id."""
    module, label = (toxicity, "toxic") if fit is toxicity.fit else (quality_model, "quality")
    d = spark.createDataFrame([(1, "a b"), (1, "b c"), (2, None), (3, ""), (None, "d")], "doc_id long, text string")
    for labels in ([], [(1, 1), (1, 0), (2, 1), (3, 1), (None, 0), (9, 1), (3, None)]):
        model = fit(d, spark.createDataFrame(labels, f"doc_id long, {label} int"), F.lit(True))
        scores = [r.score for r in module.score(d, model).collect()]
        assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)


def test_token_queries_against_the_libraries(spark, reference_bpe):  # noqa: F811
    """The registered queries over a whole table."""
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    t = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {i: (len(x), sha(" ".join(map(str, x)).encode()), sha((s or "").encode())) for i, s in zip(t["doc_id"], t["text"]) for x in [reference_bpe.encode_ordinary(s or "")]}
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op3_byte_bpe"](spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == want
    lib, at, want = Tokenizer.from_file(JSON), 0, {}
    for i, s in sorted(zip(t["doc_id"], t["text"])):
        ids = [*lib.encode(s or "", add_special_tokens=False).ids, 0]
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_token_files"](spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()} == want


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(Session())
    assert common.shared_dir(spark)


CLUSTER = '''
import os, random, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from lectern.llm import near_dedup
from lectern.llm.components import union_find
spark = SparkSession.builder.master("local-cluster[2,1,700]").config("spark.driver.host", "127.0.0.1").config("spark.checkpoint.dir", "file://" + sys.argv[2]).config("spark.sql.shuffle.partitions", 9).config("spark.executorEnv.PYTHONPATH", sys.argv[1]).config("spark.sql.adaptive.coalescePartitions.enabled", "false").config("spark.ui.enabled", "false").config("spark.executor.memory", "640m").getOrCreate()
assert spark.range(8).repartition(4).count() == 8
print("STARTED", flush=True)
rng, texts = random.Random(6), {}
for i in range(700):
    w = [f"g{i // 4}x{k}" for k in range(60)] if i % 3 else [f"own{i}x{k}" for k in range(60)]
    for _ in range(rng.choice([0, 0, 1, 2])):
        w[rng.randrange(60)] = f"n{rng.random()}"
    texts[i] = " ".join(w)
sets = {i: {tuple(t.split()[k : k + 5]) for k in range(56)} for i, t in texts.items()}
links = [(a, b) for a in sets for b in range(a + 1, min(a + 8, 700)) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
root = union_find(links)
got = {r.doc_id: r.component_id for r in near_dedup.near_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(12)).collect()}
wrong = sum(got[i] != root.get(i, i) for i in texts)
print("WRONG", wrong, "LINKS", len(links))
os._exit(0 if wrong == 0 and len(links) > 100 else 1)
'''


def test_near_groups_on_several_executors(tmp_path):
    """Rows of a group come in another order at each read there; copies are still found, all of them."""
    import pyspark

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = os.environ | {"SPARK_HOME": os.path.dirname(pyspark.__file__), "SPARK_WORKER_DIR": str(tmp_path / "work"), "PYTHONPATH": root, "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_SUBMIT_ARGS": "--driver-memory 700m pyspark-shell"}
    script = tmp_path / "cluster.py"
    script.write_text(CLUSTER)
    for _ in range(2):
        try:
            done = subprocess.run([sys.executable, str(script), root, str(tmp_path)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=400)
        except subprocess.TimeoutExpired as late:
            pytest.skip(f"the cluster of this machine took more than {late.timeout} seconds")
        if "STARTED" in done.stdout:
            break
    else:
        pytest.skip(f"no cluster of several executors starts here: {done.stderr[-3000:]}")
    assert done.returncode == 0, done.stdout[-300:] + done.stderr[-6000:]
