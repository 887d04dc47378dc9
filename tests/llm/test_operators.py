"""The corpus operators against brute force on small and odd tables."""

import base64
import hashlib
import random
import re
import struct
import zipfile
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from lectern.llm import blocks, bpe, common, components, decontamination, kernel, near_dedup, quality_model, quality_rules, substring_dedup, suffix_dedup, token_files, toxicity, warc
from lectern.llm.oracles import ORACLES

SCHEMA = "doc_id long, text string, lang string, BUCKET int, source string, n_chars long"


def corpus():
    """Texts with copies, near copies, shared passages, nulls, odd characters, ties and repeated rows."""
    rng = random.Random(5)
    words = ["the", "of", "and", "été", "a", "größe", "日本", "Stone", "x&y", "12", "re-run", "is"]
    make = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "s", ",", "."]) for _ in range(n))
    passage, long_ = make(60), make(400)
    near = long_.split(" ")
    near[10] = "changed"
    texts = [long_, make(30), long_, " ".join(near), passage + "\n" + make(40), make(25) + "  " + passage, "", None, "one", "  ", "a\tb\x0bc d", passage, passage]
    texts += [make(rng.randint(1, 90)) for _ in range(20)] + ["same words " * 60, "line one\nline one\n\nline two", make(4000) + passage]
    rows = [(i * 3 % 41, t, None if i % 5 == 0 else "en", i, None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, rows[2], rows[7]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def in_order():
    return sorted(corpus(), key=lambda r: (r[0], r[1] is not None, (r[1] or "").encode()))


@pytest.fixture(params=["direct", "relayed"])
def exchange(request, monkeypatch):
    """Messages sent directly, and through relays with finer cuts of the ids."""
    if request.param == "relayed":
        monkeypatch.setattr(blocks, "DIRECT", 2)
        monkeypatch.setattr(blocks, "COARSE", 3)
        count = common.block_count
        monkeypatch.setattr(common, "block_count", lambda *args: count(*args) + 7)


def test_envelopes():
    parts = [(5, 2, b"abc"), (0, 1 << 20, b""), (7, 3, b"x" * 300)]
    assert blocks.opened(blocks.envelope(parts)) == parts and blocks.opened(blocks.envelope([])) == []


def test_blocks_are_ranges(spark, monkeypatch):
    monkeypatch.setattr(blocks, "COARSE", 4)
    ids = [None, *range(0, 900, 3), *[2000] * 50, *range(10_000, 10_050)]
    rows = blocks.with_blocks(spark.createDataFrame([(i,) for i in ids], "doc_id long").repartition(3), "doc_id", 22).collect()
    held: dict = {}
    for r in rows:
        held.setdefault(r._block, []).append(-1 if r.doc_id is None else r.doc_id)
    ranges = [(min(v), max(v)) for _, v in sorted(held.items())]
    assert len(rows) == len(ids) and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:])) and len(ranges) > 12 and min(held) >= 0


def test_substring_dedup(docs, empty, exchange):
    rows = [(r[0], split(r[1])) for r in in_order()]
    first, want = {}, []
    for d, (_, w) in enumerate(rows):
        for i in range(len(w) - 19):
            first.setdefault(tuple(w[i : i + 20]), (d, i))
    for d, (i, w) in enumerate(rows):
        gone = {j for s in range(len(w) - 19) if first[tuple(w[s : s + 20])] != (d, s) for j in range(s, s + 20)}
        want.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    got = substring_dedup.substring_dedup(docs)
    assert set(docs.columns) < set(got.columns)
    found = got.select("doc_id", "n_words", substring_dedup.n_removed(), "kept_text").collect()
    assert sorted(map(tuple, found)) == sorted(want)
    assert sum(x[2] for x in want) > 400
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_suffix_dedup(docs, empty, exchange):
    rows = [(r[0], (r[1] or "").encode()) for r in in_order()]
    first, want = {}, []
    for i, t in rows:
        for s in range(len(t) - 49):
            first.setdefault(t[s : s + 50], i)
    for i, t in rows:
        gone = bytearray(len(t))
        for s in range(len(t) - 49):
            if first[t[s : s + 50]] < i:
                gone[s : s + 50] = b"\1" * 50
        want.append((i, len(t), (b"\0" + bytes(gone)).count(b"\0\1"), bytes(c for c, g in zip(t, gone) if not g)))
    got = suffix_dedup.suffix_dedup(docs).collect()
    assert sorted((r.doc_id, r.n_bytes, len(r.removed) // 2, bytes(r.kept)) for r in got) == sorted(want)
    assert suffix_dedup.suffix_dedup(empty).count() == 0
    assert suffix_dedup._whole_characters("aéb".encode(), [2, 3]) == [] and suffix_dedup._whole_characters("aéb".encode(), [1, 3]) == [1, 3]
    texts = suffix_dedup.suffix_dedup(docs, as_text=True).select("doc_id", "text", "kept", "removed").collect()
    assert all((r.kept is None) == (r.text is None) and (r.removed or r.kept == r.text) for r in texts) and sum(len(r.kept or "") < len(r.text or "") for r in texts) > 5


def test_deep_shallow_sort():
    rng = random.Random(1)
    for k in range(30):
        s = bytes(rng.choice(b"ab" if k % 2 else b"abcdefgh") for _ in range(2000))
        s += s[:400] * 3 + s[100:500]
        pos = np.array(sorted(rng.sample(range(len(s) - 50), 600)))
        order, fresh = suffix_dedup.deep_shallow_sort(np.frombuffer(s, np.uint8), pos, 50, rng.choice([8, 16, 32, 48, 50]))
        w = [s[p : p + 50] for p in pos[order]]
        assert w == sorted(w) and fresh.tolist() == [i == 0 or w[i] != w[i - 1] for i in range(len(w))]


def test_near_groups(docs, empty, spark, exchange):
    texts = {}
    for r in corpus():
        texts[r[0]] = r[1] if r[0] not in texts or texts[r[0]] is None else texts[r[0]]
    def shingles(t):
        w = split((t or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = components.union_find(links)
    want = {i: (len(s), root.get(i, i), root.get(i, i) == i) for i, s in sets.items()}
    got = near_dedup.near_groups(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want
    assert len(got) == len(corpus()) and len(links) >= 2
    assert near_dedup.near_groups(empty).count() == 0


def test_near_groups_of_chains(spark):
    """A large group in which most pairs are not similar enough: links only between neighbours of a chain."""
    rng = random.Random(3)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            w[rng.randrange(150)] = f"n{rng.random()}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for _, t in rows]
    root = components.union_find([(a, b) for a in range(120) for b in range(a + 1, 120) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])])
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: root.get(i, i) for i in range(120)}


def test_near_bounds_in_any_row_order(spark, monkeypatch):
    """The rounds between blocks and buckets read a block's rows in different orders."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    texts = {i: " ".join(base[: rng.randint(5, 80)] + [f"own{i}x{k}" for k in range(rng.randint(0, 60))]) for i in range(60)}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in texts.items() for w in [t.split(" ")]}
    held = Counter(x for s in sets.values() for x in s)
    want = {i: (len(s), sum(held[x] > 1 for x in s)) for i, s in sets.items()}
    finish = near_dedup.B.Exchange.finish

    def turned(self, base, answers, work, schema):
        return finish(self, base, answers, lambda block, table, heard: work(block, table.take(list(range(table.num_rows))[::-1]), heard), schema)

    monkeypatch.setattr(near_dedup.B.Exchange, "finish", turned)
    docs = spark.createDataFrame([(i, len(sets[i]), t) for i, t in texts.items()], "node long, n long, text string")
    assert {r.node: (r.n, r.o) for r in near_dedup._bounds(docs, 5).collect()} == want


def test_super_min_hash_estimates_similarity():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        common, k = rng.integers(1, 2**63, 400, dtype=np.uint64), int(400 * (1 / share - 1) / 2)
        a, b = (np.sort(np.concatenate([common, rng.integers(1, 2**63, k, dtype=np.uint64)])) for _ in range(2))
        sig = near_dedup.super_min_hash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 512)
        assert np.isfinite(sig).all() and abs((sig[0] == sig[1]).mean() - 400 / (400 + 2 * k)) < 0.1
    small = near_dedup.super_min_hash(np.array([7], np.uint64), np.array([0, 1, 1]), 16)
    assert sorted(np.floor(small[0])) == list(range(16)) and np.isinf(small[1]).all()


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {x: r for x, r in components.union_find([(a, b) for a, b in links if a != b]).items()}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quality_rules(docs, empty):
    got = quality_rules.quality_rules(docs).collect()
    assert len(got) == len(corpus())
    for r in got:
        w, t = split(r.text), r.text or ""
        tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if split(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(empty).where("kept").count() == 0
    assert quality_rules.quality_rules(docs).where("kept").count() == sum(r.kept for r in got)


def test_decontamination(spark, docs, empty):
    items = [(1, corpus()[4][1]), (10, "one"), (2, corpus()[11][1][:60]), (3, None), (4, "--"), (2, "never there at all is it")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = set()
    for i, t in items:
        w = words(t)
        m = min(10, len(w))
        windows |= {(i, tuple(w[k : k + m])) for k in range(len(w) - m + 1) if m}
    want = []
    for r in corpus():
        w, hit, ids = words(r[1]), set(), set()
        for i, k in windows:
            for s in range(len(w) - len(k) + 1):
                if tuple(w[s : s + len(k)]) == k:
                    hit |= set(range(s, s + len(k)))
                    ids.add(str(i))
        want.append((r[0], len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    for size in (1 << 20, 40):  # one group of patterns, several scans
        got = decontamination.contamination_report(docs, bench, group_bytes=size).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert decontamination.contamination_report(empty, bench).count() == 0
    assert decontamination.contamination_report(docs, bench.limit(0)).where("contaminated").count() == 0


@pytest.fixture(scope="module")
def reference_bpe():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(docs, empty, reference_bpe):
    path = P.path("byte_bpe_50k.tiktoken")
    got = bpe.token_digests(docs, path, P.PATTERN).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(r[0], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r[1] or "").encode())) for r in corpus() for ids in [reference_bpe.encode_ordinary(r[1] or "")]]
    assert sorted(map(tuple, got)) == sorted(want)
    both = bpe.decode(bpe.encode(docs, path, P.PATTERN), path, P.PATTERN)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in both.collect())
    assert bpe.token_digests(empty, path, P.PATTERN).count() == 0


def test_bpe_on_random_texts_appends_and_edits(reference_bpe):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        e, rng = bpe.encoder(f.read(), P.PATTERN), random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "é", "日本", "1", "!!", "aa", "the", "ing", "🙂", "x", "\x85", "\0", "\xa0", "\u3000", "\u2003", "ü", "\x1c", " (", "'ll", "\r\n", "\n\n", "Q.", "9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + ["abc" * 3000]
    assert e.encode_all(texts) == [reference_bpe.encode_ordinary(t) for t in texts]
    for _ in range(100):
        a, x = "".join(rng.choice("abcdeing th") for _ in range(40)).encode(), rng.randint(0, 40)
        y, put = rng.randint(x, 40), "".join(rng.choice("abc ing") for _ in range(rng.randint(0, 6))).encode()
        whole = bpe.PrefixTable(e.v, a[:x] + put + a[y:])
        assert bpe.PrefixTable(e.v, a).replace(x, y, put).last == whole.last
        assert bpe.PrefixTable(e.v, a[:x]).append(put).append(a[y:]).ids() == whole.ids()


def test_token_files(spark, docs, empty, tmp_path):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    path = f"file://{tmp_path}/tokens"
    token_files.write_tokens(docs.dropDuplicates(["doc_id"]), path, P.path("byte_bpe_50k.json"), files=3)
    texts = {r.doc_id: r.text for r in docs.dropDuplicates(["doc_id"]).collect()}
    got, at = {r.doc_id: r for r in token_files.token_index(spark, path).collect()}, 0
    for i in sorted(texts):
        ids = [*t.encode(texts[i] or "", add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    assert {r.doc_id for r in token_files.read_tokens(spark, path, [3, 6]).collect()} == {3, 6}
    token_files.write_tokens(empty, f"file://{tmp_path}/none", P.path("byte_bpe_50k.json"))
    assert token_files.token_index(spark, f"file://{tmp_path}/none").count() == 0


def test_token_files_with_special_strings(spark, tmp_path):
    t, rng = Tokenizer.from_file(P.path("byte_bpe_50k.json")), random.Random(4)
    parts = ["<|endoftext|>", "<|endoftext|", " ", "  ", "\n", "\t ", "a", " b", "word"]
    texts = ["a <|endoftext|> b", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(300))]
    path = f"file://{tmp_path}/tokens"
    token_files.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, P.path("byte_bpe_50k.json"), files=2)
    got = {r.doc_id: list(r.ids) for r in token_files.read_tokens(spark, path).collect()}
    assert got == {i: [*t.encode(x, add_special_tokens=False).ids, 0] for i, x in enumerate(texts)} and got[0] == [64, 220, 50256, 275, 0]


def test_warc(spark, tmp_path, monkeypatch):
    long_ = "<p>é" + "x" * 1200
    rows = [(1, "http://a", long_), (2, None, "short"), (3, "http://c d", long_), (4, "http://d", None), (5, "e", "short"), (6, "f", ""), (None, "g", long_), (2, None, "short"), (9, "h", "y" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    packages = warc.write_packages(pages, f"file://{tmp_path}/w", package_bytes=1500)
    got = warc.read_packages(spark, packages).collect()
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = html == long_ and i != 3
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sorted(want, key=lambda x: x[:4])
    assert warc.read_packages(spark, warc.write_packages(pages.limit(0), f"file://{tmp_path}/e")).count() == 0


def test_zip64_directory(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a", b"x" * 300)
        z.writestr("b", b"y" * 500)
        z.writestr("c", b"packed" * 90, zipfile.ZIP_DEFLATED)
    raw = path.read_bytes()
    found = warc.read_directory(lambda o, n: raw[o : o + n], len(raw))
    assert set(found) == {"a", "b"} and all(raw[o : o + n] == x for (o, n), x in zip((found["a"], found["b"]), (b"x" * 300, b"y" * 500)))


def _labelled(spark, n=900):
    rng = random.Random(4)
    plain = ["tree", "house", "river", "stone", "cloud", "paper", "green", "walk", "talk", "seven"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic, good = i % 5 == 0, i % 3 != 0
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["vile", "nasty"])
        rows.append((i, " ".join(x if good else x.upper() + "!!" for x in w)))
        labels.append((i, int(good), int(toxic)))
    return spark.createDataFrame([*rows, (n, None), (n + 1, "")], "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1, 1), (n, None, None)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("module", "label", "least"), [(toxicity, "toxic", 0.97), (quality_model, "quality", 0.99)])
def test_models_on_held_out_rows(spark, module, label, least):
    from pyspark.sql import functions as F

    docs, labels = _labelled(spark)
    held_out = F.col("doc_id") % 3 == 1
    model = module.fit(docs, labels, ~held_out, label=label)
    got = module.score(docs, model).join(labels, "doc_id").where(held_out & F.col(label).isNotNull())
    right = got.select(F.avg(((F.col("score") >= 0.5).cast("int") == F.col(label)).cast("double"))).first()[0]
    assert right >= least
    every = module.score(docs, model).collect()
    assert len(every) == 902 and all(0 <= r.score <= 1 for r in every)
    assert module.score(docs.limit(0), model).count() == 0


def test_kernel_slices_and_words():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a b", None, "", "c" * 100, "d"])})
    assert [s.num_rows for s in kernel.slices(batch, "text", 60)] == [3, 1, 1]
    w = kernel.Words(batch["text"])
    assert w.counts.tolist() == [2, 0, 0, 1, 1] and w.word(2) == b"c" * 100 and w.hash[0] != w.hash[1]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark):
    from lectern.llm.queries import QUERIES
    from tests.test_registry import SF, TABLES, duckdb, table

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = c.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert table(got.select(*columns).collect(), columns) == table(want, columns)
