"""Documents, transcripts, settings and stores on small fixtures."""

import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from lectern.functions import cleaning as C
from lectern.functions import clock, urls
from lectern.functions import text as T
from lectern.operators import corrections, dims, mail, publish, replay
from lectern.sources import config, files, sinks, store


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression.alias("x")).first().x


def test_documents_lose_what_is_no_speech(spark):
    text = "Permanent Mission of X\nPage 2 of 9\n12/9/2025, 10:30 AM\nN E W S L E T T E R\nBismillah\n/1/2/3/4/5/6/7/8 x\nforeword\n\nMr. President,\nI speak of hope and\n– not fear .\nTHE CONCLUDING REMARKS OF ALL\n1. First\nEnd.\n(c) www"
    got = one(spark, text, C.clean_document("t"))
    assert got == "Mr. President,\n\nI speak of hope and – not fear.\n\n1. First End.\n\n(c) www"
    assert one(spark, "only notes\nhere", C.clean_document("t")) == "only notes here"


def test_protocol_goes(spark):
    text = "The Assembly will now hear an address by His Excellency A, President of B. I request protocol to escort His Excellency and invite him to address the assembly. Peace is all. On behalf of the General Assembly, I wish to thank the President."
    assert one(spark, text, C.without_protocol("t")) == "Peace is all."
    raw = "Meeting/Event: x\nDate: y\n [Auto-generated transcript]\nnoise. " + text
    assert one(spark, raw, C.clean_transcript("t")) == "Peace is all."
    assert one(spark, None, C.clean_transcript("t")) is None and one(spark, "", C.without_protocol("t")) == ""
    assert one(spark, "ﬁne", C.nfkc("t")) == "fine"


def test_sessions_and_settings():
    s = config.load_session('id = 81\nyear = 2026\nname = "n"\ngadebate_base = "https://x/"\nslug_file = "s.txt"\nmin_pdf_chars = 0\ndebate_dates = ["2026-09-22"]')
    assert (s.base_url, s.journal_dir, s.min_pdf_chars, s.sources, s.speaker_url("peru")) == ("https://x", "data/unga81", 200, config.SOURCES, "https://x/en/81/peru")
    for wrong in ("id = 1", 'id=1\nyear=1\nname=""\ngadebate_base=""\nslug_file=""\nsources=["radio"]'):
        with pytest.raises(ValueError):
            config.load_session(wrong)
    file = config.parse_env("# c\nexport A='1'\nB = two words\n=x\nno\nC=\"")
    assert file == {"A": "1", "B": "two words", "C": '"'}
    assert config.merged_env({"A": "p", "B": "p"}, file, {"A"}) == {"A": "1", "B": "p", "C": '"'}
    assert config.read_setting({"X": " 3 "}, "X", int, 1, least=1) == 3 and config.read_setting({}, "X", float, 2.5) == 2.5 and config.read_setting({"X": "No"}, "X", bool, True) is False
    for env, kind in (({"X": "0"}, int), ({"X": "a"}, int), ({"X": "maybe"}, bool)):
        with pytest.raises(ValueError, match="X"):
            config.read_setting(env, "X", kind, 1, least=1)
    assert [config.cache_life(x) for x in (None, "5min", "None", "weird", "3600")] == ["1h", "5m", "off", "1h", "1h"]


def test_specs():
    assert config.parse_fix("2026-09-25 03:00..2026-09-25T04:00Z=Ann|Chair") == (datetime(2026, 9, 25, 3, tzinfo=UTC), datetime(2026, 9, 25, 4, tzinfo=UTC), "Ann", "Chair")
    assert config.parse_cut("12.5=Ann | Peru") == (12.5, "Ann", "Peru", "")
    assert [config.parse_run(x) for x in ("all", " Last", "2")] == [None, -1, 2] and config.parse_list(" a,,b ") == ["a", "b"]
    for parse, spec in ((config.parse_fix, "x"), (config.parse_fix, "2026-01-02..2026-01-01=A"), (config.parse_cut, "a=b"), (config.parse_cut, "1="), (config.parse_run, "x")):
        with pytest.raises(ValueError):
            parse(spec)


def test_store_round_trip_and_snapshots(spark, tmp_path):
    speeches = spark.createDataFrame([("Ann", "Peru", None), ("Bo", None, "Chair")], "speaker string, country string, title string")
    lines = spark.createDataFrame([("Ann", 1, 2.0, 3.0, "two"), ("Ann", 0, 0.0, 1.0, "one")], "speaker string, position int, start double, end double, text string")
    quotes = spark.createDataFrame([("Bo", 0, "t", "reform", "Bo", None, "c", 1.5, True, None, None)], f"owner string, position int, {store.HIT}")
    store.write_store({"speeches": speeches, "lines": lines, "quotes": quotes}, f"{tmp_path}/s")
    got = store.read_store(spark, f"{tmp_path}/s")
    assert [(r.position, r.text) for r in got["lines"].orderBy("position").collect()] == [(0, "one"), (1, "two")]
    assert got["speeches"].count() == 2 and got["quotes"].first().keyword == "reform"
    (tmp_path / "snap").mkdir()
    (tmp_path / "snap" / "2026-09-25.json").write_text('[{"keyword": "a", "video_seconds": 2.5}, {"keyword": ""}]')
    (tmp_path / "snap" / "2026-09-26.json").write_text('{"hits": [{"keyword": "b"}]}')
    (tmp_path / "snap" / "2026-09-27.json").write_text("broken")
    snaps = store.read_snapshots(spark, f"{tmp_path}/snap").collect()
    assert sorted((r.day, r.keyword, r.video_seconds) for r in snaps) == [("2026-09-25", "a", 2.5), ("2026-09-26", "b", None)]
    sinks.write_lines(spark.createDataFrame([(1, "b"), (0, "# a")], "position int, line string"), f"{tmp_path}/lines", "position", "line")
    assert [r.value for r in spark.read.text(f"{tmp_path}/lines").collect()] == ["# a", "b"]


def test_addresses(spark):
    ids = {"https://youtu.be/KnIFmbdRCi0?t=1": "KnIFmbdRCi0", "https://www.youtube.com/watch?a=b&v=KnIFmbdRCi0": "KnIFmbdRCi0", "https://m.youtube.com/live/KnIFmbdRCi0": "KnIFmbdRCi0", "https://youtube.com/KnIFmbdRCi0": "KnIFmbdRCi0", "https://x.org/watch?v=KnIFmbdRCi0": None, "https://youtube.com/watch?v=short": None, "no": None}
    d = spark.createDataFrame([(k,) for k in ids], "u string")
    assert {r.u: r.i for r in d.select("u", urls.video_id("u").alias("i")).collect()} == ids
    link = one(spark, "https://w.org/a?start=1&x=#f", urls.seek_link("t", "start", F.lit(2834.4), F.lit(True)))
    assert link == "https://w.org/a?x=&start=2834#f" and one(spark, " https://w.org/a ", urls.seek_link("t", "start", F.lit(5.0), F.lit(False))) == "https://w.org/a"
    assert one(spark, "abcdef0123", urls.list_data_url("t", "https://l.org")) == "https://l.org/abcdef0123/data.json" and one(spark, "https://l.org/x/?q", urls.list_data_url("t", "b")) == "https://l.org/x/data.json" and one(spark, "https://l.org", urls.list_data_url("t", "b")) is None


def test_clocks(spark):
    row = spark.range(1).select(
        clock.player_time(F.lit(3725.5)).alias("a"), clock.player_time(F.lit(59.5)).alias("b"), clock.keeps_speaker(F.timestamp_seconds(F.lit(1790006400)), F.timestamp_seconds(F.lit(1790011800))).alias("c"),
        clock.keeps_speaker(F.timestamp_seconds(F.lit(1790006400)), F.timestamp_seconds(F.lit(1790011801))).alias("d"), clock.origin_with_player(clock.live_origin(F.lit(100.0), F.lit(160.0)), F.lit(False), F.lit(5.0))["reliable"].alias("e"),
        clock.live_origin(F.lit(None).cast("double"), F.lit(160.0))["seconds"].alias("f"), clock.is_fresh(F.lit(None).cast("double"), F.lit(1.0), 0).alias("g"), clock.is_fresh(F.lit(None).cast("double"), F.lit(1.0), 5).alias("h"),
    ).first()
    assert tuple(row) == ("1:02:06", "01:00", True, False, False, 0.0, True, False)


def test_contained_pairs(spark):
    inner = ["minister of peace", "abc", "", "minister of x", "zz"]
    outer = [f"the minister of peace {i}" for i in range(5)] + ["xabcx", "abc", "minister of"]
    got = dims.contained(spark.createDataFrame([(x,) for x in inner], "a string"), "a", spark.createDataFrame([(x,) for x in outer], "b string"), "b").collect()
    assert sorted((r.a, r.b) for r in got) == sorted((a, b) for a in inner for b in outer if a and a in b)


def test_put_back_and_selection(spark):
    a = spark.createDataFrame([("Ann", None, "Chair"), ("Bo", "Peru", "")], "speaker string, country string, title string")
    b = spark.createDataFrame([("ann", "Kenya", "Other"), ("Cy", "", None)], "speaker string, country string, title string")
    assert sorted(map(tuple, corrections.meta_put_back(a, b).collect())) == [("Ann", "Kenya", "Chair"), ("Bo", "Peru", None), ("Cy", None, None)]
    journal = spark.createDataFrame([("d1", 1, "b"), ("d1", 0, "a")], "day string, position int, slug string")
    listed = spark.createDataFrame([(0, "x"), (1, "y")], "position int, slug string")
    days = spark.createDataFrame([("y", "d2T1")], "slug string, day string").withColumn("day", F.lit("d2"))
    names = lambda df: [r.slug for r in df.orderBy("position").collect()]
    assert names(publish.selected_slugs(journal, listed, days, "d1")) == ["a", "b"] and names(publish.selected_slugs(journal, listed, days, "d2")) == ["y"]
    assert names(publish.selected_slugs(journal.limit(0), listed, days.limit(0), "d9", limit=1)) == ["x"]
    lines = spark.createDataFrame([("k", 0, "a"), ("k", 1, "b"), ("k", 2, "c")], "key string, run int, v string")
    assert [r.v for r in publish.select_run(lines, "key", -1).collect()] == ["c"] and publish.select_run(lines, "key", 7).count() == 0 and publish.select_run(lines, "key", None).count() == 3


def test_alert_emails(spark):
    rows = [(1, 0, "reform", "Ann", "Chair", "we <want> UN reform & peace", "", "https://y/1"), (1, 1, "UN reform", "unknown", None, "x", None, None), (1, 2, "reform", "Bo", "", "x", None, None), (2, 0, "peace", "unknown", "T", "peace", "about Peace", None)]
    d = spark.createDataFrame(rows, "m int, position int, keyword string, speaker string, speaker_title string, transcript string, mail_context string, watch_url string").withColumn("timestamp", F.timestamp_seconds(F.lit(1790006400)))
    a, b = mail.alert_emails(d, ["m"], "position").orderBy("m").collect()
    assert a.subject == "KEYWORD_DETECTED | reform, UN reform | Ann, Bo" and b.subject == "KEYWORD_DETECTED | peace"
    assert a.text.split("\n") == ["Keyword(s): reform, UN reform", "When: 2026-09-21 16:00:00 UTC", "New York: 2026-09-21 12:00:00 EDT", "Madrid: 2026-09-21 18:00:00 CEST", "YouTube: https://y/1", "Speaker: Ann, Bo", "Title: Chair", "", "Chunk:", "we <want> **UN reform** & peace"]
    assert "<p><b>Speaker:</b> Ann, Bo</p>" in a.html and "we &lt;want&gt; <strong>UN reform</strong> &amp; peace</blockquote></div>" in a.html
    assert b.text.endswith("Context:\nabout **Peace**") and "Title" not in b.text and "YouTube" not in b.html


def test_stored_names(spark):
    files_ = spark.createDataFrame([("out/d1/peru.txt", "peru", "peru", "M_7", "out/d1"), ("out/d1/M_4.txt", "M_4", "chad", "", "out/d1"), ("out/d2/togo.txt", "togo", "togo", "", "out/d2")], "path string, stem string, slug string, id_speech string, folder string")
    s = spark.createDataFrame([("peru", "", "out/d1"), ("chad", "", "out/d1"), ("togo", "m_9", "out/d2"), ("mali", "", "out/d2")], "slug string, id_speech string, folder string")
    named, gone = replay.stored_names(s, files_, F.col("folder"))
    assert {r.slug: (r.id_speech, r.path) for r in named.collect()} == {"peru": ("M_7", "out/d1/M_7.txt"), "chad": ("M_4", "out/d1/M_4.txt"), "togo": ("M_9", "out/d2/M_9.txt"), "mali": ("", "out/d2/mali.txt")}
    assert {r.path for r in gone.collect()} == {"out/d1/peru.txt", "out/d2/togo.txt"}


def test_slugs_and_headers(spark):
    assert one(spark, "Côte d’Ivoire (République de)", T.country_slug("t")) == "cote-d-ivoire" and one(spark, "Türkiye", T.country_slug("t")) == "turkiye"
    d = spark.createDataFrame([("a", "---\nslug: x\n---\nbody"), ("b", "no"), ("c", None)], "path string, value string")
    assert {r.path for r in files.without_header(d).collect()} == {"b", "c"} and files.parse_front_matter(d).first().transformation == "none"


def test_long_parts_are_cut_and_packed(spark):
    """No chunk above the limit, nothing but white space lost at cuts, and the last piece of a long part goes on."""
    from lectern.operators import sequence

    rng = random.Random(5)

    def plain(parts, limit):
        out, buf = [], ""
        for p in parts:
            if not p:
                continue
            if buf and len(buf) + 2 + len(p) > limit:
                out.append(buf)
                buf = p
            else:
                buf = f"{buf}\n\n{p}" if buf else p
            while len(buf) > limit:
                out.append(buf[:limit])
                buf = buf[limit:].lstrip()
        return [*out, buf] if buf else out

    rows = [[*("".join(rng.choice("ab  ") for _ in range(rng.choice([0, 3, 10, 45, 200]))).strip() for _ in range(rng.randrange(8)))] for _ in range(60)] + [["x" * 5000], [], [None, "a", None]]
    got = spark.createDataFrame(list(enumerate(rows)), "i int, p array<string>").select("i", sequence.pack(F.col("p"), 40).alias("c"))
    for r in got.collect():
        assert r.c == plain([x or "" for x in rows[r.i]], 40) and all(len(c) <= 40 for c in r.c)


def test_protocol_match_equals_all_pairs(spark):
    """The best share, the first of the best, else the last of the level; large token sets, shared tokens and people without a key, too."""
    import random

    from lectern.operators import metadata

    rng = random.Random(4)
    said = lambda n: " ".join(rng.choice("abcdefghijklmnop") * 2 for _ in range(n))
    people = [(rng.choice(["x", "y", None]), i, rng.choice(["HS", "HG"]), said(rng.choice([0, 1, 2, 3, 10, 12])), f"g{i}", "") for i in range(80)]
    speeches = [(i, rng.choice(["x", "y", "z", None]), rng.choice([None, said(rng.choice([0, 1, 2, 3, 4, 9, 11]))]), rng.choice(["HS", "HG", "CD"])) for i in range(200)]
    got = metadata.protocol_match(spark.createDataFrame(speeches, "speech_id long, k string, name string, level string"), spark.createDataFrame(people, "k string, position long, level string, person string, gender string, honorific string"), "k")
    want = {}
    for i, k, name, level in speeches:
        here = [p for p in people if k is not None and p[0] == k]
        a = set((name or "").split())
        share = lambda p: len(a & set(p[3].split())) / min(len(a), len(set(p[3].split()))) if a and p[3] else 0
        best = min((p for p in here if share(p) >= 0.5), key=lambda p: (-share(p), p[1]), default=None) or max((p for p in here if p[2] == level), key=lambda p: p[1], default=None)
        want[i] = (best[3], best[4]) if best else (None, None)
    assert {r.speech_id: (r.person, r.gender) for r in got.collect()} == want


def test_protocol_match_makes_no_pairs(spark):
    """6,000 speeches and 6,000 people of one country: no step makes 36 million rows."""
    from lectern.operators import metadata

    n = spark.range(6_000)
    people = n.selectExpr("'x' AS k", "id AS position", "'HS' AS level", "concat('person ', id % 9) AS person", "'' AS gender", "'' AS honorific")
    got = metadata.protocol_match(n.selectExpr("id AS speech_id", "'x' AS k", "concat('customer ', id % 9) AS name", "'HS' AS level"), people, "k")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert got.groupBy("person").count().count() == 9
    assert not [line for line in plan.splitlines() if "Join Inner" in line and "_s" not in line]


def test_pieces_are_not_broadcast_and_saved_names_are_counted_first(spark):
    """A small file may have very many pieces; a wish that many names contain is one row for each distinct name at most."""
    from lectern.operators import mail

    saved = spark.createDataFrame([("Ana Paz", "Peru"), ("Ana Paz", "Chile"), ("Bea Ana", "Chile"), (None, None), ("Cai", "Côte")], "name string, country string")
    wishes = ["ana", "ANA PAZ", "cai", "ca", "chile", "peru", "no", None, ""]
    got = mail.select_saved(saved, spark.createDataFrame([(w,) for w in wishes], "wish string"))
    assert {r.wish: (r.state, r.found) for r in got.collect()} == {
        "ana": ("ambiguous", None), "ANA PAZ": ("ambiguous", None), "cai": ("ok", "Cai"), "ca": ("ok", "Cai"), "chile": ("ambiguous", None), "peru": ("ok", "Ana Paz"),
        "no": ("missing", None), None: ("missing", None), "": ("missing", None),
    }
    pairs = dims.contained(spark.range(9).selectExpr("concat('n', id) AS a"), "a", spark.range(9).selectExpr("concat('n', id, 'm') AS b"), "b")
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert [line for line in plan.splitlines() if "Join Inner" in line] and all("merge" in line for line in plan.splitlines() if "Join Inner" in line)
    assert pairs.count() == 9
