"""Readers, expressions and matching on small fixtures."""

import pytest
from pyspark.sql import functions as F

from lectern.functions import fuzzy
from lectern.functions import text as T
from lectern.operators import dims, likeness, rows, sequence
from lectern.operators.alerts import AlertConfig, simulate
from lectern.sources import files


def test_front_matter(spark, tmp_path):
    (tmp_path / "session=80" / "day=2025-09-23").mkdir(parents=True)
    p = tmp_path / "session=80" / "day=2025-09-23"
    (p / "M_12.txt").write_text("---\nsession: 80\ncountry: Kenya\nspeaker: A: B\nlanguage: EN\ndate: 2025-09-23T10:00\nelapsed_s: bad\n---\n\nHello\nworld\n")
    (p / "x.txt").write_text("no header")
    a = files.read_speeches(spark, str(tmp_path)).collect()
    assert len(a) == 1 and (a[0].slug, a[0].id_speech, a[0].speaker, a[0].text, a[0].elapsed_s, a[0].language) == ("M_12", "M_12", "A: B", "Hello\nworld", 0.0, "EN")
    b = files.read_speeches(spark, str(tmp_path), strict=True).first()
    assert (b.language, b.date) == ("en", "2025-09-23")


def test_log_lines(spark):
    lines = ["2026-09-25 03:10:55 | KEYWORD_DETECTED | reform | A. Speaker | t=2834s? | the context", "2026-09-25 03:10:55 | KEYWORD_DETECTED | peace | other", "noise"]
    got = files.parse_log_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.keyword, r.speaker, r.video_seconds, r.timestamp_reliable, r.context) for r in got] == [("reform", "A. Speaker", 2834.0, False, "the context"), ("peace", "", None, False, "other")]


def test_agenda_and_listing(spark):
    lines = [(0, "# agenda"), (1, "Anna Example | Norway | Prime Minister; Ben Sample|Kenya"), (2, "ANNA EXAMPLE | Elsewhere")]
    got = files.parse_agenda(spark.createDataFrame(lines, "position int, value string")).orderBy("name").collect()
    assert [(r.name, r.country, r.title) for r in got] == [("Anna Example", "Norway", "Prime Minister"), ("Ben Sample", "Kenya", "")]
    doc = '{"sampleData":[{"MT_agendaitem":{"MT_AG_title":"5th meeting, 24 September 2025"},"MT_speakers":[{"SP_slotNo":"2","SP_isSkip":false,"SP_LS_nameFormat":true,"SP_LS_fname":"Anna","SP_LS_lname":"EXAMPLE","SP_entity":{"SP_entity":"Norway"}},{"SP_slotNo":"x","SP_isSkip":true,"SP_LS_fname":"B"}]}]}'
    r = files.parse_listing(spark.createDataFrame([(doc,)], "value string")).collect()
    assert [(x.day, x.slot, x.name, x.country) for x in r] == [("2025-09-24", 2, "EXAMPLE Anna", "Norway")]


def test_config():
    c = files.load_alert_config('cooldown_seconds = 0\n[[group]]\nname = "a"\nkeywords = ["Reform", "reform", "UN reform"]')
    assert (c.cooldown_seconds, c.keywords, c.window, c.hop) == (120, ["Reform", "UN reform"], 47, 38)
    with pytest.raises(ValueError):
        files.load_alert_config("")
    assert c.without("reform").keywords == ["UN reform"]


def test_simulation_counts_windows_and_cooldown(spark):
    filler = " ".join(["word"] * 39)
    text = " ".join([filler + " reform"] * 4)
    s = spark.createDataFrame([("d", "s", text), ("d", "t", "")], "day string, slug string, text string")
    got = simulate(s, AlertConfig({"g": ("reform",)}))
    assert got["hits"].agg(F.sum("hits")).first()[0] >= 4 and got["picks"].count() == 1


def test_expressions(spark):
    d = spark.createDataFrame([("M_007", " 12 ", "2025-09-24", "Saint Kitts and Nevis"), ("M_0", "1.5", "soon", ""), ("x", None, "a-b", None)], "i string, c string, d string, n string")
    r = d.select(T.id_number("i").alias("i"), T.strict_code("c").alias("c"), T.day_month_year("d").alias("d"), T.weak_slug("n").alias("n")).collect()
    assert [(x.i, x.c, x.d, x.n) for x in r] == [(7, 12, "24/09/2025", "saint-kitts-nevis"), (None, None, "soon", ""), (None, None, "a-b", None)]
    m = spark.createDataFrame([("UN  Reform & reform",)], "t string").select(T.keyword_count("t", "un reform").alias("n"), T.mark_html("t", ["reform"]).alias("h")).first()
    assert m.n == 1 and m.h == "UN  <strong>Reform</strong> &amp; <strong>reform</strong>"


def test_packing_and_coverage(spark):
    d = spark.range(1).select(F.array(*[F.lit(x) for x in ("aa", "bb", "cccccc", "d")]).alias("p"))
    assert d.select(sequence.pack(F.col("p"), 6, "|")).first()[0] == ["aa|bb", "cccccc", "d"]
    lines = F.expr("array(named_struct('start', 0.0D, 'end', 4.0D, 'text', 'a'), named_struct('start', 1.0D, 'end', 4.2D, 'text', 'again'), named_struct('start', 4.0D, 'end', 8.0D, 'text', 'b'))")
    assert d.select(sequence.covered_text(lines, F.lit(0.0), F.lit(8.0))).first()[0] == "a b"
    spans = F.expr("array(named_struct('start', 3, 'end', 5), named_struct('start', 0, 'end', 2), named_struct('start', 0, 'end', 4))")
    assert [tuple(x) for x in d.select(sequence.merge_spans(spans)).first()[0]] == [(0, 4)]


def test_upsert_and_ids(spark):
    old = spark.createDataFrame([("a", 0, "x"), ("b", 1, "y"), ("", 2, "z")], "slug string, pos int, v string")
    new = spark.createDataFrame([("b", 0, "Y"), ("c", 1, "w")], "slug string, pos int, v string")
    assert [(r.slug, r.v) for r in rows.upsert(old, new, "slug", "pos").orderBy("pos").collect()] == [("a", "x"), ("b", "Y"), ("c", "w")]
    items = spark.createDataFrame([(i, 3 if i == 0 else 5 if i == 4 else None) for i in range(6)], "n long, kept long")
    got = rows.assign_ids(items, F.col("kept"), F.lit(0), [F.col("n")], start=3).collect()
    assert {r.n: r.id for r in got} == {0: 3, 4: 5, 1: 4, 2: 6, 3: 7, 5: 8}


def test_matching(spark):
    assert fuzzy.country_score("USA", "United States of America") == 1.0
    assert fuzzy.country_score("Marshall Islands", "Solomon Islands") < fuzzy.COUNTRY_THRESHOLD
    assert fuzzy.fold("Côte d'Ivoire") == "cote d ivoire" and fuzzy.country_of_title("President of the Republic of Kenya") == "Kenya"
    agenda = [("Anna Example", "Norway", "Prime Minister"), ("Ben Sample", "Kenya", "President"), ("Bea Sampler", "Peru", "")]
    assert fuzzy.match("Ana Exampel", "", "", agenda) == (0, "name")
    assert fuzzy.match("", "President of Kenya", "", agenda) == (1, "country")
    assert fuzzy.match("Zz Qq", "", "", agenda) is None
    heard = spark.createDataFrame([(1, "Ana Exampel", None, None), (2, None, None, None)], "i int, name string, title string, country string")
    listed = spark.createDataFrame([(i, *a) for i, a in enumerate(agenda)], "position long, name string, country string, title string")
    assert [(r.i, r.position, r.found_by) for r in likeness.match_roster(heard, listed).orderBy("i").collect()] == [(1, 0, "name"), (2, None, None)]
    s = spark.createDataFrame([("a", 0.9, 1), ("a", 0.88, 2), ("b", 0.9, 3), ("b", 0.5, 4)], "k string, s double, i int")
    assert [r.i for r in dims.best_with_margin(s, "k", "s", 0.62, 0.08, [F.col("i")]).collect()] == [3]
