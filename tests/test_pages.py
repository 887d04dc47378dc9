"""Pages, protocol lists, cleaning, messages and writers."""

from pyspark.sql import functions as F

from lectern.functions import cleaning as C
from lectern.operators import mail, metadata
from lectern.sources import pages, sinks

HTML = """<script type="application/ld+json">{"name": "Anna Example"}</script><div class="field field--name-country x">Nor<b>way</b></div>
<time datetime="2025-09-24T10:00"></time><a href="/f/a_fr.pdf">French</a> <a href="/f/a_en.pdf">old</a><a href="/f/a_en.pdf">English</a>
<section class="morning"><a href="/gadebate/80/norway">x</a></section><section class="afternoon"><a href="/gadebate/80/kenya?x=1">y</a><a href="/gadebate/80/norway">z</a></section>"""


def test_pages(spark):
    d = spark.createDataFrame([(1, HTML), (2, None)], "id int, html string")
    r = pages.speaker_pages(d).orderBy("id").collect()
    assert (r[0].country, r[0].name, r[0].date, r[0].english_pdf.url, [x.label for x in r[0].pdfs]) == ("Nor way", "Anna Example", "2025-09-24", "/f/a_en.pdf", ["French", "English"])
    assert [(x.slug) for x in pages.archive_slugs(d, "id", "80").orderBy("position").collect()] == ["norway", "kenya"]
    assert [(x.part, x.slug) for x in pages.schedule(d, "id").orderBy("position").collect()] == [("morning", "norway")]


def test_protocol(spark):
    head = "          Head of State            Head of Government       Minister for Foreign Affairs"
    text = f"NORWAY\n{head}\n          King Olav                Anna Example             Ben Sample\n                                   (since 2020)\nKENYA\n          Ruth Rule                Same as Head of State    Carl Case\n"
    got = pages.protocol_people(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t").orderBy("position").collect()
    assert [(r.country, r.level, r.person) for r in got] == [
        ("Norway", "HS", "King Olav"), ("Norway", "HG", "Anna Example (since 2020)"), ("Norway", "MFA", "Ben Sample"),
        ("Kenya", "HS", "Ruth Rule"), ("Kenya", "HG", "Ruth Rule"), ("Kenya", "MFA", "Carl Case"),
    ]


def test_cleaning(spark):
    text = "Page 1\nSTATEMENT BY THE PRESIDENT\nMr President,\nwe are\nhere. Peace\n\ncame-\nback .\nNew para"
    d = spark.createDataFrame([(text, "/12 " * 30)], "t string, g string")
    r = d.select(C.reflow(C.clean_lines("t")).alias("t"), C.is_glyph_garbage("g").alias("g"), C.is_glyph_garbage("t").alias("h")).first()
    assert r.t == "Mr President, we are here. Peace cameback.\n\nNew para" and r.g and not r.h
    assert C.merge_objects('x ```json\n{"a": [1], "b": 1}\n``` {"a": [2], "b": 3} {broken') == '{"a": [1, 2], "b": 1}'
    assert C.merge_objects("none") is None


def test_selection_and_titles(spark):
    saved = spark.createDataFrame([("Anna Example", "Norway"), ("Ben Sample", "Kenya"), ("Ben Other", "Peru")], "name string, country string")
    got = mail.select_saved(saved, spark.createDataFrame([("anna example",), ("ben",), ("peru",), ("zz",)], "wish string")).collect()
    assert {r.wish: (r.state, r.found) for r in got} == {"anna example": ("ok", "Anna Example"), "ben": ("ambiguous", None), "peru": ("ok", "Ben Other"), "zz": ("missing", None)}
    t = spark.createDataFrame([("Vice-President of X",), ("President of X",), ("Prime Minister",), ("nobody",)], "t string")
    assert [r.l for r in t.select(metadata.level(F.col("t")).alias("l")).collect()] == ["CD", "HS", "HG", ""]


def test_writers(spark, tmp_path):
    d = spark.createDataFrame([("80", "d1", "a\nb", 1), ("80", "d2", "c", 2)], "session string, day string, text string, n int")
    sinks.write_days(d, f"{tmp_path}/days")
    sinks.write_days(d.where("day = 'd1'").withColumn("n", F.lit(9)), f"{tmp_path}/days")
    assert {(r.day, r.n) for r in spark.read.parquet(f"{tmp_path}/days").collect()} == {("d1", 9), ("d2", 2)}
    sinks.append_csv(d.select("text", "n"), f"{tmp_path}/csv")
    assert {r.text for r in spark.read.csv(f"{tmp_path}/csv", header=True).collect()} == {"a | b", "c"}
    assert sinks.merged_text(d, ["n"]).first().value == "a\nb\n\nc\n"
    write = sinks.journal_batches(f"{tmp_path}/j", ["n"])
    write(d, 0)
    write(d, 0)
    assert spark.read.json(f"{tmp_path}/j").count() == 2


def test_pages_evaluate_links_once(spark):
    """Each kind of link is searched once, although its later links and the picked file refer to it; a page with many links keeps the last label of each url."""
    many = "".join(f'<a href="/f/{i % 7}_{"en" if i % 7 == 3 else "fr"}.pdf">{i}</a>' for i in range(50))
    d = pages.speaker_pages(spark.createDataFrame([(1, many)], "id int, html string"))
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 2
    r = d.first()
    assert [x.label for x in r.pdfs] == [str(i) for i in range(43, 50)] and r.english_pdf.label == "45"


def test_speaker_pages_use_all_tasks(spark):
    """The customers' file is one row group, from which pages are made and parsed in as many tasks as a shuffle has."""
    from lectern.plans import parsing

    assert parsing.speaker_pages(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_reflow_and_line_rules_against_whole_paragraphs(spark):
    """Rules look at a paragraph's end alone, with the same result as rules over all of it; letters are not listed to be counted."""
    import random
    import re

    rng = random.Random(5)
    piece = ["word", "Word", "end.", "end.”", ")", "-", "a-", "a--", "b -", "stop.-", "x,", "Y:", "1. one", "- item", "”", "?", "—x", ""]
    cases = [[rng.choice(piece) + rng.choice(["", " " + rng.choice(piece)]) for _ in range(rng.randint(0, 12))] for _ in range(400)]

    def plain(lines):
        done, p = [], ""
        for x in [line.strip() for line in lines]:
            if not x:
                continue
            if p and not re.match(r"(?:\d+\.\s|-+\s)", x) and (re.match(r"[a-z,;:)\]—–-]", x) or not (re.search(r"""[.!?…؟۔]["'”’»)]*$""", p) or (re.search("[,:]$", p) and re.match("[A-Z]", x)))):
                p = p[:-1] + x if re.search("(?<!-)-$", p) else f"{p} {x}"
            else:
                done, p = done + [p] * bool(p), x
        return "\n\n".join(re.sub(r" +([,.;:!?])", r"\1", re.sub(" +", " ", d).strip(" ")) for d in done + [p] * bool(p))

    trimmed = F.transform("l", lambda x: F.trim(x))
    got = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, l array<string>").select("i", C.reflow(trimmed).alias("p")).orderBy("i").collect()
    assert [r.p for r in got] == [plain(c) for c in cases]
    d = spark.createDataFrame([("A­ \t b\r\nHONOURABLE MEMBERS\r/1/2/3/4/5/6/7/8 9\n\nVery long sentence here",)], "t string").select(C.clean_lines("t").alias("l"))
    assert d.first().l == ["A b", "", "Very long sentence here"]
    assert d._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1  # numbers of lines with eight slashes
