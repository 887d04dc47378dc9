"""Hopping windows, hits joined with what surrounds them, agendas that change and trackers that are taken over: streams in several batches."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions.text import covered_lines
from lectern.plans.streams import run_stream
from lectern.streaming import attribution as A
from lectern.streaming import windows as W
from lectern.streaming.speaker import UNKNOWN, SpeakerRules, restored

BASE = 1_790_000_000  # 2026-09-21 10:13 in New York
FAR = BASE + 10_000_000


@pytest.fixture(autouse=True)
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def in_batches(spark, folder, batches, schema):
    """A stream that reads one file for each batch, in order."""
    import os
    import time

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{i}")
        for name in os.listdir(f"{folder}/{i}"):
            os.utime(f"{folder}/{i}/{name}", (time.time() + i, time.time() + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def stream_rows(stream, path, spark):
    q = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert not q.isActive
    return spark.read.schema(stream.schema).parquet(f"{path}/out").collect(), [p for p in q.recentProgress]


def test_hopping_windows(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), BASE + rng.randrange(300), i, rng.choice([f"line {i}", None, ""])) for i in range(120)]
    late = [("a", BASE + 5, 900, "too late")]
    stream = in_batches(spark, tmp_path / "in", [rows, [("z", FAR, 0, "end")], late, [("z", FAR + 900, 1, "end")]], "k string, t long, i long, text string")
    found, _ = stream_rows(W.hopping_text(stream.withColumn("ts", F.timestamp_seconds("t")), "k", "ts", ["i"], "text", late="1 minute"), tmp_path, spark)
    want = {}
    for k, t, i, text in rows:
        for start in range((t - 20) // 16 * 16 + 16, t + 1, 16):
            want.setdefault((k, start), []).append((t, i, text))
    got = {(r.k, int(r.start.timestamp())): (r.lines, r.text) for r in found if r.k != "z"}
    assert got == {key: (len(v), " ".join(x for _, _, x in sorted(v, key=lambda y: y[:2]) if x)) for key, v in want.items()}


def test_context_join_equals_batch_and_forgets(spark, tmp_path):
    """Lines that come after their hit are waited for, rows behind the watermark are dropped, and state shrinks once it has passed."""
    rng = random.Random(2)
    lines = [(rng.choice("ab"), s := BASE + rng.randrange(4_000), s + rng.randrange(1, 30), f"text {i}") for i in range(400)]
    hits = [(rng.choice("abc"), BASE + rng.randrange(4_000), f"word{i}") for i in range(60)]
    lines.sort(key=lambda x: x[1] + rng.randrange(60))
    hits.sort(key=lambda x: x[1])
    end = [("z", FAR, FAR + 1, "end")]
    parts = [lines[i : i + 100] for i in range(0, 400, 100)]
    early = [[h for h in hits if BASE + k * 1000 <= h[1] < BASE + (k + 1) * 1000] for k in range(4)]
    x = in_batches(spark, tmp_path / "l", [*parts, end, [("a", BASE, BASE + 5, "too late")], [("z", FAR + 9_000, FAR + 9_001, "end")]], "k string, s long, e long, text string")
    h = in_batches(spark, tmp_path / "h", [*early, [("z", FAR, "end")], [("a", BASE + 1, "late")], [("z", FAR + 9_000, "end")]], "k string, t long, word string")
    stamped = lambda d, *names: d.withColumns({n: F.timestamp_seconds(n) for n in names})
    found, progress = stream_rows(W.context_join(stamped(h, "t"), stamped(x, "s", "e"), "k", "t", ["word"], "s", "e", "text", before=40, after=25, longest=30, late="2 minutes"), tmp_path, spark)
    want = {}
    for k, t, word in hits:
        near = [(s, e, text) for of, s, e, text in lines if of == k and t - 40 - 30 <= s <= t + 25 and e >= t - 40]
        if near:
            want[(k, t, word)] = " ".join(covered_lines(near, t - 40, t + 25))
    assert {(r.k, int(r.t.timestamp()), r.word): r.passage for r in found if r.k != "z"} == want and len(want) > 30
    held = [sum(s.numRowsTotal for s in p.stateOperators) for p in progress if p.stateOperators]
    assert max(held) > 60 and held[-1] < 12


def attributed(spark, path, rules, batches, **options):
    """Lines (key, seq, seconds, text) and agendas (key, seconds, day, entries) in batches."""
    rows = []
    for batch in batches:
        now = []
        for r in batch:
            if isinstance(r[1], int):
                now.append((r[0], A.LINE, r[1], r[2], r[3], None, None))
            else:
                now.append((r[0], A.AGENDA, None, r[1], None, r[2], None if r[3] is None else json.dumps(r[3])))
        rows.append(now)
    stream = in_batches(spark, path / "in", rows, "s string, kind string, seq long, t double, text string, day string, entries string").withColumn("ts", F.timestamp_seconds("t")).drop("t")
    found, _ = stream_rows(A.attribute(stream.select("s", *[c.split()[0] for c in A.INPUT.split(", ")]), "s", rules, **options), path, spark)
    lines = {(r.s, r.seq): r.speaker for r in found if r.kind == A.LINE}
    return lines, sorted((r.s, r.day, r.message) for r in found if r.kind == A.STATUS)


NORWAY, KENYA = ["Anna Maria Example", "Norway", "Prime Minister"], ["Ben Sample", "Kenya", "President"]
INTRO = "I now give the floor to the Prime Minister of Norway."


def test_an_agenda_that_comes_while_the_stream_runs(spark, tmp_path):
    """Without the day's agenda nobody is found and one status row says so; the agenda of the second batch counts at once, until it is taken back."""
    day, t = "2026-09-21", float(BASE)
    lines, status = attributed(
        spark, tmp_path, SpeakerRules({"": [tuple(KENYA)]}),
        [
            [("a", 0, t, INTRO), ("a", 1, t + 20, "Friends."), ("b", 0, t, "Silence.")],
            [("a", t + 30.0, day, [NORWAY, KENYA]), ("a", 2, t + 40, INTRO), ("a", 3, t + 60, "Friends."), ("b", 1, t + 40, INTRO), ("b", 2, t + 60, "So.")],
            [("a", t + 300.0, day, None), ("a", 4, t + 310, "The meeting is adjourned."), ("a", 5, t + 330, INTRO), ("a", 6, t + 350, "On.")],
        ],
    )
    assert [lines[("a", i)] for i in range(7)] == [UNKNOWN, UNKNOWN, UNKNOWN, "Anna Maria Example", "Anna Maria Example", UNKNOWN, UNKNOWN]
    assert [lines[("b", i)] for i in range(3)] == [UNKNOWN] * 3
    assert [(s, d) for s, d, _ in status] == [("a", day), ("b", day)] and "1 speakers" in status[0][2]


def test_the_day_changes_at_midnight_in_new_york(spark, tmp_path):
    before, after = 1_790_049_540.0, 1_790_049_660.0  # 23:59 on the 21st and 00:01 on the 22nd
    agendas = [("a", BASE + 0.0, "2026-09-21", [KENYA]), ("a", BASE + 0.0, "2026-09-22", [NORWAY])]
    lines, status = attributed(spark, tmp_path, SpeakerRules([]), [agendas, [("a", 0, before, INTRO), ("a", 1, before + 20, "Silence."), ("a", 2, after, INTRO), ("a", 3, after + 20, "Friends.")], [("a", 4, after + 86_400.0, "Next day.")]])
    assert [lines[("a", i)] for i in range(4)] == [UNKNOWN, UNKNOWN, UNKNOWN, "Anna Maria Example"]
    assert [(s, d) for s, d, _ in status] == [("a", "2026-09-23")]


@pytest.mark.parametrize(("later", "kept"), [(60, True), (89 * 60, True), (91 * 60, False), (86_400, False)])
def test_a_second_query_takes_the_trackers_over(spark, tmp_path, later, kept):
    """The first query ends while somebody speaks and somebody else is about to; the second one starts from its state, under the rule of 90 minutes."""
    rules = SpeakerRules([tuple(NORWAY), tuple(KENYA)])
    t = float(BASE)
    first = [[("a", 0, t, INTRO), ("a", 1, t + 20, "Friends."), ("p", 0, t, INTRO), ("n", 0, t, "Silence.")]]
    lines, _ = attributed(spark, tmp_path / "one", rules, first)
    assert lines[("a", 1)] == "Anna Maria Example" and lines[("p", 0)] == UNKNOWN
    taken = A.saved_trackers(spark, f"{tmp_path}/one/state", "s")
    assert {r.s for r in taken.collect()} == {"a", "p", "n"}
    again = [[(k, 5, t + later, "And so we say."), (k, 6, t + later + 20, "Indeed.")] for k in ("a", "p", "n", "new")]
    lines, _ = attributed(spark, tmp_path / "two", rules, [sum(again, [])], taken_over=taken)
    who = "Anna Maria Example" if kept else UNKNOWN
    assert [lines[(k, i)] for k in ("a", "p") for i in (5, 6)] == [who] * 4
    assert {lines[(k, i)] for k in ("n", "new") for i in (5, 6)} == {UNKNOWN}


def test_what_is_restored():
    since = float(BASE)
    state = {"current": "A", "country": "B", "since": since, "pending": ["C", "D"], "pending_since": since + 50, "previous": "x"}
    assert restored(state, since + 60) == {"current": "A", "country": "B", "since": since, "pending": ["C", "D"], "pending_since": since + 50}
    assert restored(state, since + 5410) == {"pending": ["C", "D"], "pending_since": since + 50}
    assert restored(state, since + 9000) == {} and restored(state | {"pending": [UNKNOWN, ""]}, since + 60).get("pending") is None


def test_the_whole_loop_equals_the_rules_line_by_line(spark, tmp_path):
    """Attribution, hits, repeats, cooldown and surroundings as one chain over several batches, every column of every row."""
    from lectern.streaming import loop
    from lectern.streaming.monitor import Monitor

    rng = random.Random(9)
    rules, keywords = SpeakerRules([tuple(NORWAY), tuple(KENYA)]), ["peace", "climate change"]
    lines = []
    for s in ("a", "b", "c"):
        t = BASE
        for i in range(80):
            t += rng.choice([4, 7, 16])
            said = rng.choice(["we want peace now", "Peace and climate  change", "nothing", INTRO, "I now give the floor to the President of Kenya.", "peace", "so we go on for CLIMATE change and peace and peace"])
            lines.append((s, i, t, t + rng.randrange(1, 12), said))
    lines.sort(key=lambda x: x[2])
    batches = [[(*x[:4], x[4]) for x in lines[i : i + 60]] for i in range(0, len(lines), 60)]
    x = in_batches(spark, tmp_path / "in", [*batches, [("z", 0, FAR, FAR + 1, "end")], [("z", 1, FAR + 9_000, FAR + 9_001, "end")]], "s string, i long, t long, e long, text string")
    x = x.withColumns({"ts": F.timestamp_seconds("t"), "end": F.timestamp_seconds("e")})
    found, _ = stream_rows(loop.alerts(A.lines_of(x, "s", "i", "ts", "text"), x.select("s", F.col("ts").alias("start"), "end", "text"), "s", rules, keywords, before=20, after=15, longest=20, context_words=3, cooldown=60, late="1 minute"), tmp_path, spark)
    monitor, want = Monitor(keywords, rules, 3, 8, 60), []
    for s in ("a", "b", "c"):
        state, own = {}, [x for x in lines if x[0] == s]
        for _, i, t, _, text in own:
            state, hits = monitor.window(state, {"seq": i, "seconds": float(t), "text": text})
            for h in hits:
                if h["send"]:
                    near = [(x[2], x[3], x[4]) for x in own if t - 40 <= x[2] <= t + 15 and x[3] >= t - 20]
                    want.append((s, t, i, h["speaker"], h["keyword"], h["context"], " ".join(covered_lines(near, t - 20, t + 15))))
    assert sorted((r.s, int(r.ts.timestamp()), r.seq, r.speaker, r.keyword, r.context, r.passage) for r in found) == sorted(want)
    assert len(want) > 40 and len({w[3] for w in want}) == 3


def test_streams_over_stored_files_are_read_to_their_end(spark, tmp_path):
    spark.createDataFrame([("a", BASE, 1, "x")], "k string, t long, i long, text string").write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("k string, t long, i long, text string").parquet(f"{tmp_path}/in").withColumn("ts", F.timestamp_seconds("t"))
    assert run_stream(s.select("k", "i")).collect() == [("a", 1)]


def test_passages_around_equal_the_loop_and_keep_no_pairs():
    """20,000 lines around 20,000 hits in one second would be 400 million pairs."""
    rng = random.Random(6)
    lines = [{"start": (s := rng.randrange(300)) * 1_000_000, "end": (s + rng.randrange(31)) * 1_000_000, "text": rng.choice(["", f"t{i}"])} for i in range(200)]
    at = [rng.randrange(-80, 400) for _ in range(150)]
    want = []
    for t in at:
        near = [(x["start"] / 1e6, x["end"] / 1e6, x["text"]) for x in lines if t - 70 <= x["start"] / 1e6 <= t + 25 and x["end"] / 1e6 >= t - 40]
        want.append(" ".join(covered_lines(near, t - 40, t + 25)) if near else None)
    assert W.passages_around(lines, np.array(at) * 1_000_000, 40, 25, 30) == want
    many = [{"start": i, "end": 1_000_000 - i, "text": f"t{i}"} for i in range(20_000)]
    assert set(W.passages_around(many, np.arange(20_000) + 100_000, 40, 25, 30)) == {"t0"}


def test_lines_that_no_passage_holds_are_left_out(spark):
    """Parts of the lines, each without what an earlier line outlasts, give the passages of all lines, also with empty texts, equal times and lines that are too long."""
    rng = random.Random(7)
    lines = [(rng.choice("abc"), (s := rng.randrange(300)) * 1_000_000, (s + rng.choice([-2, 0, 5, 20, 30, 30, 33, 90])) * 1_000_000, rng.choice(["", f"t{i}", "same"])) for i in range(900)]
    stamped = spark.createDataFrame(lines, "_key string, t long, _end long, _text string").selectExpr("_key", "timestamp_micros(t) AS _time", "_end", "_text")
    for parts in (1, 3):
        left = stamped.repartition(parts).mapInArrow(W.outlasting(30), stamped.schema).selectExpr("_key", "unix_micros(_time) AS t", "_end", "_text").collect()
        assert len(left) < 0.7 * len(lines) and max(x.t for x in left) == max(x[1] for x in lines)
        for k in "abc":
            dicts = [[{"start": t, "end": e, "text": text} for of, t, e, text in rows if of == k] for rows in (lines, left)]
            at = np.arange(-80, 400) * 1_000_000
            assert W.passages_around(dicts[1], at, 40, 25, 30) == W.passages_around(dicts[0], at, 40, 25, 30)


def test_a_dense_stream_keeps_few_lines_and_no_passages(spark, tmp_path):
    """Of 4,000 lines in each minute few outlast the earlier ones; these alone are in the windows that are stored, each read by all hits."""
    rng = random.Random(8)
    lines = [("a", s := BASE + rng.randrange(240), s + rng.randrange(1, 30), f"text {i}") for i in range(16_000)]
    hits = [("a", BASE + rng.randrange(240), f"word{i}") for i in range(50)]
    x = in_batches(spark, tmp_path / "l", [lines, [("z", FAR, FAR + 1, "end")]], "k string, s long, e long, text string")
    h = in_batches(spark, tmp_path / "h", [hits, [("z", FAR, "end")]], "k string, t long, word string")
    stamped = lambda d, *names: d.withColumns({n: F.timestamp_seconds(n) for n in names})
    reach = {"before": 40, "after": 25, "longest": 30}
    stored = run_stream(W.context_windows(stamped(h, "t"), stamped(x, "s", "e"), "k", "t", ["word"], "s", "e", "text", late="2 minutes", **reach), str(tmp_path))
    assert stored.selectExpr("sum(size(_lines))").first()[0] < 4_000
    found = W.passages(stored, "k", "t", ["word"], before=40, after=25, longest=30).where("k = 'a'").collect()
    near = {t: [(s, e, text) for _, s, e, text in lines if t - 70 <= s <= t + 25 and e >= t - 40] for t in {t for _, t, _ in hits}}
    assert sorted((int(r.t.timestamp()), r.word, r.passage) for r in found) == sorted((t, w, " ".join(covered_lines(near[t], t - 40, t + 25))) for _, t, w in hits)
