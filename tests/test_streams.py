"""Streams equal the batch operators, and the rules behind them."""

import random

from pyspark.sql import functions as F

from lectern.operators.cooldown import first_in_window, take_with_cooldown
from lectern.streaming import processors as S
from lectern.streaming.monitor import Monitor, stream_monitor
from lectern.streaming.speaker import UNKNOWN, SpeakerRules
from lectern.streaming.watchdog import Watch


def greedy(times, gap):
    out = []
    for t in sorted(set(times)):
        if not out or t - out[-1] >= gap:
            out.append(t)
    return out


def test_cooldown_over_slices(spark):
    rng = random.Random(1)
    rows = [(k, rng.randrange(20_000)) for k in ("a", "b", None) for _ in range(700)] + [("c", None)]
    got = take_with_cooldown(spark.createDataFrame(rows, "k string, t long"), ["k"], "t", 7, slice_length=500).collect()
    for k in ("a", "b", None):
        assert sorted(r.t for r in got if r.k == k) == greedy([t for x, t in rows if x == k and t is not None], 7)


def test_cooldown_with_slices_in_which_nothing_is_taken(spark):
    """Keys of several kinds, few events, negative times; many a slice has no event or takes none."""
    rng = random.Random(5)
    rows = [(k, n, rng.choice([-40, 0, 300]) + rng.randrange(60)) for k in ("a", "b", None) for n in (1.5, float("nan"), None) for _ in range(12)]
    rows += [("hot", 1.0, rng.randrange(4_000)) for _ in range(3_000)]
    frame = spark.createDataFrame(rows, "k string, n double, t long")
    same = lambda a, b: a == b or (a is not None and b is not None and a != a and b != b)
    for length in (None, 20):
        got = take_with_cooldown(frame, ["k", "n"], "t", 10, slice_length=length).collect()
        assert {type(r.k) for r in got} == {str, type(None)}
        for k, n in {(k, str(n)): (k, n) for k, n, _ in rows}.values():
            assert sorted(r.t for r in got if r.k == k and same(r.n, n)) == greedy([t for x, m, t in rows if x == k and same(m, n)], 10)
    assert take_with_cooldown(frame.limit(0), ["k"], "t", 10).count() == 0


def test_cooldown_folds_long_histories_in_levels(spark, monkeypatch):
    """Hundreds of slices of a key in groups of four: five levels, no row with the steps of more than four slices."""
    from lectern.operators import cooldown as C

    monkeypatch.setattr(C, "FAN", 4)
    rng = random.Random(8)
    rows = [("hot", rng.randrange(-3_000, 9_000)) for _ in range(5_000)] + [("thin", rng.randrange(0, 9_000)) for _ in range(60)] + [(None, t) for t in range(0, 9_000, 9)]
    got = take_with_cooldown(spark.createDataFrame(rows, "k string, t long"), ["k"], "t", 10, slice_length=20).collect()
    for k in ("hot", "thin", None):
        assert sorted(r.t for r in got if r.k == k) == greedy([t for x, t in rows if x == k], 10)


def test_first_in_window_keeps_the_least_row(spark):
    rows = [("a", 5, "y"), ("a", 5, "x"), ("a", 8, "z"), (None, 5, None), (None, 16, "w"), ("a", None, "no")]
    got = first_in_window(spark.createDataFrame(rows, "k string, t long, v string"), ["k"], "t", 10).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("a", 5, "x"), (None, 5, None), (None, 16, "w")], key=repr)


def test_stream_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rng = random.Random(2)
    rows = [("ab"[i % 2], rng.randrange(60) + 60 * (i // 40)) for i in range(200)]
    for i in range(0, 200, 40):
        spark.createDataFrame(rows[i : i + 40], "k string, t long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, t long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = S.stream_cooldown(stream, ["k"], "t", 25).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    assert got == sorted((k, t) for k in "ab" for t in greedy([t for x, t in rows if x == k], 25))


def test_silent_keys_are_closed(spark, tmp_path):
    """Late rows are dropped; a key without rows for a time puts out its last batch and is forgotten."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    parts = [[("k", 0, "A", "one", 1000), ("k", 1, "A", "two", 1010)], [("m", 0, "B", "three", 8000)], [("m", 1, "", "four", 9000)], [("m", 2, "", "five", 9001), ("k", 2, "A", "late", 1020)], [("m", 3, "", "six", 9002)]]
    for i, rows in enumerate(parts):
        d = spark.createDataFrame(rows, "key string, seq long, speaker string, quote string, t long").withColumn("ts", F.timestamp_seconds("t"))
        d.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("key string, seq long, speaker string, quote string, t long, ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    found = S.stream_speaker_batches(stream, "key", event_time="ts", idle=3600, late="10 seconds")
    q = found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(180)
    got = [(r.key, r.speaker, r.quotes, r.text) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert ("k", "A", 2, "one\ntwo") in got and all("late" not in g[3] for g in got)


def test_watch():
    clock, said = [0.0], []
    w = Watch(180, said.append, now=lambda: clock[0])
    clock[0] = 100
    assert not w.check()
    w.beat(0)
    clock[0] = 200
    assert w.check() and said == [200.0]
    clock[0] = 500
    assert w.check() and len(said) == 1
    clock[0] = 900
    assert w.check() and len(said) == 2
    w.beat(3)
    assert not w.check() and not Watch(0, said.append).check()


def test_monitor_order():
    m = Monitor(["reform", "peace"], SpeakerRules([("Anna Example", "Norway", "")]), context_words=2, ttl=8, cooldown=120)
    base, state, out = 1_790_000_000.0, {}, []
    script = [(0, "I invite Her Excellency Anna Example, of Norway, for reform."), (16, "we want reform and peace now"), (20, "we want reform and peace now"), (40, "Reform again, reform now"), (200, "reform")]
    for i, (t, text) in enumerate(script):
        state, found = m.window(state, {"seq": i, "seconds": base + t, "text": text})
        out += found
    assert [(o["seq"], o["speaker"], o["keyword"], o["send"]) for o in out] == [
        (0, UNKNOWN, "reform", True), (1, "Anna Example", "reform", False), (1, "Anna Example", "peace", True), (3, "Anna Example", "reform", False), (3, "Anna Example", "reform", False), (4, "Anna Example", "reform", True),
    ]
    assert out[1]["context"] == '"we want reform and peace..."'


def test_monitor_stream(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.createDataFrame([("s", 0, 100.0, "peace"), ("s", 1, 110.0, "peace and peace"), ("u", 0, 5.0, "none")], "k string, seq long, seconds double, text string").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, seq long, seconds double, text string").parquet(f"{tmp_path}/in")
    q = stream_monitor(stream, "k", Monitor(["peace"], SpeakerRules([]))).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("seq", "context").collect()
    assert [(r.k, r.seq, r.send) for r in got] == [("s", 0, True), ("s", 1, False)]  # two hits with equal surroundings count once


def test_context_waits_for_what_follows():
    windows = [{"start": s, "end": s + 10, "text": f"text {s}", "keywords": "reform" if s == 10 else ""} for s in (0, 10, 20, 30)]
    state, out = S.delayed_context({}, windows[:2], 10, 12)
    assert out == [] and state["waiting"] == [["reform", 10.0]]
    state, out = S.delayed_context(state, windows[2:], 10, 12)
    assert out == [{"keyword": "reform", "t": 10.0, "passage": "text 0 text 10 text 20"}]
    assert S.left_waiting({"lines": [[0, 4, "a"]], "waiting": [["k", 1.0]]}, 2, 9) == [{"keyword": "k", "t": 1.0, "passage": "a"}]
    assert S.passage([[0, 4, "a"], [1, 4.2, "a again"], [4, 8, "b"]], 0, 8) == "a b"


def test_batches_by_speaker():
    rows = [{"seq": i, "speaker": s, "quote": q} for i, (s, q) in enumerate([("A", "one"), ("", "two"), ("A", ""), ("B", "three"), ("A", "")])]
    state, out = S.speaker_batches({}, rows)
    assert [(o["speaker"], o["quotes"]) for o in out] == [("A", 2), ("B", 1)] and state["speaker"] == "A"


def test_speaker_rules():
    rules = SpeakerRules([("Anna Example", "Norway", "Prime Minister"), ("Ben Sample", "Kenya", "President")])
    script = ["The meeting begins.", "I give the floor to Her Excellency Anna Example, Prime Minister of Norway.", "We stand for peace.", "Thank you. I thank the Prime Minister of Norway.", "A pause."]
    state, got = {}, []
    for i, text in enumerate(script):
        state, who = rules.observe(state, text, 100.0 * i)
        got.append(who)
    assert got == [UNKNOWN, UNKNOWN, "Anna Example", "Anna Example", UNKNOWN]


def test_replay(spark):
    rules = SpeakerRules([("Anna Example", "Norway", "")])
    rows = [(1, 0, 0.0, "I invite Her Excellency Anna Example, of Norway, to speak."), (1, 1, 20.0, "Friends."), (2, 0, 0.0, "Silence.")]
    got = S.replay_speakers(spark.createDataFrame(rows, "s int, seq long, seconds double, text string"), "s", rules).orderBy("s", "seq").collect()
    assert [r.speaker for r in got] == [UNKNOWN, "Anna Example", UNKNOWN]
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_cooldown_of_groups_that_a_skewed_join_would_split(spark):
    rows = [(i % 2, i * 7919 % 50_021) for i in range(20_000)]
    events = spark.createDataFrame(rows, "k long, t long").repartition(16, "t")
    skewed = {"autoBroadcastJoinThreshold": "-1", "adaptive.advisoryPartitionSizeInBytes": "1k", "adaptive.forceOptimizeSkewedJoin": "true", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "adaptive.skewJoin.skewedPartitionFactor": "0.5"}
    try:
        for k, v in skewed.items():
            spark.conf.set(f"spark.sql.{k}", v)
        got = take_with_cooldown(events, ["k"], "t", 40, slice_length=5_000).collect()
    finally:
        for k in skewed:
            spark.conf.unset(f"spark.sql.{k}")
    for k in (0, 1):
        assert sorted(r.t for r in got if r.k == k) == greedy([t for x, t in rows if x == k], 40)


def test_spaced_places_are_those_of_the_rule():
    """The frame rule against keep_spaced, over batches that also come late; a cooldown looks at kept rows only, not at each row."""
    import numpy as np

    rng = random.Random(11)
    for gap in (0, 1, 7, 50):
        state, last = {}, None
        for _ in range(30):
            times = sorted(rng.randrange(-200, 300) for _ in range(rng.randint(0, 40)))
            state, rows = S.keep_spaced(state, [{"t": t} for t in times], "t", gap)
            places, last = S.spaced_places(last, np.array(times, np.int64), gap)
            assert ([times[i] for i in places], last) == ([r["t"] for r in rows], state["last"])
    assert S.spaced_places(None, np.arange(1_000_000), 10**6) == ([0], 0)


class _Held:
    """A state variable of one key in memory that counts what is asked of it."""

    def __init__(self, calls, value=None):
        self.calls, self.value, self.map = calls, value, {}

    def _count(self, out=None):
        self.calls.append(1)
        return out

    def exists(self):
        return self._count(self.value is not None)

    def get(self):
        return self._count(self.value)

    def update(self, value):
        self.value = self._count(value)

    def containsKey(self, k):
        return self._count(k in self.map)

    def getValue(self, k):
        return self._count(self.map[k])

    def updateValue(self, k, v):
        self._count()
        self.map[k] = v

    def removeKey(self, k):
        self._count()
        del self.map[k]

    def iterator(self):
        return self._count(iter(list(self.map.items())))


def test_repeats_ask_for_state_once():
    """A keyword's rows of one batch, however many, cost the same few messages to the state; what is seen and sent follows the rule over batches."""
    from types import SimpleNamespace

    import pandas as pd

    from lectern.streaming import loop

    calls, rng = [], random.Random(4)
    p = loop._Repeats("k", ttl=8, cooldown=60, idle=3600)
    p.handle = SimpleNamespace(deleteTimer=lambda t: None, registerTimer=lambda t: None)
    p.seen, p.sent, p.timer = _Held(calls), _Held(calls), _Held(calls)
    seen, last, at = {}, None, 1_790_000_000
    for size in (1, 40, 400, 3):
        rows = []
        for _ in range(size):
            at += rng.choice([0, 1, 3])
            rows.append((len(rows), pd.Timestamp(at, unit="s", tz="UTC"), "s", "K", 0, rng.choice("ab")))
        want = []
        for seq, ts, _, _, _, c in rows:
            now = ts.timestamp()
            if now - seen.get(c, -1e9) >= 8:
                seen[c], send = now, last is None or now - last >= 60
                last = now if send else last
                want.append((seq, c, send))
        calls.clear()
        got = list(p.handleInputRows(("k", "K"), iter([pd.DataFrame(rows, columns=["seq", "ts", "speaker", "keyword", "start", "context"])]), SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)))[0]
        assert [tuple(r) for r in got[["seq", "context", "send"]].itertuples(index=False)] == want
        assert len(calls) <= 12 and all(at - v[0] < 8 for v in p.seen.map.values())
