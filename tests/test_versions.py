"""Tables that change in one step, and journals with each row once, also where a job dies in between."""

import os

import pytest
from pyspark.sql import functions as F

from lectern.sources import versions as V

SCHEMA = "name string, text string"


def rows(spark, path):
    held = V.read_version(spark, path, SCHEMA)
    return None if held is None else sorted(tuple(r) for r in held.collect())


def renamed(old, new):
    return lambda d: d.withColumn("name", F.when(F.col("name") == old, new).otherwise(F.col("name")))


def test_a_change_is_one_step(spark, tmp_path):
    path = f"{tmp_path}/store"
    assert rows(spark, path) is None
    assert V.change(spark, path, SCHEMA, lambda d: spark.createDataFrame([("a", "1"), ("b", "2")], SCHEMA)) == 1
    assert V.change(spark, path, SCHEMA, renamed("a", "c")) == 2
    assert rows(spark, path) == [("b", "2"), ("c", "1")]  # the old name went with the switch
    V.change(spark, path, SCHEMA, lambda d: d.where("name = 'c'"))
    V.prune(spark, path, keep=2)
    assert rows(spark, path) == [("c", "1")] and sorted(x for x in os.listdir(path) if x.startswith("version")) == ["version=2", "version=3"]


def test_what_cannot_be_read_is_not_written_over(spark, tmp_path):
    path = f"{tmp_path}/store"
    V.change(spark, path, SCHEMA, lambda d: spark.createDataFrame([("a", "1")], SCHEMA))
    part = next(f"{path}/version=1/{f}" for f in os.listdir(f"{path}/version=1") if f.endswith(".parquet"))
    sums = os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc")
    if os.path.exists(sums):
        os.remove(sums)
    with open(part, "wb") as f:
        f.write(b"no parquet")
    before = sorted(os.listdir(path))
    with pytest.raises(V.Unreadable):
        V.change(spark, path, SCHEMA, lambda d: spark.createDataFrame([("b", "2")], SCHEMA))
    assert sorted(os.listdir(path)) == before and open(part, "rb").read() == b"no parquet"
    with open(f"{path}/CURRENT", "w") as f:
        f.write("soon\n")
    os.remove(f"{path}/.CURRENT.crc") if os.path.exists(f"{path}/.CURRENT.crc") else None
    with pytest.raises(V.Unreadable):
        V.change(spark, path, SCHEMA, lambda d: d)


def test_a_job_that_dies_before_the_switch_has_changed_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/store"
    V.change(spark, path, SCHEMA, lambda d: spark.createDataFrame([("a", "1")], SCHEMA))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(V, "_switch", dies)
        with pytest.raises(RuntimeError, match="lost"):
            V.change(spark, path, SCHEMA, renamed("a", "z"))
    assert rows(spark, path) == [("a", "1")]
    assert V.change(spark, path, SCHEMA, renamed("a", "b")) == 2 and rows(spark, path) == [("b", "1")]


def test_journal_batches_count_once_they_are_committed(spark, tmp_path, monkeypatch):
    path, schema = f"{tmp_path}/journal", "id long, text string"
    batch = lambda *r: spark.createDataFrame(list(r), schema)
    assert V.read_journal(spark, path, schema).count() == 0
    sink = V.journal_sink(path, ["id"])
    sink(batch((1, "a"), (2, "b"), (2, "b")), 0)
    sink(batch((3, "c")), 1)
    sink(batch((3, "c")), 1)  # runs again
    batch((4, "half")).write.parquet(f"{path}/data/batch=2")  # died before its commit
    held = V.read_journal(spark, path, schema)
    assert sorted(tuple(r) for r in held.collect()) == [(1, "a", 0), (2, "b", 0), (3, "c", 1)]
    sink(batch((4, "whole"), (5, "e")), 2)
    assert sorted(r.text for r in V.read_journal(spark, path, schema).where("batch = 2").collect()) == ["e", "whole"]


def test_journal_of_a_stream_that_is_started_again(spark, tmp_path):
    path, schema = f"{tmp_path}/journal", "id long, text string"
    for i in range(3):
        spark.createDataFrame([(i, f"t{i}"), (i, f"t{i}")], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").writeStream.foreachBatch(V.journal_sink(path, ["id"])).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert sorted((r.id, r.text) for r in V.read_journal(spark, path, schema).collect()) == [(0, "t0"), (1, "t1"), (2, "t2")]
