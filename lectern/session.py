"""Session settings that every query relies on, and the folder that its steps share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with UTC time and adaptive execution; on a cluster leave master and the partition count to the submitter."""
    b = SparkSession.builder.appName("lectern").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, in a local session without it a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lectern-work-")
    return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """rows as a table in a shared folder: what several steps need of them is found once."""
    path = work_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
