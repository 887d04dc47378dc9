"""Stored tables that change in one step, and journals to which each batch is added once.

A versioned table is a folder with a folder for each version and a pointer that names the one that counts. A change reads the version that
counts, writes the next one and then puts a new pointer in the old one's place, one rename: readers see the old table or the new one, and a
job that dies in between has changed nothing. A version that cannot be read is not written over. Old versions stay until prune().

A journal is a folder of batches and a folder of commits. A batch is written under its number, in place of what an earlier attempt at it left, and
committed by an entry of its own; readers take committed batches only.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Unreadable(RuntimeError):
    """The stored version, or its pointer, cannot be read; nothing was written."""


def _files(spark: SparkSession, path: str):
    """Hadoop's file context and the path as it takes it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return hadoop, hadoop.FileContext.getFileContext(where.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())


def _pointer(path: str) -> str:
    return f"{path.rstrip('/')}/CURRENT"


def version_of(spark: SparkSession, path: str) -> int:
    """The number of the version that counts, 0 if there is none yet."""
    hadoop, files = _files(spark, path)
    if not files.util().exists(hadoop.Path(_pointer(path))):
        return 0
    rows = [r["value"].strip() for r in spark.read.text(_pointer(path)).collect()]  # one line
    if len(rows) != 1 or not rows[0].isdigit():
        raise Unreadable(f"{_pointer(path)} does not name a version")
    return int(rows[0])


def _folder(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version}"


def read_version(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table as it counts now, None if there is none yet. All of it is read once, so that what cannot be read shows here."""
    version = version_of(spark, path)
    if not version:
        return None
    try:
        held = spark.read.schema(schema).parquet(_folder(path, version))
        held.select(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*held.columns))).collect()
    except (PySparkException, Py4JError) as error:
        raise Unreadable(f"version {version} of {path} cannot be read") from error
    return held


def _switch(spark: SparkSession, path: str, version: int) -> None:
    """Lets a version count: a new pointer is written beside the old one and renamed over it."""
    hadoop, files = _files(spark, path)
    new = hadoop.Path(f"{path.rstrip('/')}/.next-{version}")
    out = new.getFileSystem(spark._jsc.hadoopConfiguration()).create(new, True)
    out.write(bytearray(f"{version}\n".encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(new, hadoop.Path(_pointer(path)), over)


def change(spark: SparkSession, path: str, schema, work: Callable[[DataFrame], DataFrame]) -> int:
    """Replaces the table by work(table) in one step and gives the new version's number; an empty table stands in for none.

    Raises Unreadable, and writes nothing, where the table that is there cannot be read.
    """
    held = read_version(spark, path, schema)
    version = version_of(spark, path) + 1
    new = work(spark.createDataFrame([], schema) if held is None else held)
    new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], schema).schema]).write.mode("overwrite").parquet(_folder(path, version))
    _switch(spark, path, version)
    return version


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes all but the newest versions that count or counted."""
    hadoop, files = _files(spark, path)
    for version in range(version_of(spark, path) - keep, 0, -1):
        where = hadoop.Path(_folder(path, version))
        if not files.util().exists(where):
            break
        files.delete(where, True)


# --- Journals ----------------------------------------------------------------------------------------------


def add_batch(batch: DataFrame, path: str, number: int, key: list[str]) -> None:
    """A batch under its number, each key once, and then its commit."""
    batch.dropDuplicates(key).write.mode("overwrite").parquet(f"{path.rstrip('/')}/data/batch={number}")
    done = batch.sparkSession.range(1).select(F.lit(number).cast("long").alias("number"))
    done.write.mode("overwrite").parquet(f"{path.rstrip('/')}/commits/of={number}")


def journal_sink(path: str, key: list[str]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: a batch that runs again takes its own place, so each row is there once."""
    return lambda batch, number: add_batch(batch, path, number, key)


def read_journal(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of committed batches, with the batch's number."""
    hadoop, files = _files(spark, path)
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    if not files.util().exists(hadoop.Path(f"{path.rstrip('/')}/commits")):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(0).cast("long"))
    commits = spark.read.schema("number long").parquet(f"{path.rstrip('/')}/commits").distinct()
    held = spark.read.schema(schema).option("basePath", f"{path.rstrip('/')}/data").parquet(f"{path.rstrip('/')}/data")
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/", 1).cast("long")
    return held.select(*names, batch.alias("batch")).join(F.broadcast(commits), F.col("batch") == F.col("number"), "left_semi")
