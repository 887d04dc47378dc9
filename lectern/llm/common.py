"""Session, sizing, naming and clean-up helpers of the corpus operators."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- the caller's columns ----------------------------------------------------------------------------------


def place(names: list[str], wanted: str) -> int:
    """Where a column stands: by its exact name, else by the only name that differs in case alone."""
    exact = [i for i, n in enumerate(names) if n == wanted]
    near = [i for i, n in enumerate(names) if n.lower() == wanted.lower()]
    if exact or len(near) == 1:
        return (exact or near)[0]
    raise ValueError(f"no column {wanted!r} among {names}")


class Columns:
    """The caller's columns while an operator works: those it reads under its own names, all others as c0, c1, ...

    So no name of the caller clashes with a helper column, and names that differ in case alone stay apart. outputs are the columns
    that the operator adds; a column of the caller with just such a name is replaced.
    """

    def __init__(self, docs: DataFrame, outputs: tuple[str, ...] = (), **roles: str):
        names = docs.columns
        inner = [f"c{i}" for i in range(len(names))]
        for role, name in roles.items():
            inner[place(names, name)] = role
        self.outputs, self.roles = list(outputs), list(roles)
        self.kept = [(i, n) for i, n in zip(inner, names) if n not in outputs]
        self.frame = docs.toDF(*inner)
        spare = [i for i, n in zip(inner, names) if n in outputs and i not in roles]
        if spare:
            self.frame = self.frame.drop(*spare)

    def only(self) -> DataFrame:
        """The columns that the operator reads, alone."""
        return self.frame.select(*self.roles)

    def result(self, found: DataFrame) -> DataFrame:
        """found (the frame's columns and the outputs) under the caller's names."""
        out = found.select(*[i for i, _ in self.kept], *self.outputs)
        return out.toDF(*[n for _, n in self.kept], *self.outputs)


# --- the shared folder -------------------------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Without that setting a local session (tests) gets a folder of its own; on a cluster it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lectern-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/lectern-{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, and every later reader sees the same rows."""
    path = shared_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(*tables: DataFrame) -> None:
    """Deletes tables that written() made and that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if folder.rpartition("/")[2].startswith("lectern-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# --- sizes -------------------------------------------------------------------------------------------------


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate: file sizes for a scan, nothing is read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_count(df: DataFrame, text: str, times: int = 1) -> int:
    """Blocks of about 100 * sqrt(size) bytes: both their number and their size grow with the root of the input,
    so that the block-by-bucket messages grow in proportion to it (times: so many more, smaller ones). Where Catalyst has no size, the texts are measured."""
    size = estimated_bytes(df)
    if size >= 1 << 50:
        size = int(df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0)
    size = max(1, size)
    block = min(max(4 << 20, int(100 * math.sqrt(size))), 256 << 20)
    return max(math.ceil(times * size / block), shuffle_width(df.sparkSession))


def crc_remainder(column: str, modulus: int):
    """crc32 of the id as text modulo a number; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
