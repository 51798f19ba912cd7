"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_OWN: list[str] = []


def folder(spark: SparkSession) -> str:
    """URI of the shared folder: ``spark.checkpoint.dir``, or one of our own where that is unset (local tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="panelmill-"))
    return _OWN[0]


def place(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage is cut, and lost executors cost nothing."""
    spark = df.sparkSession
    path = place(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``table`` wrote and that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t._stored)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(docs: DataFrame) -> DataFrame:
    """``docs``, with the session's Arrow batches bounded to 4 MB (a longer text is a batch of its own) unless they are already.

    By default a batch is 10,000 rows, whatever their texts' length, and a task holds several batches at once.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if docs.sparkSession.conf.get(key, None) is None:
        docs.sparkSession.conf.set(key, "4m")
    return docs


def give_back() -> None:
    """Return what a finished task's libraries have freed to the system, as its worker process stays for later tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` inner-joined to ``groups(*keys, ..., n)``, which has a row per key and n, the rows that the key has.

    A join to an aggregate of the same rows is one that Spark can't split. So groups that alone would fill a quarter of a
    partition go to every task: they are less than four a partition, as all n together are at most ``total``. The other
    groups are shuffled, none of them large enough to hold a task up.
    """
    least = max(1, total // (4 * partitions(rows.sparkSession)))
    values = [c for c in groups.columns if c not in keys]
    hot = groups.filter(F.col("n") > least)
    rest = rows.join(F.broadcast(hot.select(*keys, F.struct(*values).alias("_hot"))), keys, "left").filter("_hot is null").drop("_hot")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(groups.filter(F.col("n") <= least), keys))


def filesystem(uri: str):
    """(file system, path in it) of a shared URI, for tasks that read or write byte ranges."""
    from pyarrow import fs

    found, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))
    return found, path
