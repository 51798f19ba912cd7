"""Writing: appends, shapes, upserts as plans, trial numbers. Plans stay lazy; only ``stored`` and the ``write_`` functions run jobs.

Tables that change under readers and other writers are in ``commits``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share (``spark.checkpoint.dir``); in local mode a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _OWN:
            _OWN.append("file://" + tempfile.mkdtemp(prefix="panelmill-"))
        root = _OWN[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again, for plans that read it several times."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, name: str, by: str, order: str) -> DataFrame:
    """``df`` written once in buckets of ``by``, each sorted by ``order``: windows and joins by that key read it without a shuffle."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch(spark, name)
    table = "panelmill_" + path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(n, by).write.bucketBy(n, by).sortBy(by, order).option("path", path).saveAsTable(table)
    return spark.table(table)


def write_sorted(df: DataFrame, path: str, *order: Column) -> None:
    """Write a table in order: ranges of it in files whose names sort as the ranges do, each file in order."""
    df.orderBy(*order).write.parquet(path)


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """A ``write_sorted`` table with ``position``, a row's place in the whole, from 1: files are read apart, and a row per file
    says how many rows come before."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")
    return rows.join(F.broadcast(files.select("_file", before.alias("_before"))), "_file").withColumn("position", F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_append(df: DataFrame, path: str) -> None:
    """Append; new columns are allowed, readers merge schemas."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_shape(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """An empty table, unless one is there."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``updates`` in place of those with their keys, and the new ones; columns may differ."""
    kept = target.join(updates.select(*keys).distinct(), list(keys), "left_anti")
    return updates.unionByName(kept, allowMissingColumns=True)


def numbered_trials(log: DataFrame, trials: DataFrame, order: str) -> DataFrame:
    """New log rows, numbered on from the log's last number; a trial's row is written before any result exists."""
    last = log.agg(F.coalesce(F.max("trial"), F.lit(0)).alias("_last"))
    w = Window.partitionBy(F.lit(1)).orderBy(order)  # a handful of configured trials
    return trials.withColumn("_n", F.row_number().over(w)).crossJoin(last).withColumn("trial", (F.col("_last") + F.col("_n")).cast("int")).drop("_last", "_n")


def evolve(target: DataFrame, updates: DataFrame) -> list[str]:
    """Columns that the updates bring and the target lacks."""
    return [c for c in updates.columns if c not in target.columns]
