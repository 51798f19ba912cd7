"""Exact deduplication by a tree-merge of sorted digest runs, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import join_groups, partitions, table

#: Characters that don't count when texts are compared.
IGNORED = " \t\n\x0b\x0c\r"
_KEY = ["digest", "check", "length"]


def normalised(text: Column) -> Column:
    """The text without white space of ASCII; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in IGNORED:
        out = F.replace(out, F.lit(c))
    return out


def _merged(runs: DataFrame, level: int, fan_in: int, count: int) -> DataFrame:
    """One round: the ``fan_in`` runs whose numbers differ in one digit trade digests, so that the digit becomes the digest's.

    A run is in one task, which gets a sorted stretch from each of the others, merges them (a sort of stretches that are
    sorted already), and aggregates the sorted rows: of each verified key it retains the best row (as a struct, hence by
    sort-based aggregation) and the number of rows it stands for.
    """
    unit = fan_in**level
    digit = lambda x: f"pmod({x} div {unit}, {fan_in})"
    traded = runs.withColumn("run", F.expr(f"run + ({digit('aim')} - {digit('run')}) * {unit}"))
    merged = traded.repartition(count, "run").sortWithinPartitions("run", *_KEY)
    return merged.groupBy("run", *_KEY).agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def exact_duplicates(docs: DataFrame, fan_in: int = 8) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs(doc_id long, text string, ...)``.

    Texts are equal when they are so after deleting ASCII white space. Of equal texts the row stays that has the most code
    points, then the smallest doc_id (a null doc_id last); of rows that repeat even the doc_id exactly one stays.

    Every partition is a run of (SHA-256, second hash, length) keys; equality of all three verifies a match. In round k
    the runs whose numbers agree but for digit k merge, ``fan_in`` at a time, and each retains the best identifier per key
    and a count, so a group of copies is one row per run from the first round on: no task gets more copies of a text than
    ``fan_in`` runs hold. After log_fan_in(partitions) rounds each key is in one run, and the runs together are written to
    the shared folder. Null and empty texts are equal to each other; an empty table gives no rows; other columns of any
    name are ignored.
    """
    spark = docs.sparkSession
    text = normalised(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long"), "text").select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).alias("points"),
        text.alias("text"),
    )
    rows = table(
        rows.select(
            "doc_id", "points", F.unhex(F.sha2("text", 256)).alias("digest"), F.xxhash64("text").alias("check"),
            F.length("text").alias("length"), F.monotonically_increasing_id().alias("row"),
        ).sortWithinPartitions(*_KEY),
        "digests",
    )
    levels, count = 1, fan_in
    while count < partitions(spark):
        levels, count = levels + 1, count * fan_in
    # ~x orders as -x does, without overflow
    best = F.struct("points", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("row"))
    runs = rows.select(
        F.pmod(F.spark_partition_id(), F.lit(count)).cast("long").alias("run"), *_KEY, best.alias("best"), F.lit(1).cast("long").alias("n"),
    )
    for level in range(levels):
        runs = _merged(runs.withColumn("aim", F.pmod("check", F.lit(count))), level, fan_in, count)
    winners = runs.select(*_KEY, F.bitwise_not("best.id").alias("keep_id"), F.bitwise_not("best.row").alias("keep_row"), "n")
    return join_groups(rows, table(winners, "winners"), _KEY, rows.count()).select(
        "doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
