"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import table

#: Rows that a bucket of keys holds at most on average, and the narrowest bucket (in the key's logarithm).
_BUCKET_ROWS, _NARROWEST = 4096, 1e-4


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def plainness(text: Column) -> Column:
    """A quality weight from 0.0005 to 1: the fourth power of the share of characters that are no symbols or digits."""
    n = F.length(text)
    symbols = n - F.length(F.regexp_replace(text, r"[!-&(-+/-@\[-`{-~]", ""))
    return F.coalesce(F.pow(F.greatest(1 - symbols / F.nullif(n, F.lit(0)), F.lit(0.15)), F.lit(4.0)), F.lit(0.0005))


def targets(sizes: DataFrame, pattern: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sizes(source, source_size, ...)`` with each source's ``target``.

    Sources by code point, null last, weigh as ``pattern`` repeats; together they get ``share`` of all sizes; no target is
    above ``cap`` times its source's size, and what is above goes to the others by weight until none is above (total
    targets fall short only where all are capped). In order of cap / weight, a source is capped if its fair part of what
    the ones before it leave would exceed its cap. The table has a row per source, so one task can order it.
    """
    by_name, by_ratio = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", "place")
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weights = F.array(*(F.lit(float(x)) for x in pattern))
    out = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    out = out.withColumn("weight", F.get(weights, F.pmod("place", F.lit(len(pattern))).cast("int")))
    out = out.withColumn("limit", cap * F.col("source_size")).withColumn("ratio", F.col("limit") / F.col("weight"))
    out = out.withColumn("left", share * F.sum("source_size").over(whole) - (F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("limit")))
    out = out.withColumn("others", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    out = out.withColumn("capped", F.col("left") >= F.col("ratio") * F.col("others"))
    level = F.first(F.when(~F.col("capped"), F.col("left") / F.col("others")), ignorenulls=True).over(whole)
    out = out.withColumn("target", F.when(F.col("capped"), F.col("limit")).otherwise(level * F.col("weight")))
    return out.drop("place", "weight", "limit", "ratio", "left", "others", "capped")


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of a source's last bucket in order of key, each taken if it still fits into what is left of the target."""
    rows = rows.sort_values(["key", "doc_id", "row"])
    left, taken = rows["room"].iloc[0], []
    for size in rows["size"]:
        taken.append(size <= left)
        left -= size if size <= left else 0
    return rows.loc[taken, ["row"]]


def mix(docs: DataFrame, quality: Column | None = None, seed: int = 1, **shares) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs(doc_id, text, source, ...)``.

    A source's target (see ``targets``, which takes ``shares``) is met with whole epochs first; what is left is a weighted
    sample without replacement: each document gets an exponential key divided by its weight ``quality``, keys are sorted
    within the source, and documents are taken by prefix sum of their sizes in words. Where the next document no longer
    fits, later ones of the same bucket of keys fill the rest. ``copies`` counts how often a document is taken, ``taken``
    its words. Keys come from a hash of doc_id and ``seed``, so reruns agree; ties go by doc_id.

    No source is ever sorted as a whole. Keys fall into buckets by their logarithm, whose density no choice of weights can
    push above 1/e, so a bucket's share of its source is bounded. Sizes per bucket are pre-aggregated and prefix-summed;
    buckets before the target are taken, those after it not, and only the one that it falls into is sorted.

    Null and empty texts have size 0 and are taken with their epoch; rows that repeat a doc_id are separate documents with
    one key; an empty table gives no rows; other columns are ignored.
    """
    return _planned(docs, [], quality, seed, **shares).withColumn("taken", F.col("copies") * F.col("size"))


def _planned(docs: DataFrame, carried: list[Column], quality: Column | None = None, seed: int = 1, **shares) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` of every row, and ``carried`` columns of it."""
    weight = plainness(F.col("text")) if quality is None else F.greatest(quality.cast("double"), F.lit(1e-9))
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    rows = docs.select(F.col("doc_id").cast("long"), "source", word_count(F.col("text")).alias("size"), weight.alias("w"), *carried)
    rows = rows.withColumn("key", -F.ln(uniform) / F.col("w")).drop("w").withColumn("row", F.monotonically_increasing_id())
    # a null source joins like any other
    rows = table(rows.withColumn("named", F.col("source").isNotNull()).withColumn("s", F.coalesce("source", F.lit(""))), "sized")
    on = ["named", "s"]
    sources = rows.groupBy(*on, "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = targets(sources, **shares)
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("long")
    width = F.greatest(F.least(F.lit(1.0), _BUCKET_ROWS * 2.7 / F.col("n")), F.lit(_NARROWEST))
    sources = sources.withColumn("epochs", epochs).withColumn("width", width)
    sources = table(sources.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).drop("source", "n"), "targets")
    bucket = F.floor(F.ln("key") / F.col("width")).alias("bucket")
    dealt = rows.join(sources, on).withColumn("bucket", bucket)
    sums = dealt.groupBy(*on, "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    before = F.sum("words").over(Window.partitionBy(*on).orderBy("bucket")) - F.col("words")
    sums = sums.withColumn("before", before).select(
        *on, "bucket", (F.col("before") + F.col("words") <= F.col("rest")).alias("whole"),
        F.when(F.col("before") < F.col("rest"), F.col("rest") - F.col("before")).alias("room"),
    )
    sums = table(sums, "buckets")
    edge = dealt.join(sums.filter("not whole and room is not null"), [*on, "bucket"])
    filled = table(edge.select(*on, "row", "doc_id", "key", "size", "room").groupBy(*on).applyInPandas(_fill, "row long"), "filled")
    out = dealt.join(sums.select(*on, "bucket", "whole"), [*on, "bucket"]).join(filled.withColumn("fits", F.lit(True)), "row", "left")
    copies = F.col("epochs") + (F.col("whole") | F.coalesce("fits", F.lit(False))).cast("long")
    more = [c for c in rows.columns if c not in ("doc_id", "source", "size", "key", "row", *on)]
    return out.withColumn("copies", copies).select("doc_id", "source", "size", "source_size", "target", "copies", *more)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them, with all their columns.

    Each row is taken by its own draw, without a doc_id or with a repeated one too. Rows are stored whole with their keys;
    the tables they are joined to, of sources, buckets and filled rows, are stored before, so that Spark knows their sizes:
    texts are shuffled only where those are too large to broadcast.
    """
    whole = F.struct(*docs.columns).alias("whole_row")
    plan = _planned(docs, [whole], **options).filter("copies > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_time")
    return plan.select("whole_row", times).select(*(F.col("whole_row")[c].alias(c) for c in docs.columns))
