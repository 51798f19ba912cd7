"""Versioned rows: change hashes, applying a batch of updates, and building all versions from a history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import latest_per_key


def attr_hash(attrs: Sequence[str]) -> Column:
    """First 16 hex digits of the SHA-256 of the attributes as JSON, in order of name."""
    return F.substring(F.sha2(F.to_json(F.struct(*sorted(attrs))), 256), 1, 16)


def scd2_apply(current: DataFrame, updates: DataFrame, key: str, attrs: Sequence[str], ts: str) -> DataFrame:
    """``current(key, attrs, effective_from, effective_to, is_current, attr_hash)`` after a batch of ``updates(key, attrs, ts)``.

    An unchanged key is skipped, a changed one's current row ends where the new one begins, a new key is inserted; the past
    stays. One full outer join on the key among current rows.
    """
    new = updates.withColumn("attr_hash", attr_hash(attrs)).select(
        F.col(key), F.struct(*attrs, F.col(ts).alias("effective_from"), "attr_hash").alias("n")
    )
    past = current.filter("not is_current")
    now = current.filter("is_current").select(F.col(key), F.struct(*[c for c in current.columns if c != key]).alias("o"))
    joined = now.join(new, key, "full_outer")
    changed = F.col("n").isNotNull() & (F.col("o").isNull() | (F.col("o.attr_hash") != F.col("n.attr_hash")))
    kept = joined.filter(F.col("o").isNotNull()).select(
        key, *[F.col(f"o.{a}") for a in attrs], "o.effective_from",
        F.when(changed, F.col("n.effective_from")).otherwise(F.col("o.effective_to")).alias("effective_to"),
        (~changed).alias("is_current"), "o.attr_hash",
    )
    added = joined.filter(changed).select(
        key, *[F.col(f"n.{a}") for a in attrs], "n.effective_from", F.lit(None).cast(current.schema["effective_to"].dataType).alias("effective_to"),
        F.lit(True).alias("is_current"), "n.attr_hash",
    )
    return past.select(kept.columns).unionByName(kept).unionByName(added)


def versions(history: DataFrame, key: str, attrs: Sequence[str], ts: str, order: Sequence[str] = ()) -> DataFrame:
    """All versions of a history of snapshots: a row where the attributes change, ended by the next change."""
    w = Window.partitionBy(key).orderBy(ts, *order)
    hashed = history.withColumn("attr_hash", attr_hash(attrs))
    changes = hashed.withColumn("_was", F.lag("attr_hash").over(w)).filter("_was is null or _was <> attr_hash")
    end = F.lead(ts).over(w)
    return changes.select(
        key, *attrs, F.col(ts).alias("effective_from"), end.alias("effective_to"), end.isNull().alias("is_current"), "attr_hash"
    )


def current(versions_: DataFrame, key: str) -> DataFrame:
    """The current row of each key, the newest if several claim to be."""
    return latest_per_key(versions_.filter("is_current"), [key], F.col("effective_from").desc())
