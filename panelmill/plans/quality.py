"""Data-quality checks as one aggregate each, and freshness gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import commits


def freshness(latest: DataFrame, expected: DataFrame, session: Column, most: float = 0.02) -> DataFrame:
    """``symbol, last_date, critical, stale, status``: each expected symbol against the last session.

    ``latest(symbol, last_date)``, ``expected(symbol, critical)``. A stale critical symbol is an error; others are if more
    than ``most`` of all are stale, else a warning.
    """
    j = expected.join(latest, "symbol", "left").withColumn("stale", F.col("last_date").isNull() | (F.col("last_date") < session))
    rate = j.agg(F.avg(F.col("stale").cast("double")).alias("_rate"))
    status = F.when(~F.col("stale"), "ok").when(F.col("critical"), "error").when(F.col("_rate") > most, "error").otherwise("warn")
    return j.crossJoin(F.broadcast(rate)).withColumn("status", status).drop("_rate")


def price_bundle(columns: list[str]) -> dict[str, Column]:
    """Counts of bad rows of prices, each an aggregate: shape, nulls and event time."""
    checks = {
        "empty": F.when(F.count("*") == 0, 1).otherwise(0),
        "high_below_low": F.count_if(F.col("high") < F.col("low")),
        "negative_volume": F.count_if(F.col("volume") < 0),
        "close_outside": F.count_if((F.col("close") > F.col("high")) | (F.col("close") < F.col("low"))),
        "null_close": F.count_if(F.col("close").isNull()),
    }
    if {"_source_event_ts", "_ingest_ts"} <= set(columns):
        checks["event_after_ingest"] = F.count_if(F.col("_source_event_ts") > F.col("_ingest_ts"))
    return {k: v.cast("long") for k, v in checks.items()}


def price_checks(p: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """``check, failures`` of prices: the bundle, duplicates and dates that go back, from one pass and one count of keys."""
    one = p.agg(*(v.alias(k) for k, v in price_bundle(p.columns).items()))
    twice = p.groupBy(*keys).count().filter("count > 1").agg(F.count("*").alias("duplicate_keys"))
    out = one.crossJoin(twice)
    if order:
        w = Window.partitionBy("symbol").orderBy(order)
        back = p.withColumn("_was", F.lag("date").over(w)).agg(F.count_if(F.col("date") < F.col("_was")).alias("dates_backwards"))
        out = out.crossJoin(back)
    return out.unpivot([], out.columns, "check", "failures")


def land_checked(p: DataFrame, path: str, keys: list[str], part: Column) -> dict[str, int]:
    """Land prices as a table of commits if the bundle and the keys hold; the failures by check, all of them.

    The checks are counted while the rows are written: rows are read once, and shuffled once by key, in which repeats are seen.
    With any failure nothing is committed, so no reader ever sees the rows.
    """
    copies = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    checks = price_bundle(p.columns) | {"duplicate_keys": F.count_if(F.col("_check_copy") == 2)}
    try:
        commits.rebuild(p.withColumn("_check_copy", copies), path, part, checks=checks)
    except commits.ChecksFailed as e:
        return e.counts
    return dict.fromkeys(checks, 0)


def null_shares(df: DataFrame, most: float = 0.05) -> DataFrame:
    """``column, null_share, failed`` of all columns in one pass."""
    one = df.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns))
    long = one.unpivot([], one.columns, "column", "null_share")
    return long.withColumn("failed", F.col("null_share") > most)


def shape(df: DataFrame, expected: list[str]) -> DataFrame:
    """``check, ok``: whether the table has rows, and each expected column, from one aggregate."""
    there = {"not_empty": F.count("*") > 0} | {f"has_{c}": F.lit(c in df.columns) for c in expected}
    one = df.agg(*(v.alias(k) for k, v in there.items()))
    return one.unpivot([], list(there), "check", "ok")


def last_session(sessions: DataFrame, at: Column) -> DataFrame:
    return sessions.filter(F.col("date") <= at).agg(F.max("date").alias("session"))


def completed_session(now: Column, close: str = "16:30:00", zone: str = "America/New_York") -> Column:
    """The date whose session is over at the UTC time ``now``: today after the close in New York, else yesterday."""
    local = F.from_utc_timestamp(now, zone)
    return F.when(F.date_format(local, "HH:mm:ss") >= close, F.to_date(local)).otherwise(F.date_sub(F.to_date(local), 1))
