"""Joins that SQL engines name differently: as-of, validity intervals, latest-date filters, optional sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_left(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str, prefix: str = "") -> DataFrame:
    """Each left row with the newest right row of the same ``by`` whose ``right_ts`` is at or before ``left_ts``.

    Both sides are unioned and the last right row is carried forward in one window: one shuffle by key, no quadratic join.
    The right row is carried as a struct, so its NULLs stay. A NULL key or time matches nothing. Of right rows with
    equal key and time one is taken. Right columns get ``prefix``; the key isn't repeated.
    """
    payload = [c for c in right.columns if c not in by]
    r = right.dropDuplicates([*by, right_ts]).filter(F.col(right_ts).isNotNull()).select(
        *by, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), F.struct(*payload).alias("_r"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_l")
    )
    nothing = F.lit(None).cast(r.schema["_r"].dataType)
    rows = left.select(*by, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), nothing.alias("_r"), F.struct(*left.columns).alias("_l"))
    w = Window.partitionBy(*by).orderBy(F.col("_ts").asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, 0)
    known = F.col("_ts").isNotNull()
    for k in by:
        known = known & F.col(k).isNotNull()
    out = r.unionByName(rows).withColumn("_m", F.last("_r", ignorenulls=True).over(w)).filter("_side = 1")
    match = F.when(known, F.col("_m"))
    return out.select("_l.*", *(match[c].alias(prefix + c) for c in payload))


def valid_at(facts: DataFrame, versions: DataFrame, key: str, date: str, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """Each fact row with the version of its key that was known before ``date``: start < date, and not ended before it.

    A version counts from the day after it came, and its predecessor through that day. Versions of a key don't overlap, as
    ``versions`` and ``scd2_apply`` make them; of several that came on one day the last counts. So the newest version before
    the date is the only one that can be valid: an as-of join, linear in the rows of a key.
    """
    v = versions.filter(f"{start} is not null").select(F.col(key), F.date_add(F.to_date(start), 1).alias("_from"), F.struct(*(c for c in versions.columns if c != key)).alias("_v"))
    best = v.groupBy(key, "_from").agg(F.max_by("_v", F.struct(F.col(f"_v.{end}").isNull(), F.to_date(f"_v.{end}"), f"_v.{start}")).alias("_v"))
    out = asof_left(facts, best, [key], date, "_from").drop("_from")
    on = F.col(f"_v.{end}").isNull() | (F.to_date(f"_v.{end}") >= F.col(date))
    rest = [c for c in versions.columns if c != key]
    return out.withColumn("_v", F.when(on, F.col("_v"))).select(*facts.columns, *(F.col("_v")[c].alias(c) for c in rest))


def on_latest(df: DataFrame, date: str, by: str = "symbol") -> DataFrame:
    """The rows of the newest date, in one pass: each ``by`` keeps its own newest rows, of which the newest date's stay.

    The second step sees a row per ``by`` (as many as share its newest date), so one task can hold it. A table without ``by``
    is read twice, once for the date.
    """
    if by not in df.columns:
        newest = df.agg(F.max(date).alias("_newest"))
        return df.join(F.broadcast(newest), F.col(date) == F.col("_newest")).drop("_newest")
    own = df.withColumn("_own", F.max(date).over(Window.partitionBy(by))).filter(F.col(date) == F.col("_own"))
    return own.withColumn("_newest", F.max("_own").over(Window.partitionBy(F.lit(0)))).filter("_own = _newest").drop("_own", "_newest")


def with_optional(left: DataFrame, right: DataFrame | None, on: Sequence[str], types: dict[str, str]) -> DataFrame:
    """A left join where ``right`` is there, typed NULL columns where it is not."""
    if right is None:
        return left.withColumns({c: F.lit(None).cast(t) for c, t in types.items()})
    return left.join(right.select(*on, *types), list(on), "left")
