"""A trading calendar from rules: holidays, early closes, session counters and neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Easter Sunday's day number after 1 March less one, by the Gregorian rule (Meeus); q, r, ... are its usual helpers.
EASTER = (
    ("qa", "y % 19"), ("qb", "y div 100"), ("qc", "y % 100"), ("qd", "qb div 4"), ("qe", "qb % 4"), ("qf", "(qb + 8) div 25"), ("qg", "(qb - qf + 1) div 3"),
    ("qh", "(19 * qa + qb - qd - qg + 15) % 30"), ("qi", "qc div 4"), ("qk", "qc % 4"), ("ql", "(32 + 2 * qe + 2 * qi - qh - qk) % 7"),
    ("qm", "(qa + 11 * qh + 22 * ql) div 451"), ("em", "(qh + ql - 7 * qm + 114) div 31"), ("ed", "(qh + ql - 7 * qm + 114) % 31 + 1"),
)
# Days on which the exchange was closed by no rule.
ONE_OFF = ("1994-04-27", "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09")


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """A row per day from ``first`` to ``last``."""
    return calendar_of(spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date")))


def calendar_of(days: DataFrame) -> DataFrame:
    """The calendar of ``days(date)``, which are different and without gaps."""
    d = days.withColumns({"y": F.year("date"), "m": F.month("date"), "dom": F.dayofmonth("date"), "dow": F.weekday("date")})
    for name, e in EASTER:
        d = d.withColumn(name, F.expr(e).cast("int"))
    nth = F.ceil(F.col("dom") / 7).cast("int")
    m, dom, dow, y = (F.col(c) for c in ("m", "dom", "dow", "y"))
    observed = lambda mm, dd: (m == mm) & ((dom == dd) | ((dom == dd + 1) & (dow == 0)) | ((dom == dd - 1) & (dow == 4)))
    new_year = (m == 1) & ((dom == 1) | ((dom == 2) & (dow == 0)))
    holiday = (
        new_year | ((m == 1) & (dow == 0) & (nth == 3) & (y >= 1998)) | ((m == 2) & (dow == 0) & (nth == 3)) | (F.date_add("date", 2) == F.make_date("y", "em", "ed"))
        | ((m == 5) & (dow == 0) & (dom > 24)) | (observed(6, 19) & (y >= 2022)) | observed(7, 4) | ((m == 9) & (dow == 0) & (nth == 1))
        | ((m == 11) & (dow == 3) & (nth == 4)) | observed(12, 25) | F.col("date").cast("string").isin(*ONE_OFF)
    )
    d = d.withColumn("is_session", (dow < 5) & ~holiday)
    early = ((m == 11) & (dow == 4) & F.col("dom").between(23, 29)) | ((m == 12) & (dom == 24)) | ((m == 7) & (dom == 3))
    d = d.withColumn("is_early_close", F.col("is_session") & early)
    n = F.when(F.col("is_session"), 1)
    run = lambda *by: F.count(n).over(Window.partitionBy(*by).orderBy("date"))
    order = Window.partitionBy(F.lit(1)).orderBy("date")  # the calendar's days, whatever the data's size
    day = F.when(F.col("is_session"), F.col("date"))
    return d.select(
        "date", F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"), F.date_format("date", "EEEE").alias("day_name"), F.col("m").alias("month"), F.quarter("date").alias("quarter"),
        F.col("y").alias("year"), (F.last_day("date") == F.col("date")).alias("is_month_end"), ((F.last_day("date") == F.col("date")) & (m % 3 == 0)).alias("is_quarter_end"),
        ((m == 12) & (dom == 31)).alias("is_year_end"), "is_session", "is_early_close", F.when(F.col("is_session"), run("y")).alias("session_of_year"),
        F.when(F.col("is_session"), run("y", "m")).alias("session_of_month"), F.last(day, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("prior_session"),
        F.first(day, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("next_session"),
    )


def with_splits(dim: DataFrame, splits: DataFrame) -> DataFrame:
    """The calendar with the symbols that split on each day."""
    per_day = splits.groupBy("date").agg(F.array_sort(F.collect_list("symbol")).alias("split_symbols"))
    return dim.join(per_day, "date", "left").withColumn("is_split_day", F.col("split_symbols").isNotNull())
