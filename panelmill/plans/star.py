"""Facts partitioned by month and joined to the calendar, so that a filter on the calendar decides what is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import scratch

MONTH = "fact_month"


def by_month(fact: DataFrame, date: str, name: str) -> DataFrame:
    """``fact`` written in partitions of its date's month, and read again with the month; rows without a date are a partition of their own."""
    path = scratch(fact.sparkSession, name)
    rows = fact.withColumn(MONTH, F.trunc(date, "month"))
    rows.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(path)
    return fact.sparkSession.read.schema(rows.schema).parquet(path)


def on_days(fact: DataFrame, days: DataFrame, date: str = "date") -> DataFrame:
    """A ``by_month`` fact on the days of a calendar. The join is by month as well, so the months of the days that a filter leaves
    are found first and no other partition is read. The calendar has a row per day and goes to every task."""
    days = days.withColumn(MONTH, F.trunc(date, "month"))
    return fact.join(F.broadcast(days), [MONTH, date]).drop(MONTH)
