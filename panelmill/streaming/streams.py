"""Incremental forms of three batch operators, run to the end of what is there (``availableNow``)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..sources import commits
from ..sources.sinks import delete, scratch


def read_files(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream over the table ``name`` of a folder; times without a zone are taken in the session's."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return rows.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"})


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """State of queries that start here is kept in RocksDB: on disk, changes alone are checkpointed, and it has typed state and timers."""
    key, was = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, was) if was else spark.conf.unset(key)


def run(stream: DataFrame, name: str, out: str | None = None, state: str | None = None) -> DataFrame:
    """Process all there is and append it to ``out``; the sink's table. With the ``state`` of an earlier run it goes on from there."""
    spark = stream.sparkSession
    out, state = out or scratch(spark, name), state or scratch(spark, f"{name}-state")
    with rocks(spark):
        writer = stream.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", state)
        writer.format("parquet").option("path", out).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_keyed(stream: DataFrame, path: str, keys: Sequence[str], part: Column, state: str) -> list[dict]:
    """Process all there is into a table of commits: each batch's changed rows are merged by key. Returns a report per batch.

    A row that changed comes with its newest value, so merging a batch again after a failure changes nothing, and only the
    partitions that a batch touches are written. The reports have the rows held as state, those that came too late for it
    and were dropped, and the watermark.
    """

    def put(rows: DataFrame, batch: int) -> None:
        place = scratch(rows.sparkSession, "batch")  # a merge reads its rows twice, the state only once
        rows.write.parquet(place)
        commits.merge(rows.sparkSession.read.schema(rows.schema).parquet(place), path, keys, part)
        delete(rows.sparkSession, place)

    with rocks(stream.sparkSession):
        writer = stream.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", state)
        query = writer.foreachBatch(put).start()
        query.awaitTermination()
    reports = []
    for p in query.recentProgress:
        held = p["stateOperators"]
        reports.append({
            "batch": p["batchId"], "state_rows": sum(x["numRowsTotal"] for x in held), "late": sum(x["numRowsDroppedByWatermark"] for x in held),
            "watermark": p["eventTime"].get("watermark"),
        })
    return reports


def deduplicated(events: DataFrame, key: str, ts: str, late: str = "1 day") -> DataFrame:
    """Each key once, as long as its repeats come within ``late``."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def ohlc(events: DataFrame, by: str, ts: str, value: str, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """First, highest, lowest and last value and the count per window. A window's state goes once the watermark, ``late`` behind
    the newest event, has passed its end; events for it that come later are dropped (and counted by ``run_keyed``)."""
    place = F.struct(ts, "event_id")
    bars = events.withWatermark(ts, late).groupBy(by, F.window(ts, width)).agg(
        F.min_by(value, place).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, place).alias("close"), F.count("*").alias("n")
    )
    return bars.select(by, F.col("window.start").alias("start"), "open", "high", "low", "close", "n")


class _Hysteresis(StatefulProcessor):
    """Whether a key is in position, as typed state; a timer ends it when the key has been idle in event time."""

    def __init__(self, by: str, ts: str, value: str, enter: float, leave: float, idle_ms: int) -> None:
        self.by, self.ts, self.value, self.enter, self.leave, self.idle_ms = by, ts, value, enter, leave, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.inside = handle.getValueState("inside", "inside boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        frame = pd.concat(list(rows)).sort_values([self.ts, "event_id"])
        values, was = frame[self.value], bool(self.inside.get()[0]) if self.inside.exists() else False
        crossed = pd.Series(np.where(values >= self.enter, 1.0, np.where(values < self.leave, 0.0, np.nan)), index=frame.index)
        inside = crossed.ffill().fillna(float(was)) > 0
        self.inside.update((bool(inside.iloc[-1]),))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(frame[self.ts].max().timestamp() * 1000) + self.idle_ms)
        yield pd.DataFrame({self.by: key[0], "event_id": frame["event_id"], "inside": inside})

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.inside.clear()
        return iter(())

    def close(self) -> None:
        pass


def in_position(events: DataFrame, by: str, ts: str, value: str, enter: float, leave: float, late: str = "1 day", idle_days: int = 400) -> DataFrame:
    """Hysteresis over a stream: a key's state survives between batches and restarts, and goes after ``idle_days`` without an event.

    A task sorts what a key has in one batch, which the source's trigger limits bound; what came in batches before is the
    state. Events more than ``late`` behind the newest are dropped.
    """
    kind = dict(events.dtypes)[by]
    step = _Hysteresis(by, ts, value, enter, leave, idle_days * 86_400_000)
    rows = events.select(by, ts, "event_id", value).withWatermark(ts, late)
    return rows.groupBy(by).transformWithStateInPandas(step, f"{by} {kind}, event_id bigint, inside boolean", "append", "EventTime")
