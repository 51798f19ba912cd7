"""Streams in several batches: state that ends, late rows, restarts, idle keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from panelmill.sources import commits
from panelmill.streaming import streams

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, user_id long, ts timestamp, value double"


@pytest.fixture
def land(spark, tmp_path):
    """Land a file of events, by hour; later calls are later batches."""
    folder, seen = f"file://{tmp_path}/in", []

    def run(rows):
        events = [(len(seen) + i, u, START + timedelta(hours=h), float(v)) for i, (u, h, v) in enumerate(rows)]
        seen.extend(events)
        spark.createDataFrame(events, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    return run, lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder), seen


def test_bars_of_a_stream_let_their_state_go(spark, land, tmp_path):
    r = random.Random(1)
    land, stream, seen = land
    path, state = f"file://{tmp_path}/bars", f"file://{tmp_path}/state"
    bars = lambda: streams.ohlc(stream(), "user_id", "ts", "value")
    go = lambda: streams.run_keyed(bars(), path, ["user_id", "start"], F.date_format("start", "yyyy-MM"), state)
    reports = []
    for day in range(0, 30, 3):
        land([(u, 24 * day + r.randint(0, 71), r.random()) for u in range(5) for _ in range(20)])
        reports += go()  # a restart between all batches
    held = [x["state_rows"] for x in reports]
    assert max(held) <= 5 * 6 and sum(x["late"] for x in reports) == 0  # of 150 bars
    land([(1, 2, 99.0), (1, 24 * 29 + 23, 0.5)])  # one four weeks late, one in time
    reports += go()
    assert sum(x["late"] for x in reports) == 1
    rows = [e for e in seen if e[3] != 99.0]
    want = spark.createDataFrame(rows, SCHEMA).groupBy("user_id", F.date_trunc("day", "ts").alias("start")).agg(
        F.min_by("value", F.struct("ts", "event_id")).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", F.struct("ts", "event_id")).alias("close"), F.count("*").alias("n")
    )
    got = commits.read(spark, path)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_a_batch_that_is_put_again_changes_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/bars"
    rows = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 3.0)], "k string, day int, x double")
    for _ in range(2):
        commits.merge(rows, path, ["k", "day"], F.col("day"))
    assert commits.read(spark, path).count() == 2


def plain(rows, enter, leave, idle_hours=None):
    out, state = {}, {}
    for i, u, ts, v in sorted(rows, key=lambda x: (x[2], x[0])):
        inside, last = state.get(u, (False, ts))
        if idle_hours and ts - last > timedelta(hours=idle_hours):
            inside = False
        inside = True if v >= enter else False if v < leave else inside
        out[i], state[u] = inside, (inside, ts)
    return out


def test_hysteresis_goes_on_after_a_restart(spark, land, tmp_path):
    r = random.Random(2)
    land, stream, seen = land
    out, state = f"file://{tmp_path}/out", f"file://{tmp_path}/state"
    for batch in range(3):
        land([(r.randrange(6), 10 * batch + r.randint(0, 9), r.uniform(0, 100)) for _ in range(120)])
        got = streams.run(streams.in_position(stream(), "user_id", "ts", "value", 60.0, 20.0), "h", out, state)
    assert {x.event_id: x.inside for x in got.collect()} == plain(seen, 60.0, 20.0)


def test_idle_keys_expire(spark, land, tmp_path):
    land, stream, seen = land
    out, state = f"file://{tmp_path}/out", f"file://{tmp_path}/state"
    for rows in ([(1, 0, 90), (2, 0, 90)], [(2, 24 * 5, 50)], [(2, 24 * 12, 50)], [(1, 24 * 20, 50), (2, 24 * 20, 50)]):
        land(rows)
        got = streams.run(streams.in_position(stream(), "user_id", "ts", "value", 60.0, 20.0, "1 hour", idle_days=9), "h", out, state)
    inside = {x.event_id: x.inside for x in got.collect()}
    assert inside == plain(seen, 60.0, 20.0, 24 * 9) and inside[4] is False and inside[5] is True
