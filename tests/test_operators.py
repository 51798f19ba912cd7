"""Operators on small frames, against pandas, loops and hand-computed values."""

import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelmill.functions import indicators as ind
from panelmill.functions.scalars import checked_expression, clean_double, mid_amount
from panelmill.operators.ema import emas
from panelmill.operators.joins import asof_left, on_latest, valid_at
from panelmill.operators.scd2 import scd2_apply, versions
from panelmill.operators.windows import average_rank, bucket, overlap_turnover, pct_rank, series, with_extremes
from panelmill.sources import landing, sinks

BARS = "symbol string, date date, open double, high double, low double, close double, volume long"


def prices(spark, closes, symbol="A", start=date(2020, 1, 1)):
    return spark.createDataFrame([(symbol, start + timedelta(i), c, c + 1, c - 1, c, 100 + i) for i, c in enumerate(closes)], BARS)


def walk(n, seed=1):
    return (100 + np.cumsum(np.random.default_rng(seed).normal(0, 1, n))).tolist()


@pytest.mark.parametrize("n", [1, 127, 128, 129, 1000])
def test_ema_equals_pandas(spark, n):
    x = walk(n)
    p = prices(spark, x).withColumn("lagged", F.lag("close").over(series()))
    got = emas(p, {"a": ("close", 2 / 10), "b": ("close", 2 / 201), "c": ("lagged", 1 / 14)}).orderBy("date").toPandas()
    s = pd.Series(x)
    for col, values, alpha in (("a", s, 2 / 10), ("b", s, 2 / 201), ("c", s.shift(), 1 / 14)):
        want = values.ewm(alpha=alpha, adjust=False).mean()
        assert np.allclose(got[col].astype(float), want, equal_nan=True, rtol=1e-9)


def test_ema_over_several_blocks(spark):
    """Blocks of 865 rows here; the slow mean hands on over many of them, and its seed comes late."""
    x = walk(6000)
    p = prices(spark, x, start=date(1950, 1, 1)).withColumn("late", F.when(F.col("close").isNotNull() & (F.col("date") > "1954-01-01"), F.col("close")))
    got = emas(p, {"fast": ("close", 0.5), "slow": ("close", 1 / 2000), "late_": ("late", 1 / 300)}).orderBy("date").toPandas()
    s = pd.Series(x)
    late = s.where(pd.date_range("1950-01-01", periods=6000) > "1954-01-01")
    for col, values, alpha in (("fast", s, 0.5), ("slow", s, 1 / 2000), ("late_", late, 1 / 300)):
        assert np.allclose(got[col].astype(float), values.ewm(alpha=alpha, adjust=False).mean(), equal_nan=True, rtol=1e-9), col


def test_extremes_equal_pandas(spark):
    x = walk(300, 5)
    p = prices(spark, x).withColumn("close", F.when(F.dayofmonth("date") != 9, F.col("close")))
    specs = {f"{f}_{n}": (f, c, n) for n in (1, 2, 3, 7, 8, 21, 64, 100) for f, c in (("max", "high"), ("min", "close"))}
    got = with_extremes(p, specs, series()).orderBy("date").toPandas()
    assert list(got.columns) == [*p.columns, *specs]
    for name, (f, c, n) in specs.items():
        rolled = got[c].astype(float).rolling(n)
        assert np.allclose(got[name].astype(float), rolled.max() if f == "max" else rolled.min(), equal_nan=True), name


def test_latest_row_has_all_keys(spark):
    row = ind.signal_row(prices(spark, walk(70, 4))).collect()[0]
    assert len(row) == 173 + 1 and row.ma_60 is not None and row.ma_100 is None and row.atr_60d is not None and row.atr_90d is None  # 173 and the date
    assert row.high_60d == pytest.approx(max(walk(70, 4)[-60:]) + 1) and row.change_2d_abs == pytest.approx(row.last_day_change_abs) and row.eps is None


def test_newest_dates_of_symbols(spark):
    days = [("A", date(2020, 1, 1)), ("A", date(2020, 1, 3)), ("B", date(2020, 1, 2)), ("C", date(2020, 1, 3)), ("C", date(2020, 1, 3))]
    got = on_latest(spark.createDataFrame(days, "symbol string, d date"), "d")
    assert sorted(r.symbol for r in got.collect()) == ["A", "C", "C"] and got.columns == ["symbol", "d"]


def test_indicators_equal_pandas(spark):
    x = walk(400, 2)
    out = ind.signal_series(prices(spark, x)).orderBy("as_of_date").toPandas()
    s = pd.Series(x)
    diff = s.diff()
    gain, loss = (v.iloc[1:].ewm(alpha=1 / 14, adjust=False).mean() for v in (diff.clip(lower=0), -diff.clip(upper=0)))
    rsi = (100 - 100 / (1 + gain / loss)).reindex(s.index)
    macd = s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()
    mid, dev = s.rolling(20).mean(), s.rolling(20).std()
    want = {
        "rsi": rsi, "macd": macd, "macd_signal_line": macd.ewm(span=9, adjust=False).mean(), "ma_200": s.rolling(200).mean(), "bollinger_upper": mid + 2 * dev,
        "bollinger_pct_b": (s - mid + 2 * dev) / (4 * dev), "change_365d_pct": s.pct_change(252) * 100, "obv": (np.sign(diff) * (100 + np.arange(400))).cumsum(),
    }
    assert len(out) == 200
    for col, values in want.items():
        assert np.allclose(out[col].astype(float), values.iloc[200:], equal_nan=True), col


def test_short_and_flat_series(spark):
    assert ind.signal_series(prices(spark, walk(150))).count() == 0
    flat = ind.with_volume(ind.with_recursive(prices(spark, [5.0] * 40))).orderBy("date").toPandas()
    assert flat["rsi"].iloc[-1] == 0 and flat["mfi"].iloc[-1] == 0 and pd.isna(flat["rsi"].iloc[0])


def test_adjustment(spark):
    p = prices(spark, [100.0, 50.0]).withColumn("dividend", F.lit(0.0)).withColumn("split_ratio", F.when(F.col("date") == "2020-01-02", 2.0).otherwise(0.0))
    assert [r.adj_close for r in ind.adjusted(p).orderBy("date").collect()] == pytest.approx([50, 50])
    p = prices(spark, [100.0, 99.0, 50.0])
    p = p.withColumn("dividend", F.when(F.col("date") == "2020-01-02", 1.0).otherwise(0.0)).withColumn("split_ratio", F.when(F.col("date") == "2020-01-03", 2.0))
    assert [r.adj_factor for r in ind.adjusted(p).orderBy("date").collect()] == pytest.approx([0.99 / 2, 0.5, 1.0])
    first = prices(spark, [100.0, 100.0]).withColumn("dividend", F.when(F.col("date") == "2020-01-01", 5.0)).withColumn("split_ratio", F.lit(None).cast("double"))
    assert [r.adj_factor for r in ind.adjusted(first).orderBy("date").collect()] == [1.0, 1.0]


def test_drawdown_and_beta(spark):
    assert ind.max_drawdown(prices(spark, [10.0, 20.0, 5.0, 8.0])).first().max_drawdown == pytest.approx(-0.75)
    b = walk(60, 3)
    both = prices(spark, b, "B").unionByName(prices(spark, b, "A"))
    assert {r.symbol: round(r.beta, 9) for r in ind.beta(both, "B").collect()} == {"A": 1.0, "B": 1.0}
    assert ind.beta(prices(spark, b[:10], "B"), "B").first().beta is None


def test_asof_equals_loop(spark):
    r = random.Random(4)
    left = [(i, r.choice(["a", "b", None]), r.choice([None, *range(50)])) for i in range(300)]
    right = [(k, t, r.choice([None, float(t)])) for k in "abc" for t in r.sample(range(50), 12)] + [("a", None, 1.0)]
    got = asof_left(spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, u int, v double"), ["k"], "t", "u")
    want = {}
    for i, k, t in left:
        found = [x for x in right if x[0] == k and t is not None and x[1] is not None and x[1] <= t] if k else []
        want[i] = max(found, key=lambda x: x[1])[1:] if found else (None, None)
    assert {x.id: (x.u, x.v) for x in got.collect()} == want


def test_scd2(spark):
    history = spark.createDataFrame([("x", "a", 1), ("x", "a", 2), ("x", "b", 3), ("y", None, 1)], "k string, v string, ts int")
    v = versions(history, "k", ["v"], "ts")
    assert sorted((r.k, r.v, r.effective_from, r.effective_to, r.is_current) for r in v.collect()) == [("x", "a", 1, 3, False), ("x", "b", 3, None, True), ("y", None, 1, None, True)]
    updates = spark.createDataFrame([("x", "b", 5), ("y", "c", 5), ("z", "d", 5)], "k string, v string, ts int")
    out = scd2_apply(v, updates, "k", ["v"], "ts")
    got = sorted((r.k, r.v or "", r.effective_from, r.effective_to or 0, r.is_current) for r in out.collect())
    assert got == [("x", "a", 1, 3, False), ("x", "b", 3, 0, True), ("y", "", 1, 5, False), ("y", "c", 5, 0, True), ("z", "d", 5, 0, True)]
    again = scd2_apply(out, updates, "k", ["v"], "ts")
    assert again.count() == out.count()


def test_valid_from_the_next_day(spark):
    v = spark.createDataFrame([("x", "old", "2020-01-01 22:00:00", "2020-01-05 22:00:00"), ("x", "new", "2020-01-05 22:00:00", None)], "k string, v string, effective_from string, effective_to string")
    v = v.withColumns({c: F.col(c).cast("timestamp") for c in ("effective_from", "effective_to")})
    f = spark.createDataFrame([("x", date(2020, 1, d)) for d in (1, 2, 5, 6)], "k string, date date")
    assert [r.v for r in valid_at(f, v, "k", "date").orderBy("date").collect()] == [None, "old", "old", "new"]


def test_ranks(spark):
    df = spark.createDataFrame([("d", x) for x in (1.0, 2.0, 2.0, 5.0, None)], "d string, x double")
    got = df.select("x", pct_rank(F.col("x"), ["d"]).alias("up"), pct_rank(F.col("x"), ["d"], False).alias("down"), average_rank(F.col("x"), ["d"]).alias("avg")).collect()
    by = {r.x: r for r in got}
    assert by[5.0].up == 1.0 and by[1.0].up == 0.0 and by[1.0].down == 1.0 and by[None].up is None and by[2.0].avg == 3.5
    seven = spark.range(7).withColumn("d", F.lit("d")).withColumn("b", bucket([F.col("id")], ["d"]))
    assert max(r.b for r in seven.collect()) == 9


def test_turnover(spark):
    rows = [(1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "x")]
    got = overlap_turnover(spark.createDataFrame(rows, "as_of_date int, symbol string"))
    assert {r.as_of_date: r.turnover for r in got.collect()} == {2: 0.5, 3: 1.0}


def test_landing(spark):
    t = spark.createDataFrame([("1.5",), ("inf",), ("None",), ("nan",), (None,)], "x string")
    assert [r.y for r in t.select(clean_double(F.col("x")).alias("y")).collect()] == [1.5, None, None, None, None]
    a = spark.createDataFrame([(500.0,), (1000.0,), (2e6,)], "x double").select(mid_amount(F.col("x")).alias("y"))
    assert [r.y for r in a.collect()] == [500.0, 8000.0, 1_000_000.0]
    for name, e in (("Bad", "x"), ("ok", "x; drop"), ("ok", "x -- y"), ("ok", "/* */ x")):
        with pytest.raises(ValueError, match="bad"):
            checked_expression(name, e)
    wide = "symbol string, name string, test_issue string, etf string"
    one = spark.createDataFrame([("AAA", "Alpha", "N", "N"), ("BBB", "Beta Warrants", "N", "N"), ("TOOLONG", "x", "N", "N"), ("TST", "t", "Y", "N"), ("FND", "f", "N", "Y")], wide)
    two = spark.createDataFrame([("AAA", "Other", "N", "N"), ("CCC", "Gamma", "N", "N")], wide)
    assert {(r.symbol, r.name) for r in landing.clean_listings([one, two]).collect()} == {("AAA", "Alpha"), ("CCC", "Gamma")}


def test_journal(spark):
    schema = "date string, symbol string, account string, side string, qty double, price double, seed boolean"
    good = spark.createDataFrame([("2020-01-01", "A", "x", "buy", 1.0, None, False)], schema)
    assert landing.checked_journal(good).count() == 1
    bad = spark.createDataFrame([(None, " ", "x", "gift", -1.0, 0.0, False), ("2020-01-01", "A", "x", "sell", 1.0, None, True)], schema)
    defects = [r.defects for r in landing.journal_defects(bad).collect()]
    assert defects == [["no date", "no symbol", "bad side", "bad quantity", "bad price"], ["seed is a sale", "seed without price"]]
    with pytest.raises(PySparkException, match="journal"):
        landing.checked_journal(bad).collect()


def test_sinks(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    a = spark.createDataFrame([("k", 1), ("l", 2)], "k string, v int")
    sinks.write_append(a, path)
    up = spark.createDataFrame([("l", 3, "n"), ("m", 4, "n")], "k string, v int, extra string")
    got = sorted((r.k, r.v, r.extra) for r in sinks.upsert(spark.read.parquet(path), up, ["k"]).collect())
    assert got == [("k", 1, None), ("l", 3, "n"), ("m", 4, "n")] and sinks.evolve(a, up) == ["extra"]
    shape = f"file://{tmp_path}/shape"
    sinks.write_shape(spark, a.schema, shape)
    sinks.write_append(a, shape)
    sinks.write_shape(spark, a.schema, shape)
    assert spark.read.parquet(shape).count() == 2


def test_latest_of_empty(spark):
    assert on_latest(spark.createDataFrame([], "d date, x int"), "d").count() == 0
