"""Plans on fixtures with known answers."""

import random
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelmill.functions import indicators as ind
from panelmill.plans import backtest as bt
from panelmill.plans import calendar as cal
from panelmill.plans import calls as cl
from panelmill.plans import fundamentals as fun
from panelmill.plans import gold, quality, scoring, star
from panelmill.plans import holdings as hd
from panelmill.sources import commits, sinks

DAY = date(2025, 1, 6)


def test_directions(spark):
    rows = [("best", DAY, 10.0, 5.0, 20.0, 80.0), ("mid", DAY, 5.0, 20.0, 50.0, 50.0), ("worst", DAY, -5.0, 60.0, 80.0, 20.0), ("none", DAY, None, -8.0, None, None)]
    s = spark.createDataFrame(rows, "symbol string, as_of_date date, change_30d_pct double, pe_ratio double, rsi double, mfi double")
    got = {r.symbol: r for r in gold.watchlist(s).collect()}
    assert all(got["best"][c] == 1.0 for c in scoring.COMPONENTS) and got["best"].composite_rank == 1
    assert all(got["worst"][c] == 0.0 for c in ("momentum_pct", "risk_pct", "quality_pct"))
    assert got["none"].value_pct == 0.0  # a negative price/earnings ratio is never best


def test_variant_ranks_only_known(spark):
    s = spark.createDataFrame([("a", DAY, 1.0), ("b", DAY, 2.0), ("c", DAY, None)], "symbol string, as_of_date date, x double")
    got = {r.symbol: (r.x_pct, r.score) for r in scoring.variant_scores(s, {"x": ("x", True, 1.0)}).collect()}
    assert got == {"a": (0.0, 0.0), "b": (1.0, 1.0), "c": (None, 0.5)}


def test_alerts(spark):
    rows = []
    for i in range(5):
        d = DAY + timedelta(i)
        last = i == 4
        rows += [
            ("LOW", d, 25.0 if last else 50.0, 1.0, 100.0, 90.0, 0.5, False, 0.0),
            ("CROSS", d, 50.0, 1.0 if last else -1.0, 101.0 if last else 99.0, 100.0, 0.1 - i * 0.01, True, 0.03),
            ("HOT", d, 75.0, 1.0, 99.0 if last else 101.0, 100.0, 0.5 + i, False, 0.0),
        ]
    s = spark.createDataFrame(rows, "symbol string, as_of_date date, rsi double, macd_histogram double, last_closing_price double, ma_200 double, bollinger_bandwidth double, dividend_yield_trap boolean, dividend_yield_gap double")
    got = {(r.symbol, r.alert_type) for r in gold.alerts(s).collect()}
    assert got == {
        ("LOW", "RSI_OVERSOLD"), ("LOW", "BOLLINGER_SQUEEZE"), ("CROSS", "MACD_CROSSOVER"), ("CROSS", "BOLLINGER_SQUEEZE"), ("CROSS", "MA200_CROSS_ABOVE"),
        ("CROSS", "DIVIDEND_YIELD_TRAP"), ("HOT", "RSI_OVERBOUGHT"), ("HOT", "MA200_CROSS_BELOW"),
    }


FACT = "symbol string, taxonomy string, tag string, start_date date, end_date date, value double, fiscal_year int, fiscal_period string, form string, filed date"


def fact(tag, year, value, filed, form="10-K", flow=True, taxonomy="us-gaap"):
    return ("A", taxonomy, tag, date(year, 1, 1) if flow else None, date(year, 12, 31), value, year, "FY", form, filed)


def test_point_in_time(spark):
    rows = [
        fact("NetIncomeLoss", 2020, 50.0, date(2021, 2, 1)), fact("NetIncomeLoss", 2021, 100.0, date(2022, 2, 1)), fact("NetIncomeLoss", 2021, 90.0, date(2022, 8, 1), "10-K/A"),
        fact("NetIncomeLoss", 2020, 45.0, date(2022, 9, 1), "10-K/A"), fact("SalesRevenueNet", 2021, 500.0, date(2022, 2, 1)), fact("Revenues", 2021, 510.0, date(2022, 2, 1)),
        fact("SalesRevenueNet", 2020, 400.0, date(2021, 2, 1)), fact("CostOfRevenue", 2021, 310.0, date(2022, 2, 1)), fact("Assets", 2021, 1000.0, date(2022, 2, 1), flow=False),
        fact("StockholdersEquity", 2021, 0.0, date(2022, 2, 1), flow=False), fact("Revenues", 2022, 1.0, date(2023, 2, 1), "10-Q"),
    ]
    known = {r.filed: r for r in fun.metrics(fun.concepts(spark.createDataFrame(rows, FACT))).collect()}
    assert [known[d].net_income for d in sorted(known)] == [50.0, 100.0, 90.0, 90.0]
    assert known[date(2021, 2, 1)].revenues == 400.0 and known[date(2022, 2, 1)].revenues == 510.0
    assert known[date(2022, 2, 1)].gross_profitability == pytest.approx(0.2) and known[date(2022, 2, 1)].roe is None


def test_preferred_tags(spark):
    day, newer = date(2022, 2, 1), "RevenueFromContractWithCustomerExcludingAssessedTax"
    rows = [fact("Revenues", 2021, 510.0, day), fact(newer, 2021, 490.0, day), fact(newer, 2021, 1.0, day, taxonomy="ifrs-full"), fact("CostOfGoodsSold", 2021, 300.0, day)]
    rows += [fact("StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", 2021, 80.0, day, flow=False), fact("NetIncomeLoss", 2021, 20.0, day)]
    (known,) = fun.metrics(fun.concepts(spark.createDataFrame(rows, FACT))).collect()
    assert (known.revenues, known.cost_of_revenue, known.gross_profit, known.equity, known.roe) == (490.0, 300.0, 190.0, 80.0, 0.25)


def test_earnings_yield_on_split_shares(spark):
    rows = [fact("NetIncomeLoss", 2023, 1000.0, date(2024, 2, 1)), fact("Revenues", 2023, 9.0, date(2024, 2, 1)), fact("EntityCommonStockSharesOutstanding", 2023, 100.0, date(2024, 2, 1), flow=False, taxonomy="dei"), fact("EntityCommonStockSharesOutstanding", 2023, 7.0, date(2024, 2, 1), flow=False), fact("StockholdersEquity", 2023, 500.0, date(2024, 2, 1), flow=False)]
    known = fun.metrics(fun.concepts(spark.createDataFrame(rows, FACT)))
    p = spark.createDataFrame([("A", date(2023, 12, 29), 200.0, None), ("A", date(2024, 3, 1), 100.0, 2.0), ("A", date(2025, 6, 2), 100.0, None)], "symbol string, date date, close double, split_ratio double")
    dates = p.select("symbol", F.col("date").alias("as_of_date"))
    for sic, want in (("3571", [None, 1000 / 20000, None]), ("6221", [None, None, None])):
        got = fun.candidates(dates, p, known, spark.createDataFrame([("A", sic)], "symbol string, sic string")).orderBy("as_of_date").collect()
        assert [r.earnings_yield for r in got] == [None if w is None else pytest.approx(w) for w in want]
        assert [r.roe for r in got] == ([None, 2.0, 2.0] if sic == "3571" else [None] * 3)


def test_forward_returns(spark):
    opens = [100.0, 102.0, 99.0, 107.5, 103.25, 111.0]
    p = spark.createDataFrame([(s, DAY + timedelta(i), o) for s in ("A", "SPY") for i, o in enumerate(opens)], "symbol string, date date, adj_open double")
    got = bt.forward_returns(p, "SPY", [2]).filter("symbol = 'A'").orderBy("as_of_date").collect()
    assert len(got) == 3 and got[0].fwd_return == pytest.approx(107.5 / 102 - 1) and got[0].entry_date == DAY + timedelta(1)
    assert all(r.excess_return == 0 for r in got)
    zero = p.withColumn("adj_open", F.when(F.col("date") == DAY + timedelta(1), 0.0).otherwise(F.col("adj_open")))
    assert DAY not in {r.as_of_date for r in bt.forward_returns(zero, "SPY", [2]).collect()}


@pytest.mark.parametrize(("sign", "want"), [(1, 1.0), (-1, -1.0), (0, None)])
def test_information_coefficient(spark, sign, want):
    rows = [("v", 21, DAY + timedelta(30 * d), f"S{i:02}", float(sign * i), i / 100, (i - 10) / 100) for d in range(3) for i in range(20)]
    f = spark.createDataFrame(rows, "variant string, horizon int, as_of_date date, symbol string, signal double, fwd_return double, excess_return double")
    ics = [r.ic for r in bt.ic_by_date(f).collect()]
    assert ics == ([] if want is None else [pytest.approx(want)] * 3)
    if want == 1.0:
        m = bt.evaluate(f, 0.0).first()
        assert m.monotonicity == pytest.approx(1.0) and m.hit_rate == 1.0 and m.turnover == 0.0 and m.excess_gross == pytest.approx(0.185 - 0.095)


def test_hysteresis_equals_loop(spark):
    r = random.Random(1)
    rows = [(f"S{s}", d, r.choice([0.5, 0.9, 0.49, 0.89, r.random()])) for s in range(20) for d in range(60) if r.random() < 0.8]
    df = spark.createDataFrame(rows, "symbol string, as_of_date int, score_percentile double")
    want, state = {}, {}
    for s, d, p in sorted(rows):
        was = state.get(s, False)
        now = True if p >= 0.9 else False if p < 0.5 else was
        want[s, d] = {(False, True): "buy", (True, True): "hold", (True, False): "sell", (False, False): "none"}[was, now]
        state[s] = now
    calls = cl.hysteresis(df)
    assert {(x.symbol, x.as_of_date): x.call for x in calls.collect()} == want
    step = cl.next_round(calls.filter("as_of_date < 59").select("symbol", "as_of_date", "call"), df.filter("as_of_date = 59"))
    assert {x.symbol: x.call for x in step.collect()} == {s: c for (s, d), c in want.items() if d == 59}


def test_settlement(spark):
    calls = spark.createDataFrame([(f"S{i}", DAY, i / 9, i / 9) for i in range(10)], "symbol string, as_of_date date, score double, score_percentile double")
    rows = [(f"S{i}", DAY, 21, i / 100, i / 100) for i in range(10)] + [("SPY", DAY, 21, 0.0, 0.0), ("SPY", DAY, 63, 0.0, 0.0)]
    r = spark.createDataFrame(rows, "symbol string, as_of_date date, horizon int, fwd_return double, excess_return double")
    expected = spark.createDataFrame([(21, 0.05, -0.1), (63, 0.0, 0.0)], "horizon int, mean double, p10 double")
    got = cl.settle(calls, expected, r, "SPY", bps=0.0).collect()
    assert len(got) == 1 and got[0].realized_excess_net == pytest.approx(0.045) and got[0].realized_ic == pytest.approx(1.0) and got[0].below_mean and not got[0].below_p10 and got[0].n_missing == 0
    with pytest.raises(PySparkException, match="no expectation"):
        cl.settle(calls, expected.filter("horizon = 21"), r, "SPY").collect()


def test_trailing(spark):
    rows = [(21, d, f) for d, f in enumerate([True, False, True, True])] + [(63, 0, True), (63, 1, False)]
    got = cl.trailing_runs(spark.createDataFrame(rows, "horizon int, as_of_date int, below boolean"), ["below"])
    assert {r.horizon: r.trailing_below for r in got.collect()} == {21: 2, 63: 0}


JOURNAL = "account string, symbol string, date date, side string, qty double, price double, id int, seed boolean"


def test_lots_equal_loop(spark):
    r, rows, want, k = random.Random(2), [], {}, 0
    for s in range(40):
        lots = []
        for d in range(30):
            k += 1
            have = sum(q for _, q in lots)
            if have > 0 and r.random() < 0.4:
                q = float(r.randint(1, int(have)))
                rows.append(("x", f"S{s}", DAY + timedelta(d), "sell", q, None, k, False))
                while q > 0:
                    i, have_ = lots[0]
                    take = min(q, have_)
                    q -= take
                    lots[0] = (i, have_ - take)
                    if lots[0][1] == 0:
                        lots.pop(0)
            else:
                q = float(r.randint(1, 9))
                lots.append((k, q))
                rows.append(("x", f"S{s}", DAY + timedelta(d), "buy", q, 1.0, k, False))
        want |= dict(lots)
    assert {x.id: x.open for x in hd.open_lots(spark.createDataFrame(rows, JOURNAL)).collect()} == want
    over = spark.createDataFrame([("x", "A", DAY, "buy", 1.0, 1.0, 1, False), ("x", "A", DAY + timedelta(1), "sell", 2.0, 1.0, 2, False)], JOURNAL)
    with pytest.raises(PySparkException, match="sells more"):
        hd.open_lots(over).collect()


def test_losses(spark):
    rows = [("tax", "A", date(2024, 1, 2), "buy", 2.0, None, 1, False), ("IRA one", "A", date(2024, 1, 2), "buy", 2.0, 90.0, 2, False), ("tax", "A", date(2025, 5, 20), "buy", 1.0, 50.0, 3, False)]
    p = spark.createDataFrame([("A", date(2024, 1, 1), 80.0), ("A", date(2025, 6, 1), 60.0)], "symbol string, date date, close double")
    got = hd.loss_harvest(spark.createDataFrame(rows, JOURNAL), p, scoring.latest_price(p, p), "2025-06-01").collect()
    assert [(r.account, r.basis, r.long_term, r.wash_sale) for r in got] == [("tax", 80.0, True, True)] and got[0].loss_pct == pytest.approx(-0.25)


def test_freshness_boundary(spark):
    for n, status in ((50, "warn"), (49, "error")):
        expected = spark.range(n).select(F.col("id").cast("string").alias("symbol"), F.lit(False).alias("critical"))
        latest = expected.filter("symbol <> '0'").select("symbol", F.lit("2025-01-06").cast("date").alias("last_date"))
        got = {r.symbol: r.status for r in quality.freshness(latest, expected, F.lit("2025-01-06").cast("date")).collect()}
        assert got.pop("0") == status and set(got.values()) == {"ok"}


def test_completed_session(spark):
    t = spark.createDataFrame([("2025-01-06 21:29:00",), ("2025-01-06 21:30:00",), ("2025-07-07 20:30:00",)], "t string")
    got = [str(r.s) for r in t.select(quality.completed_session(F.col("t").cast("timestamp")).alias("s")).collect()]
    assert got == ["2025-01-05", "2025-01-06", "2025-07-07"]


def test_calendar(spark):
    c = {str(r.date): r for r in cal.calendar(spark, "2021-01-01", "2025-12-31").collect()}
    closed = ["2024-01-01", "2024-01-15", "2024-03-29", "2024-06-19", "2024-07-04", "2024-11-28", "2024-12-25", "2021-12-24", "2021-07-05", "2025-01-09", "2025-04-18"]
    assert not any(c[d].is_session for d in closed) and c["2021-12-31"].is_session and c["2021-06-18"].is_session
    assert c["2024-11-29"].is_early_close and c["2024-07-03"].is_early_close and c["2024-12-24"].is_early_close and not c["2024-12-26"].is_early_close
    assert c["2024-12-31"].session_of_year == 252 and str(c["2024-03-30"].prior_session) == "2024-03-28" and str(c["2024-03-29"].next_session) == "2024-04-01"


def test_universe(spark):
    top = spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, rank int")
    events = spark.createDataFrame([("t", "B", "enter", 1), ("t", "C", "enter", 1), ("t", "D", "enter", 1), ("t", "D", "exit", 2)], "tier string, symbol string, action string, event_ts int")
    members = scoring.members_at(events)
    assert {r.symbol for r in members.collect()} == {"B", "C"} and {r.symbol for r in scoring.members_at(events, F.lit(1)).collect()} == {"B", "C", "D"}
    assert {(r.symbol, r.action) for r in scoring.membership_events(members, top).collect()} == {("A", "enter"), ("C", "exit")}


def test_entry(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and "composite_rank" in out.columns


def test_entry_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, check=True, timeout=120)


def test_quoted_fundamentals_come_first(spark):
    """Each case: the quoted columns, then yield, gap, trap, earnings and ratio at a price of 50, 4 earned on 2 shares, 8 of equity."""
    nan = float("nan")
    cases = {
        "all": ((5.0, 11.0, 0.06, 1.0, 0.03), (0.06, 0.03, True, 5.0, 11.0)),
        "rate": ((None, None, None, 2.0, 0.01), (0.04, 0.03, True, 2.0, 25.0)),
        "zero": ((None, nan, 0.06, 1.0, 0.0), (0.06, 0.04, True, 2.0, 25.0)),
        "usual": ((nan, None, 0.06, 1.0, nan), (0.06, 0.04, True, 2.0, 25.0)),
        "low": ((None, None, 0.03, None, 0.02), (0.03, 0.01, False, 2.0, 25.0)),
        "none": ((None,) * 5, (0.0, None, False, 2.0, 25.0)),
        "stays": ((None, None, 0.02, None, 0.0), (0.02, 0.02, True, 2.0, 25.0)),
    }
    base = "symbol string, filed date, net_income double, shares_outstanding double, roe double, gross_profitability double, revenues double, shares_date date"
    schema = base + "".join(f", {c} double" for c in fun.QUOTED)
    known = spark.createDataFrame([(k, DAY, 4.0, 2.0, 0.5, 0.1, 9.0, DAY, *q) for k, (q, _) in cases.items()], schema)
    seen = spark.createDataFrame([(k, DAY, 50.0) for k in [*cases, "unknown"]], "symbol string, as_of_date date, last_closing_price double")
    got = {r.symbol: r for r in fun.with_fundamentals(seen, known).collect()}
    for k, (_, (paid, gap, trap, eps, pe)) in cases.items():
        r = got[k]
        assert (r.dividend_yield, r.eps, r.pe_ratio, r.dividend_yield_trap) == (pytest.approx(paid), eps, pe, trap), k
        assert r.dividend_yield_gap == (None if gap is None else pytest.approx(gap)), k
    assert (got["unknown"].dividend_yield, got["unknown"].dividend_yield_trap) == (None, False)
    plain = fun.with_fundamentals(seen, known.drop(*fun.QUOTED)).filter("symbol = 'all'").first()
    assert (plain.eps, plain.dividend_yield, plain.dividend_yield_gap, plain.dividend_yield_trap) == (2.0, 0.0, None, False)


def test_gate_and_snapshot(spark, tmp_path):
    best = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "symbol string, composite_rank int")
    best = best.select("symbol", F.lit("2024-01-05").cast("date").alias("as_of_date"), "composite_rank", *(F.lit(0.5).alias(c) for c in gold.SNAPSHOT if c not in ("symbol", "as_of_date", "composite_rank")))
    latest = spark.createDataFrame([("A", date(2024, 1, 5)), ("B", date(2024, 1, 4)), ("C", date(2024, 1, 5))], "symbol string, last_date date")
    everyone = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "symbol string")
    session = F.lit("2024-01-05").cast("date")
    status = lambda **k: {r.symbol: r.status for r in gold.gate(latest, everyone, best, session, **k).collect()}
    assert status(depth=2, most=1.0) == {"A": "ok", "B": "error", "C": "ok", "D": "warn"}
    assert status(depth=1, most=1.0) == {"A": "ok", "B": "warn", "C": "ok", "D": "warn"}
    assert status(depth=1, most=0.02)["D"] == "error"
    fine, bad = (gold.gate(latest, everyone, best, session, depth=k, most=1.0) for k in (1, 2))
    first = gold.snapshot(best, fine, "v1", "run-1")
    path = f"file://{tmp_path}/recommendations"
    assert commits.first_write(first, path) == ["2024-01-05|v1"] and commits.first_write(gold.snapshot(best, fine, "v1", "run-2"), path) == []
    assert commits.first_write(gold.snapshot(best, fine, "v2", "run-2"), path) == ["2024-01-05|v2"]
    assert {(r._run_id, r["count"]) for r in commits.read(spark, path).groupBy("_run_id").count().collect()} == {("run-1", 3), ("run-2", 3)}
    with pytest.raises(PySparkException):
        gold.snapshot(best, bad, "v1", "run-1").collect()


def test_frozen_expectation(spark):
    dist = spark.createDataFrame([("m", h, 0.1 * h, -0.2, 0.4, 9) for h in (21, 63, 126)], "variant string, horizon int, mean double, p10 double, p90 double, n_dates long")
    ics = spark.createDataFrame([("m", h, date(y, 3, 1), 0.1 * (y - 2019)) for h in (21, 63, 126) for y in (2020, 2021)], "variant string, horizon int, as_of_date date, ic double")
    got = {r.horizon: r for r in cl.freeze(dist, ics, "the definition", 0.5).collect()}
    assert got[21].mean == pytest.approx(1.05) and got[21].p10 == -0.1 and got[63].ic_mean == pytest.approx(0.15) and got[63].ic_by_year == "2020:0.100000,2021:0.200000"
    assert len({(r.source_sha256, r.definition_hash) for r in got.values()}) == 1 and len(got[21].source_sha256) == 64
    with pytest.raises(PySparkException):
        cl.freeze(dist.filter("horizon <> 63"), ics, "the definition", 0.5).collect()


def test_drift(spark):
    rows = [(date(2024, m, 28), 21, m > 3, m > 5) for m in range(1, 8)] + [(date(2024, 7, 28), 63, False, False)]
    settled = spark.createDataFrame(rows, "as_of_date date, horizon int, below_mean boolean, below_p10 boolean")
    ics = [(date(2024, m, 28), 21, "steady", 0.2 + 0.01 * m) for m in range(1, 8)] + [(date(2024, m, 28), 21, "noise", (-1.0) ** m) for m in range(1, 8)]
    ics += [(date(2024, m, 28), 21, "flat", 0.1) for m in range(1, 8)] + [(date(2024, 1, 28), 63, "noise", 5.0), (date(2030, 1, 28), 21, "noise", 5.0)]
    got = {r.signal: r for r in cl.drift(settled, spark.createDataFrame(ics, "as_of_date date, horizon int, component string, ic double"), mean_rounds=4, p10_rounds=3).collect()}
    assert (got["below_mean"].n, got["below_mean"].action) == (4, "review") and (got["below_p10"].n, got["below_p10"].action) == (2, None)
    assert got["noise"].n == 7 and got["noise"].action == "demotion_review" and got["steady"].action is None and got["steady"].t > 5 and got["flat"].t is None


def test_due_dates(spark):
    days = spark.createDataFrame([(date(2024, 5, 31),), (date(2024, 6, 14),), (date(2024, 6, 28),)], "date date")
    due = lambda *a: cl.due_date(days, *a).first().due
    assert due("2024-06-20") == date(2024, 5, 31) and due("2024-06-30") == date(2024, 6, 28) and due("2024-06-30", "2024-07") is None and due("2024-05-02") is None
    events = spark.createDataFrame([("authorize_off_cycle", "2024-06-28"), ("other", "2024-06-14")], "action string, vintage string")
    assert cl.off_cycle_date(days, events).first().due == date(2024, 6, 28)
    assert cl.off_cycle_date(days, events.filter("action = 'other'")).first().due is None and cl.off_cycle_date(days, events, "2024-07").first().due is None


def test_tax_free_accounts(spark):
    """Losses of accounts whose names hold a marker deduct nothing, whatever the name's form."""
    names = ["broker", "Roth", "my IRA", "401(k)", "401-k", "HSA x"]
    rows = [(n, "A", date(2024, 1, 2), "buy", 1.0, 10.0, False, k) for k, n in enumerate(names)]
    trades = spark.createDataFrame(rows, "account string, symbol string, date date, side string, qty double, price double, seed boolean, id int")
    p = spark.createDataFrame([("A", date(2024, 1, 2), 10.0), ("A", date(2024, 3, 1), 5.0)], "symbol string, date date, close double")
    assert [r.account for r in hd.loss_harvest(trades, p, scoring.latest_price(p, p), "2024-06-01").collect()] == ["broker"]


def test_a_filter_on_the_calendar_prunes_the_facts(spark):
    days = [(date(2020, 1, 1) + timedelta(days=i), float(i)) for i in range(366)] + [(None, -1.0)]
    fact = star.by_month(spark.createDataFrame(days, "date date, x double"), "date", "fact")
    assert fact.count() == 367 and len(fact.inputFiles()) >= 13
    one = cal.calendar(spark, "2020-01-01", "2020-12-31").filter("quarter = 2").select("date", "is_session")
    got = star.on_days(fact, one)
    assert got.columns == ["date", "x", "is_session"] and got.agg(F.sum("x")).first()[0] == sum(x for d, x in days if d and 4 <= d.month <= 6)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    rows = got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 91 and "dynamicpruning" in plan
    scans = [n for n in scan_nodes(got._jdf.queryExecution().executedPlan()) if n.metrics().contains("numPartitions")]
    assert [n.metrics().apply("numPartitions").value() for n in scans] == [3]  # of 13


def scan_nodes(plan):
    if plan.nodeName() == "AdaptiveSparkPlan":
        return scan_nodes(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return scan_nodes(plan.plan())
    own = [plan] if plan.nodeName().startswith("Scan parquet") else []
    return own + [n for i in range(plan.children().size()) for n in scan_nodes(plan.children().apply(i))]


def test_checks_are_counted_where_rows_are_written(spark, tmp_path):
    rows = [("A", date(2020, 1, 1), 1.0, 2.0, 0.5, 1.0, 10), ("A", date(2020, 1, 2), 1.0, 2.0, 0.5, 3.0, -1), ("A", date(2020, 1, 2), 1.0, 0.4, 0.5, None, 1)]
    p = spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume long")
    path = f"file://{tmp_path}/prices"
    want = {r.check: r.failures for r in quality.price_checks(p, ["symbol", "date"]).collect()}
    assert quality.land_checked(p, path, ["symbol", "date"], F.year("date")) == want and want["duplicate_keys"] == 1 and want["close_outside"] == 1
    assert commits.versions(spark, path) == []
    good = p.limit(1)
    assert not any(quality.land_checked(good, path, ["symbol", "date"], F.year("date")).values())
    assert commits.read(spark, path).columns == p.columns and commits.read(spark, path).count() == 1
    assert quality.land_checked(p.limit(0), path, ["symbol", "date"], F.year("date"))["empty"] == 1 and commits.read(spark, path).count() == 1


def test_indicators_read_clustered_bars_without_a_shuffle(spark):
    rows = [(f"S{k}", date(2020, 1, 1) + timedelta(days=i), *(100.0 + i + k,) * 4, 10) for k in range(5) for i in range(260)]
    p = spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume long")
    stored = sinks.clustered(p, "bars", "symbol", "date")
    got = ind.signal_series(stored)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, got.collect())) == sorted(map(str, ind.signal_series(p).select(got.columns).collect()))
