"""Queries over fundamentals, scores and serving tables, and the documented analyst views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import indicators as ind
from ..operators.joins import on_latest
from ..plans import fundamentals as fun
from ..plans import gold, scoring
from ..sources import sinks
from ..sources.tables import QQQ, SPY, Tables
from .prices import r4
from .sqltext import BARS, RAW, SIGNALS, rounded


def signals(t: Tables) -> DataFrame:
    return fun.with_fundamentals(ind.signal_series(t.prices), known(t))


def known(t: Tables) -> DataFrame:
    """Fundamentals with stand-ins: dividends are 30% of the earnings, and the usual yield is the return on equity."""
    out = fun.metrics(fun.concepts(t.facts()))
    rate = F.try_divide("net_income", "shares_outstanding") * 0.3
    return out.withColumn("dividend_rate", rate).withColumn("five_year_avg_yield", F.col("roe"))


def pit_01_concepts(spark, d):
    return fun.concepts(Tables(spark, d).facts())


def pit_02_metrics(spark, d):
    keep = ["symbol", "filed", "period_end", "shares_date", "net_income", "revenues", "cost_of_revenue", "assets", "equity", "shares_outstanding"]
    return r4(known(Tables(spark, d)), keep, "gross_profit, roe, gross_profitability")


def ind_18_fundamental_signals(spark, d):
    return r4(signals(Tables(spark, d)), ["symbol", "as_of_date", "dividend_yield_trap"], "eps, pe_ratio, dividend_yield, dividend_yield_gap")


def rank_07_candidates(spark, d):
    t = Tables(spark, d)
    c = candidates(t)
    c = c.withColumns({f"{x}_pct": scoring.pct_rank(F.col(x), ["as_of_date"]) for x in ("earnings_yield", "gross_profitability", "roe")})
    return r4(c, ["symbol", "as_of_date", "filed"], "earnings_yield, gross_profitability, roe, earnings_yield_pct, gross_profitability_pct, roe_pct", 6)


def candidates(t: Tables) -> DataFrame:
    bars = t.prices
    ends = scoring.month_ends(bars.select(F.col("date").alias("as_of_date")))
    dates = bars.select("symbol", F.col("date").alias("as_of_date")).join(ends, "as_of_date")
    return fun.candidates(dates, t.raw_prices(), known(t), t.securities())


def rank_08_round_scores(spark, d):
    t = Tables(spark, d)
    out = scoring.round_scores(candidates(t), [SPY, QQQ], t.securities(), fun.NON_OPERATING_SIC)
    return r4(out, ["symbol", "as_of_date", "rank"], "score, score_percentile", 6)


#: A scoring methodology as data: expression, higher is better, weight.
VARIANT = {
    "momentum": ("(1 + change_365d_pct / 100) / (1 + change_30d_pct / 100) - 1", True, 2.0),
    "cheap": ("pe_ratio", False, 1.0),
    "calm": ("atr_14d / last_closing_price", False, 1.0),
}


def rank_04_variant_scores(spark, d):
    s = signals(Tables(spark, d))
    s = s.join(scoring.month_ends(s.select("as_of_date")), "as_of_date")
    return r4(scoring.variant_scores(s, VARIANT), ["symbol", "as_of_date"], "momentum_pct, cheap_pct, calm_pct, score", 6)


def rank_09_dollar_volume(spark, d):
    return r4(scoring.dollar_volume_rank(Tables(spark, d).bars(), 10), ["symbol", "rank"], "dollar_volume", 2)


def rank_10_membership(spark, d):
    t = Tables(spark, d)
    top = scoring.dollar_volume_rank(t.prices, 10)
    return scoring.membership_events(scoring.members_at(membership(t)).filter("tier = 'broad'").select("symbol"), top)


def membership(t: Tables) -> DataFrame:
    """Enter events of every brand whose number is even, exit events of those whose number divides by 6."""
    s = t.securities().select("symbol", F.regexp_extract("symbol", r"(\d+)", 1).cast("int").alias("n"))
    enter = s.filter("n % 2 = 0").select("symbol", F.lit("broad").alias("tier"), F.lit("enter").alias("action"), F.lit("2000-01-01").cast("timestamp").alias("event_ts"))
    leave = s.filter("n % 6 = 0").select("symbol", F.lit("broad").alias("tier"), F.lit("exit").alias("action"), F.lit("2001-01-01").cast("timestamp").alias("event_ts"))
    return enter.unionByName(leave)


def rank_11_line_of_sight(spark, d):
    t = Tables(spark, d)
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    tags = t.securities().select("symbol", (n % 2 == 0).alias("is_watchlist"), (n % 5 == 0).alias("is_held"), (n % 3 == 0).alias("is_top_n"))
    out = scoring.line_of_sight(t.prices, tags, (1.0, 1.0, 0.5, 0.0, 0.9))
    return r4(out, ["symbol", "as_of_date", "deteriorating", "is_watchlist", "is_held", "is_top_n", "emerging"], "close, mom_12_1, mom_pct, ret_3m, ret_6m, ret_12m, dollar_volume_63d, dv_acceleration, dv_accel_pct")


def gld_01_watchlist(spark, d):
    return r4(gold.watchlist(signals(Tables(spark, d))), ["symbol", "as_of_date", "trade_signal", "composite_rank"], "rsi, mfi, pe_ratio, momentum_pct, value_pct, risk_pct, quality_pct, composite_score")


def gld_04_alerts(spark, d):
    return r4(gold.alerts(signals(Tables(spark, d))), ["symbol", "as_of_date", "alert_type"], "alert_value")


def gld_05_crossovers_history(spark, d):
    out = gold.alerts(signals(Tables(spark, d)), latest_only=False).filter("alert_type = 'MACD_CROSSOVER'")
    return r4(out, ["symbol", "as_of_date", "alert_type"], "alert_value")


def gld_09_signal_history(spark, d):
    return r4(signals(Tables(spark, d)), ["symbol", "as_of_date", "trade_signal"], "rsi, macd, macd_signal_line, macd_histogram, pe_ratio, eps")


def gld_10_benchmark_compare(spark, d):
    out = gold.benchmark_compare(signals(Tables(spark, d)), SPY, QQQ)
    return r4(out, ["symbol", "as_of_date"], ", ".join(c for c in out.columns if c not in ("symbol", "as_of_date")))


def gld_11_candidates(spark, d):
    return r4(gold.portfolio_candidates(signals(Tables(spark, d))), ["symbol", "as_of_date", "candidate_bucket"], "last_closing_price, rsi, pe_ratio, dividend_yield, change_30d_pct")


def ind_18_quoted_forward(spark, d):
    """Expected earnings and ratios as known on each date; stand-ins: a tenth more than the last net income by shares, 20 times it for some."""
    t = Tables(spark, d)
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    earned = F.try_divide("net_income", "shares_outstanding")
    quoted = known(t).withColumn("forward_eps", F.when(n % 3 != 0, earned * 1.1).otherwise(F.lit(float("inf")))).withColumn("forward_pe", F.when(n % 2 == 0, F.lit("20").cast("double")))
    out = fun.with_fundamentals(t.prices.select("symbol", F.col("date").alias("as_of_date"), F.col("close").alias("last_closing_price")), quoted)
    return r4(out, ["symbol", "as_of_date"], "eps, forward_eps, forward_pe", 6)


def tk_04_presented(spark, d):
    """Alerts and candidates as they are presented, in order of two keys, each with its place in what was written."""
    s = signals(Tables(spark, d))
    tables = {"alerts": (gold.alerts(s), ("symbol", "alert_type")), "candidates": (gold.portfolio_candidates(s), ("candidate_bucket", "symbol"))}
    out = None
    for name, (rows, keys) in tables.items():
        path = sinks.scratch(spark, name)
        sinks.write_sorted(rows, path, *(F.col(k).asc_nulls_last() for k in keys))
        one = sinks.read_in_order(spark, path).select(F.lit(name).alias("presented"), "position", *(F.col(k).alias(f"key_{i}") for i, k in enumerate(keys, 1)))
        out = one if out is None else out.unionByName(one)
    return out


def tk_04_orders(spark, d):
    """All orders in order of priority, price (highest first, NULL last) and key."""
    o = Tables(spark, d).read("orders").select("o_orderkey", "o_orderpriority", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))
    path = sinks.scratch(spark, "orders")
    sinks.write_sorted(o, path, F.col("o_orderpriority"), F.col("price").desc_nulls_last(), F.col("o_orderkey"))
    return sinks.read_in_order(spark, path).select("position", "o_orderkey")


def gld_13_daily_analytics(spark, d):
    t = Tables(spark, d)
    out = gold.daily_analytics(signals(t), t.prices, t.securities())
    return r4(out, ["symbol", "as_of_date", "sector", "industry", "volume", "trade_signal"], "open, high, low, close, rsi, mfi, pe_ratio, momentum_pct, value_pct, risk_pct, quality_pct, composite_score")


def wide(t: Tables) -> DataFrame:
    return gold.daily_analytics(signals(t), t.prices, t.securities())


def _view(fn, keep: list[str], values: str = ""):
    """A query over the wide table."""

    def run(spark, d):
        out = fn(wide(Tables(spark, d)))
        return r4(out, keep, values) if values else out.select(*keep)

    return run


latest = lambda x: on_latest(x, "as_of_date")


def _crossed_today(x: DataFrame) -> DataFrame:
    w = Window.partitionBy("symbol").orderBy("as_of_date")
    x = x.withColumn("prev", F.lag("macd_histogram").over(w))
    return latest(x).filter("prev is not null and signum(prev) <> signum(macd_histogram)")


def _recent_rows(n: int):
    def rows(x: DataFrame) -> DataFrame:
        w = Window.partitionBy("symbol").orderBy(F.col("as_of_date").desc())
        return x.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)

    return rows


def _zones(x: DataFrame) -> DataFrame:
    zone = F.when(F.col("rsi") < 30, "oversold").when(F.col("rsi") > 70, "overbought").otherwise("neutral")
    return latest(x).withColumn("zone", zone).groupBy("zone").agg(F.count("*").alias("n"))


def _peers(x: DataFrame) -> DataFrame:
    one = latest(x)
    peers = one.groupBy("sector").agg(F.avg("rsi").alias("sector_rsi"), F.avg("change_30d_pct").alias("sector_change"))
    return one.join(peers, "sector")


def _top(n: int, by: str):
    return lambda x: latest(x).orderBy(F.col(by).desc_nulls_last(), "symbol").limit(n)


VIEWS = {
    "view_01_snapshot": _view(latest, ["symbol", "as_of_date", "trade_signal"], "close, rsi, composite_score"),
    "view_02_top_momentum": _view(_top(10, "change_30d_pct"), ["symbol"], "change_30d_pct"),
    "view_03_oversold_quality": _view(lambda x: latest(x).filter("rsi < 45 and pe_ratio < 60 and roe > 0.01"), ["symbol"], "rsi, pe_ratio, roe"),
    "view_04_value_dividend": _view(lambda x: latest(x).filter("pe_ratio between 0 and 30 and dividend_yield > 0.005 and not dividend_yield_trap"), ["symbol"], "pe_ratio, dividend_yield"),
    "view_05_sectors": _view(lambda x: latest(x).groupBy("sector").agg(F.count("*").alias("n"), F.avg("rsi").alias("avg_rsi"), F.avg("change_30d_pct").alias("avg_change")), ["sector", "n"], "avg_rsi, avg_change"),
    "view_06_narrowest": _view(lambda x: latest(x).orderBy("bollinger_bandwidth", "symbol").limit(15), ["symbol"], "bollinger_bandwidth"),
    "view_07_crossed_today": _view(_crossed_today, ["symbol"], "macd_histogram, prev"),
    "view_08_risk_return": _view(lambda x: latest(x).filter("change_365d_pct is not null and atr_14d is not null"), ["symbol"], "atr_14d, change_365d_pct"),
    "view_12_history": _view(_recent_rows(30), ["symbol", "as_of_date"], "rsi, macd_histogram"),
    "view_14_weekly": _view(
        lambda x: x.groupBy("sector", F.to_date(F.date_trunc("week", "as_of_date")).alias("week")).agg(F.avg("rsi").alias("avg_rsi"), F.avg("change_30d_pct").alias("avg_change")),
        ["sector", "week"], "avg_rsi, avg_change",
    ),
    "view_15_industries": _view(lambda x: latest(x).groupBy("sector", "industry").agg(F.avg("change_90d_pct").alias("momentum"), F.avg("pe_ratio").alias("pe")), ["sector", "industry"], "momentum, pe"),
    "view_20_latest": _view(lambda x: x.agg(F.max("as_of_date").alias("latest"), F.count("*").alias("n"), F.countDistinct("symbol").alias("symbols")), ["latest", "n", "symbols"]),
    "view_24_buys": _view(lambda x: latest(x).filter("trade_signal = 'Buy'"), ["symbol"], "composite_score"),
    "view_27_zones": _view(_zones, ["zone", "n"]),
    "view_28_peers": _view(_peers, ["symbol", "sector"], "rsi, sector_rsi, change_30d_pct, sector_change"),
}

QUERIES = {
    "pit_01_concepts": pit_01_concepts,
    "pit_02_metrics": pit_02_metrics,
    "ind_18_fundamental_signals": ind_18_fundamental_signals, "ind_18_quoted_forward": ind_18_quoted_forward, "tk_04_presented": tk_04_presented, "tk_04_orders": tk_04_orders,
    "rank_04_variant_scores": rank_04_variant_scores,
    "rank_07_candidates": rank_07_candidates,
    "rank_08_round_scores": rank_08_round_scores,
    "rank_09_dollar_volume": rank_09_dollar_volume,
    "rank_10_membership": rank_10_membership,
    "rank_11_line_of_sight": rank_11_line_of_sight,
    "gld_01_watchlist": gld_01_watchlist,
    "gld_04_alerts": gld_04_alerts,
    "gld_05_crossovers_history": gld_05_crossovers_history,
    "gld_09_signal_history": gld_09_signal_history,
    "gld_10_benchmark_compare": gld_10_benchmark_compare,
    "gld_11_candidates": gld_11_candidates,
    "gld_13_daily_analytics": gld_13_daily_analytics,
    **VIEWS,
}

# --- SQL ------------------------------------------------------------------------------------------------------------

FACTS = """fy AS (SELECT p_brand AS symbol, year(l_shipdate)::INT AS y, round(sum(l_extendedprice), 2) AS rev, round(sum(l_extendedprice * (1 - l_discount)), 4) AS cost,
  round(sum(l_extendedprice * l_discount), 4) AS ni, round(sum(l_quantity), 0) AS sh, round(sum(l_extendedprice) * 3, 2) AS ast, round(sum(l_extendedprice) * 2, 2) AS eq
  FROM lines GROUP BY ALL),
silver AS (
  SELECT symbol, 'revenues' AS concept, make_date(y, 1, 1) AS start_date, make_date(y, 12, 31) AS end_date, CASE WHEN y % 2 = 0 THEN round(rev * 0.98, 4) ELSE rev END AS value, make_date(y, 12, 31) + 45 AS filed, '10-K' AS form FROM fy
  UNION ALL SELECT symbol, 'revenues', make_date(y, 1, 1), make_date(y, 12, 31), round(rev * 1.01, 4), make_date(y, 12, 31) + 410, '10-K/A' FROM fy
  UNION ALL SELECT symbol, 'cost_of_revenue', make_date(y, 1, 1), make_date(y, 12, 31), cost, make_date(y, 12, 31) + 45, '10-K' FROM fy
  UNION ALL SELECT symbol, 'net_income', make_date(y, 1, 1), make_date(y, 12, 31), ni, make_date(y, 12, 31) + 45, '10-K' FROM fy
  UNION ALL SELECT symbol, 'shares_outstanding', NULL, make_date(y, 12, 31), sh, make_date(y, 12, 31) + 45, '10-K' FROM fy
  UNION ALL SELECT symbol, 'assets', NULL, make_date(y, 12, 31), ast, make_date(y, 12, 31) + 45, '10-K' FROM fy
  UNION ALL SELECT symbol, 'equity', NULL, make_date(y, 12, 31), eq, make_date(y, 12, 31) + 45, '10-K' FROM fy)"""
KNOWN = (
    FACTS
    + """,
ev AS (SELECT DISTINCT symbol, filed FROM silver),
kn AS (SELECT e.symbol, e.filed, f.concept, f.value, f.end_date FROM ev e JOIN silver f ON f.symbol = e.symbol AND f.filed <= e.filed
  QUALIFY row_number() OVER (PARTITION BY e.symbol, e.filed, f.concept ORDER BY f.end_date DESC, f.filed DESC) = 1),
pv AS (SELECT symbol, filed, max(value) FILTER (concept = 'net_income') AS net_income, max(end_date) FILTER (concept = 'net_income') AS period_end,
  max(value) FILTER (concept = 'revenues') AS revenues, max(value) FILTER (concept = 'cost_of_revenue') AS cost_of_revenue,
  max(value) FILTER (concept = 'assets') AS assets, max(value) FILTER (concept = 'equity') AS equity,
  max(value) FILTER (concept = 'shares_outstanding') AS shares_outstanding, max(end_date) FILTER (concept = 'shares_outstanding') AS shares_date FROM kn GROUP BY ALL),
known AS (SELECT *, revenues - cost_of_revenue AS gross_profit, net_income / nullif(equity, 0) AS roe, (revenues - cost_of_revenue) / nullif(assets, 0) AS gross_profitability FROM pv)"""
)
SEC = """sec AS (SELECT p_brand AS symbol, min(p_type) AS sector, max(p_type) AS industry, CASE WHEN sum(p_size) % 5 = 0 THEN '6221' ELSE '3571' END AS sic,
  CASE WHEN count(*) % 7 = 0 THEN 'ETF' ELSE 'EQUITY' END AS quote_type FROM part GROUP BY ALL)"""
SIG = (
    f"WITH RECURSIVE {SIGNALS}, {KNOWN}, {SEC}"
    + """,
sg0 AS (SELECT s.*, k.net_income, k.shares_outstanding, k.roe, k.net_income / nullif(k.shares_outstanding, 0) AS eps FROM signals s
  ASOF LEFT JOIN known k ON k.symbol = s.symbol AND k.filed <= s.as_of_date),
sg1 AS (SELECT *, last_closing_price / nullif(eps, 0) AS pe_ratio, eps * 0.3 / nullif(last_closing_price, 0) AS dividend_yield FROM sg0),
sig AS (SELECT *, dividend_yield - coalesce(nullif(roe, 0), dividend_yield) AS dividend_yield_gap,
  coalesce(dividend_yield - coalesce(nullif(roe, 0), dividend_yield) > 0.015, false) AS dividend_yield_trap FROM sg1),
lst AS (SELECT * FROM sig WHERE as_of_date = (SELECT max(as_of_date) FROM sig))"""
)
_PCT = """percent_rank() OVER (PARTITION BY as_of_date ORDER BY coalesce(change_30d_pct, 0)) AS momentum_pct,
  percent_rank() OVER (PARTITION BY as_of_date ORDER BY CASE WHEN pe_ratio > 0 THEN pe_ratio ELSE 999 END DESC) AS value_pct,
  percent_rank() OVER (PARTITION BY as_of_date ORDER BY coalesce(rsi, 50) DESC) AS risk_pct,
  percent_rank() OVER (PARTITION BY as_of_date ORDER BY coalesce(mfi, 50)) AS quality_pct"""
_COMP = "round(0.25 * momentum_pct + 0.25 * value_pct + 0.25 * risk_pct + 0.25 * quality_pct, 9)"
WIDE = (
    SIG
    + f""",
w0 AS (SELECT sig.*, b.open, b.high, b.low, b.close, b.volume, sec.sector, sec.industry, {_PCT} FROM sig
  LEFT JOIN bars b ON b.symbol = sig.symbol AND b.date = sig.as_of_date LEFT JOIN sec ON sec.symbol = sig.symbol),
wide AS (SELECT *, {_COMP} AS composite_score FROM w0), wl AS (SELECT * FROM wide WHERE as_of_date = (SELECT max(as_of_date) FROM wide))"""
)
CAND = f"""WITH {RAW}, {KNOWN}, {SEC},
ends AS (SELECT max(date) AS d FROM bars GROUP BY date_trunc('month', date)),
pr AS (SELECT symbol, date, close, exp(sum(ln(coalesce(nullif(split_ratio, 0), 1))) OVER (PARTITION BY symbol ORDER BY date)) AS cum FROM raw),
b0 AS (SELECT p.symbol, p.date AS as_of_date, p.close, p.cum, k.* EXCLUDE (symbol) FROM (SELECT * FROM pr WHERE date IN (SELECT d FROM ends)) p
  ASOF LEFT JOIN known k ON k.symbol = p.symbol AND k.filed <= p.date),
b1 AS (SELECT b0.*, p.cum AS at_shares FROM b0 ASOF LEFT JOIN pr p ON p.symbol = b0.symbol AND p.date <= b0.shares_date),
cand AS (SELECT b1.symbol, as_of_date, filed, gross_profitability, CASE WHEN revenues IS NOT NULL AND sic <> '6221' THEN roe END AS roe,
  CASE WHEN shares_outstanding > 0 AND close > 0 AND revenues IS NOT NULL AND sic <> '6221' AND shares_date >= as_of_date - 400
    THEN net_income / (close * shares_outstanding * cum / at_shares) END AS earnings_yield FROM b1 JOIN sec ON sec.symbol = b1.symbol)"""


def ranks(columns: str, table: str) -> str:
    """Percent ranks of rows that have the column."""
    return ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN percent_rank() OVER (PARTITION BY as_of_date, {c} IS NULL ORDER BY {c}) END AS {c}_pct" for c in columns.split(", ")
    ) + f" FROM {table}"


ALERT_SQL = """al AS (
  SELECT symbol, as_of_date, CASE WHEN rsi < 30 THEN 'RSI_OVERSOLD' ELSE 'RSI_OVERBOUGHT' END AS alert_type, rsi AS alert_value FROM lst WHERE rsi < 30 OR rsi > 70
  UNION ALL SELECT symbol, as_of_date, 'MACD_CROSSOVER', macd_histogram FROM (SELECT *, lag(macd_histogram) OVER (PARTITION BY symbol ORDER BY as_of_date) AS p FROM sig)
    WHERE p IS NOT NULL AND sign(macd_histogram) <> sign(p) AND {when}
  UNION ALL SELECT symbol, as_of_date, 'BOLLINGER_SQUEEZE', bollinger_bandwidth FROM (SELECT *, percent_rank() OVER (PARTITION BY symbol ORDER BY bollinger_bandwidth) AS q
    FROM sig WHERE as_of_date >= (SELECT max(as_of_date) FROM sig) - 126) WHERE q <= 0.1 AND as_of_date = (SELECT max(as_of_date) FROM sig)
  UNION ALL SELECT symbol, as_of_date, CASE WHEN last_closing_price > ma_200 THEN 'MA200_CROSS_ABOVE' ELSE 'MA200_CROSS_BELOW' END, last_closing_price
    FROM (SELECT *, lag(last_closing_price) OVER w AS pc, lag(ma_200) OVER w AS pm FROM sig WINDOW w AS (PARTITION BY symbol ORDER BY as_of_date))
    WHERE as_of_date = (SELECT max(as_of_date) FROM sig) AND ((last_closing_price > ma_200 AND pc <= pm) OR (last_closing_price < ma_200 AND pc >= pm))
  UNION ALL SELECT symbol, as_of_date, 'DIVIDEND_YIELD_TRAP', dividend_yield_gap FROM lst WHERE dividend_yield_trap)"""
_NOW = "as_of_date = (SELECT max(as_of_date) FROM sig)"

SQL = {
    "pit_01_concepts": f"WITH {BARS.split(',' + chr(10) + 'bars')[0]}, {FACTS} SELECT * FROM silver",
    "pit_02_metrics": f"""WITH {BARS.split(',' + chr(10) + 'bars')[0]}, {KNOWN} SELECT symbol, filed, period_end, shares_date, net_income, revenues, cost_of_revenue, assets, equity,
  shares_outstanding, {rounded("gross_profit, roe, gross_profitability")} FROM known""",
    "ind_18_quoted_forward": f"""WITH {RAW}, {KNOWN}, n AS (SELECT *, regexp_extract(symbol, '(\\d+)', 1)::INT AS n, net_income / nullif(shares_outstanding, 0) AS e FROM known)
  SELECT b.symbol, b.date AS as_of_date, round(e, 6) AS eps, round(CASE WHEN n % 3 <> 0 THEN e * 1.1 END, 6) AS forward_eps, CASE WHEN n % 2 = 0 THEN 20.0 END AS forward_pe
  FROM bars b ASOF LEFT JOIN n k ON k.symbol = b.symbol AND k.filed <= b.date""",
    "tk_04_orders": """SELECT row_number() OVER (ORDER BY o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END DESC NULLS LAST, o_orderkey) AS position, o_orderkey FROM orders""",
    "ind_18_fundamental_signals": f"{SIG} SELECT symbol, as_of_date, dividend_yield_trap, {rounded('eps, pe_ratio, dividend_yield, dividend_yield_gap')} FROM sig",
    "rank_04_variant_scores": f"""{SIG}, x AS (SELECT symbol, as_of_date, {", ".join(f"{e} AS {n}" for n, (e, _, _) in VARIANT.items())} FROM sig
  WHERE as_of_date IN (SELECT max(as_of_date) FROM sig GROUP BY date_trunc('month', as_of_date))),
  y AS (SELECT symbol, as_of_date, {", ".join(f"CASE WHEN {n} IS NOT NULL THEN percent_rank() OVER (PARTITION BY as_of_date, {n} IS NULL ORDER BY {n} {'ASC' if up else 'DESC'}) END AS {n}_pct" for n, (_, up, _) in VARIANT.items())} FROM x)
  SELECT symbol, as_of_date, {rounded("momentum_pct, cheap_pct, calm_pct", 6)},
  round(coalesce(momentum_pct, 0.5) * 0.5 + coalesce(cheap_pct, 0.5) * 0.25 + coalesce(calm_pct, 0.5) * 0.25, 6) AS score FROM y""",
    "rank_07_candidates": f"""{CAND} SELECT symbol, as_of_date, filed, {rounded("earnings_yield, gross_profitability, roe, earnings_yield_pct, gross_profitability_pct, roe_pct", 6)}
  FROM (SELECT *, {ranks("earnings_yield, gross_profitability, roe", "cand")})""",
    "rank_08_round_scores": f"""{CAND}, el AS (SELECT cand.* FROM cand JOIN sec USING (symbol) WHERE symbol NOT IN ('{SPY}', '{QQQ}') AND sic <> '6221' AND quote_type <> 'ETF'),
  p AS (SELECT *, {ranks("earnings_yield, gross_profitability, roe", "el")}),
  s AS (SELECT *, round((coalesce(earnings_yield_pct, 0.5) + coalesce(gross_profitability_pct, 0.5) + coalesce(roe_pct, 0.5)) / 3, 9) AS score FROM p)
  SELECT symbol, as_of_date, rank() OVER (PARTITION BY as_of_date ORDER BY score DESC) AS rank, round(score, 6) AS score,
  round(percent_rank() OVER (PARTITION BY as_of_date ORDER BY score), 6) AS score_percentile FROM s""",
    "rank_09_dollar_volume": f"""WITH {BARS}, r AS (SELECT symbol, close * volume AS dv FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 63),
  m AS (SELECT symbol, median(dv) AS dv FROM r GROUP BY symbol)
  SELECT symbol, rank() OVER (ORDER BY dv DESC) AS rank, round(dv, 2) AS dollar_volume FROM m ORDER BY rank LIMIT 10""",
    "rank_10_membership": f"""WITH {BARS}, r AS (SELECT symbol, close * volume AS dv FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 63),
  t AS (SELECT symbol, rank() OVER (ORDER BY median(dv) DESC) AS k FROM r GROUP BY symbol ORDER BY k LIMIT 10),
  m AS (SELECT DISTINCT p_brand AS symbol FROM part WHERE regexp_extract(p_brand, '(\\d+)', 1)::INT % 2 = 0 AND regexp_extract(p_brand, '(\\d+)', 1)::INT % 6 <> 0)
  SELECT symbol, 'enter' AS action, k::INT AS rank_at_event FROM t WHERE symbol NOT IN (SELECT symbol FROM m)
  UNION ALL SELECT symbol, 'exit', NULL FROM m WHERE symbol NOT IN (SELECT symbol FROM t)""",
    "rank_11_line_of_sight": f"""WITH {BARS}, o AS (SELECT *, close * volume AS dv, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM bars),
  s AS (SELECT symbol, max(date) FILTER (rn = 1) AS as_of_date, max(close) FILTER (rn = 1) AS close,
    max(close) FILTER (rn = 21) / nullif(max(close) FILTER (rn = 252), 0) - 1 AS mom_12_1, max(close) FILTER (rn = 1) / nullif(max(close) FILTER (rn = 63), 0) - 1 AS ret_3m,
    max(close) FILTER (rn = 1) / nullif(max(close) FILTER (rn = 126), 0) - 1 AS ret_6m, max(close) FILTER (rn = 1) / nullif(max(close) FILTER (rn = 252), 0) - 1 AS ret_12m,
    median(CASE WHEN rn <= 63 THEN dv END) AS dollar_volume_63d, median(CASE WHEN rn <= 21 THEN dv END) / nullif(median(CASE WHEN rn <= 252 THEN dv END), 0) AS dv_acceleration,
    regexp_extract(symbol, '(\\d+)', 1)::INT AS n FROM o GROUP BY symbol),
  k AS (SELECT *, percent_rank() OVER (ORDER BY mom_12_1 NULLS FIRST) AS mom_pct, percent_rank() OVER (ORDER BY dv_acceleration NULLS FIRST) AS dv_accel_pct,
    n % 2 = 0 AS is_watchlist, n % 5 = 0 AS is_held, n % 3 = 0 AS is_top_n, coalesce(ret_3m < 0 AND ret_6m < 0 AND ret_12m < 0, false) AS deteriorating FROM s)
  SELECT symbol, as_of_date, deteriorating, is_watchlist, is_held, is_top_n, coalesce(NOT is_top_n AND close >= 1 AND dollar_volume_63d >= 1 AND mom_pct >= 0.5
    AND mom_12_1 > 0 AND dv_accel_pct >= 0.5 AND dv_acceleration > 0.9, false) AS emerging, {rounded("close, mom_12_1, mom_pct, ret_3m, ret_6m, ret_12m, dollar_volume_63d, dv_acceleration, dv_accel_pct")} FROM k""",
    "gld_01_watchlist": f"""{SIG}, p AS (SELECT *, {_PCT} FROM lst), c AS (SELECT *, {_COMP} AS composite_score FROM p)
  SELECT symbol, as_of_date, trade_signal, rank() OVER (ORDER BY composite_score DESC) AS composite_rank,
  {rounded("rsi, mfi, pe_ratio, momentum_pct, value_pct, risk_pct, quality_pct, composite_score")} FROM c""",
    "gld_04_alerts": f"{SIG}, {ALERT_SQL.format(when=_NOW)} SELECT symbol, as_of_date, alert_type, round(alert_value, 4) AS alert_value FROM al",
    "gld_05_crossovers_history": f"{SIG}, {ALERT_SQL.format(when='true')} SELECT symbol, as_of_date, alert_type, round(alert_value, 4) AS alert_value FROM al WHERE alert_type = 'MACD_CROSSOVER'",
    "gld_09_signal_history": f"{SIG} SELECT symbol, as_of_date, trade_signal, {rounded('rsi, macd, macd_signal_line, macd_histogram, pe_ratio, eps')} FROM sig",
    "gld_10_benchmark_compare": f"""{SIG} SELECT symbol, as_of_date, {rounded("last_closing_price, change_30d_pct, change_90d_pct, change_365d_pct")},
  {", ".join(f"round(coalesce((SELECT change_{k}_pct FROM lst WHERE symbol = '{s}'), 0), 4) AS {n}_change_{k}" for n, s in (("spy", SPY), ("qqq", QQQ)) for k in ("30d", "90d", "365d"))}
  FROM lst WHERE symbol NOT IN ('{SPY}', '{QQQ}')""",
    "gld_11_candidates": f"""{SIG}, t AS (SELECT *, CASE WHEN change_30d_pct > 5 THEN 'top_momentum' WHEN rsi < 30 THEN 'oversold' WHEN pe_ratio < 15 AND dividend_yield > 0.02 THEN 'value_dividend'
  WHEN bollinger_bandwidth < (SELECT quantile_cont(bollinger_bandwidth, 0.25) FROM lst) THEN 'low_volatility' ELSE 'watch' END AS candidate_bucket FROM lst)
  SELECT symbol, as_of_date, candidate_bucket, {rounded("last_closing_price, rsi, pe_ratio, dividend_yield, change_30d_pct")} FROM t WHERE candidate_bucket <> 'watch'""",
    "gld_13_daily_analytics": f"""{WIDE} SELECT symbol, as_of_date, sector, industry, volume, trade_signal,
  {rounded("open, high, low, close, rsi, mfi, pe_ratio, momentum_pct, value_pct, risk_pct, quality_pct, composite_score")} FROM wide""",
    "view_01_snapshot": f"{WIDE} SELECT symbol, as_of_date, trade_signal, {rounded('close, rsi, composite_score')} FROM wl",
    "view_02_top_momentum": f"{WIDE} SELECT symbol, round(change_30d_pct, 4) AS change_30d_pct FROM wl ORDER BY wl.change_30d_pct DESC NULLS LAST, symbol LIMIT 10",
    "view_03_oversold_quality": f"{WIDE} SELECT symbol, {rounded('rsi, pe_ratio, roe')} FROM wl WHERE rsi < 45 AND pe_ratio < 60 AND roe > 0.01",
    "view_04_value_dividend": f"{WIDE} SELECT symbol, {rounded('pe_ratio, dividend_yield')} FROM wl WHERE pe_ratio BETWEEN 0 AND 30 AND dividend_yield > 0.005 AND NOT dividend_yield_trap",
    "view_05_sectors": f"{WIDE} SELECT sector, count(*) AS n, round(avg(rsi), 4) AS avg_rsi, round(avg(change_30d_pct), 4) AS avg_change FROM wl GROUP BY sector",
    "view_06_narrowest": f"{WIDE} SELECT symbol, round(bollinger_bandwidth, 4) AS bollinger_bandwidth FROM wl ORDER BY wl.bollinger_bandwidth NULLS FIRST, symbol LIMIT 15",
    "view_07_crossed_today": f"""{WIDE}, p AS (SELECT symbol, as_of_date, macd_histogram, lag(macd_histogram) OVER (PARTITION BY symbol ORDER BY as_of_date) AS prev FROM wide)
  SELECT symbol, {rounded("macd_histogram, prev")} FROM p WHERE as_of_date = (SELECT max(as_of_date) FROM wide) AND sign(p.prev) <> sign(p.macd_histogram)""",
    "view_08_risk_return": f"{WIDE} SELECT symbol, {rounded('atr_14d, change_365d_pct')} FROM wl WHERE wl.change_365d_pct IS NOT NULL AND wl.atr_14d IS NOT NULL",
    "view_12_history": f"{WIDE} SELECT symbol, as_of_date, {rounded('rsi, macd_histogram')} FROM wide QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY as_of_date DESC) <= 30",
    "view_14_weekly": f"""{WIDE} SELECT sector, date_trunc('week', as_of_date)::DATE AS week, round(avg(rsi), 4) AS avg_rsi, round(avg(change_30d_pct), 4) AS avg_change FROM wide GROUP BY ALL""",
    "view_15_industries": f"{WIDE} SELECT sector, industry, round(avg(change_90d_pct), 4) AS momentum, round(avg(pe_ratio), 4) AS pe FROM wl GROUP BY ALL",
    "view_20_latest": f"{WIDE} SELECT max(as_of_date) AS latest, count(*) AS n, count(DISTINCT symbol) AS symbols FROM wide",
    "view_24_buys": f"{WIDE} SELECT symbol, round(composite_score, 4) AS composite_score FROM wl WHERE trade_signal = 'Buy'",
    "view_27_zones": f"{WIDE} SELECT CASE WHEN rsi < 30 THEN 'oversold' WHEN rsi > 70 THEN 'overbought' ELSE 'neutral' END AS zone, count(*) AS n FROM wl GROUP BY ALL",
    "view_28_peers": f"""{WIDE}, p AS (SELECT sector, avg(rsi) AS sector_rsi, avg(change_30d_pct) AS sector_change FROM wl GROUP BY sector)
  SELECT symbol, sector, {rounded("rsi, sector_rsi, change_30d_pct, sector_change")} FROM wl JOIN p USING (sector)""",
}

SQL["tk_04_presented"] = f"""SELECT 'alerts' AS presented, row_number() OVER (ORDER BY symbol, alert_type) AS position, symbol AS key_1, alert_type AS key_2 FROM ({SQL["gld_04_alerts"]})
UNION ALL SELECT 'candidates', row_number() OVER (ORDER BY candidate_bucket, symbol), candidate_bucket, symbol FROM ({SQL["gld_11_candidates"]})"""
