"""Smaller reports over the same frames: analyst views, coverage, expectations, gates, shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import indicators as ind
from ..functions.scalars import net_return
from ..operators.joins import on_latest
from ..plans import backtest as bt
from ..plans import calls as cl
from ..plans import gold, quality, scoring
from ..plans import holdings as hd
from ..sources import commits, landing, sinks
from ..sources.tables import QQQ, SPY, Tables
from .evaluation import CL, FR, FRCL, HAIRCUT, HL, TR, calls, frame, held, positions, returns
from .gold import _COMP, _PCT, ALERT_SQL, SEC, SIG, WIDE, signals, wide
from .gold import SQL as GOLD_SQL
from .prices import r4
from .sqltext import BARS, RAW, rounded

_NOW = "as_of_date = (SELECT max(as_of_date) FROM sig)"
_ALERTS = f"{WIDE}, {ALERT_SQL.format(when=_NOW)}"


def view_09_active_alerts(spark, d):
    return gold.alerts(signals(Tables(spark, d))).groupBy("alert_type").agg(F.count("*").alias("n"), F.countDistinct("symbol").alias("symbols"))


def view_10_alerts_joined(spark, d):
    t = Tables(spark, d)
    w = wide(t)
    a = gold.alerts(w.drop("sector", "industry"))
    return r4(a.join(w.select("symbol", "as_of_date", "sector", "close", "pe_ratio"), ["symbol", "as_of_date"]), ["symbol", "alert_type", "sector"], "close, pe_ratio, alert_value")


def view_11_traps(spark, d):
    out = on_latest(signals(Tables(spark, d)), "as_of_date").filter("dividend_yield_gap is not null")
    return r4(out, ["symbol", "dividend_yield_trap"], "dividend_yield, dividend_yield_gap", 6)


def view_13_versus_benchmarks(spark, d):
    c = gold.benchmark_compare(signals(Tables(spark, d)), SPY, QQQ)
    c = c.withColumn("vs_spy", F.col("change_90d_pct") - F.col("spy_change_90d")).withColumn("vs_qqq", F.col("change_90d_pct") - F.col("qqq_change_90d"))
    return r4(c, ["symbol"], "vs_spy, vs_qqq")


def view_16_three_facts(spark, d):
    """Prices, signals and fundamentals of a symbol's year, drilled across."""
    t = Tables(spark, d)
    by = ["symbol", "year"]
    p = t.prices.groupBy("symbol", F.year("date").alias("year")).agg(F.avg("close").alias("close"), F.sum("volume").alias("volume"))
    s = signals(t).groupBy("symbol", F.year("as_of_date").alias("year")).agg(F.avg("rsi").alias("rsi"))
    f = t.facts().filter("taxonomy = 'us-gaap' and tag = 'Assets'").select("symbol", F.col("fiscal_year").alias("year"), F.col("value").alias("assets"))
    return r4(p.join(s, by, "left").join(f, by, "left"), [*by, "volume", "assets"], "close, rsi")


def view_17_buckets(spark, d):
    return gold.portfolio_candidates(signals(Tables(spark, d))).groupBy("candidate_bucket").agg(F.count("*").alias("n"), F.round(F.avg("rsi"), 4).alias("avg_rsi"))


def view_18_runs(spark, d):
    return Tables(spark, d).landed_prices().groupBy("_run_id").agg(F.count("*").alias("n"), F.to_date(F.min("_ingest_ts")).alias("first"), F.min("date").alias("from_date"), F.max("date").alias("to_date"))


def view_19_duplicates(spark, d):
    return Tables(spark, d).landed_prices().groupBy("symbol", "date").agg(F.count("*").alias("n")).filter("n > 1")


def view_21_coverage(spark, d):
    w = on_latest(wide(Tables(spark, d)), "as_of_date")
    return w.groupBy("sector").agg(F.countDistinct("symbol").alias("symbols"), F.count("pe_ratio").alias("with_pe"), F.round(F.avg("pe_ratio"), 4).alias("avg_pe"), F.round(F.avg("composite_score"), 4).alias("avg_score"))


def view_22_heat_map(spark, d):
    t = Tables(spark, d)
    r = gold.watchlist(signals(t)).join(t.securities().select("symbol", "sector", "industry"), "symbol")
    return r.groupBy("sector", "industry").agg(F.count("*").alias("n"), F.min("composite_rank").alias("best_rank"), F.round(F.avg("composite_score"), 4).alias("avg_score"))


def view_23_rank_and_risk(spark, d):
    return r4(gold.watchlist(signals(Tables(spark, d))), ["symbol", "composite_rank"], "risk_pct, atr_14d, bollinger_bandwidth")


def trade_log(t: Tables) -> DataFrame:
    """Priced buys in the shape of the manual log."""
    b = t.trades().filter("side = 'buy' and price is not null")
    dec = lambda c, p, s: c.cast(T.DecimalType(p, s))
    return b.select(
        F.col("date").alias("trade_date"), "symbol", F.lit("BUY").alias("action"), dec(F.col("qty"), 12, 4).alias("shares"), dec(F.col("price"), 12, 4).alias("price"),
        dec(F.col("qty") * F.col("price"), 14, 2).alias("total_cost"), F.col("id.l_orderkey").alias("order_id"),
    )


def gld_12_trade_log(spark, d):
    """The log's empty shape, created once, then filled."""
    log = trade_log(Tables(spark, d))
    path = sinks.scratch(spark, "trade_log")
    sinks.write_shape(spark, log.schema, path)
    sinks.write_append(log, path)
    out = spark.read.parquet(path)
    return out.groupBy("symbol").agg(F.count("*").alias("n"), F.sum("shares").cast("double").alias("shares"), F.round(F.sum("total_cost").cast("double"), 0).alias("total_cost"))


def view_25_unrealised(spark, d):
    t = Tables(spark, d)
    last = t.prices.groupBy("symbol").agg(F.max_by("close", "date").alias("last"))
    b = t.trades().filter("side = 'buy' and price is not null").join(last, "symbol", "left")
    return b.groupBy("symbol").agg(F.round(F.sum(F.col("qty") * (F.col("last") - F.col("price"))), 2).alias("pnl"), F.count("*").alias("n"))


def view_29_disclosures(spark, d):
    """Disclosures by segment beside the mean balance of its customers."""
    t = Tables(spark, d)
    per = t.disclosures().groupBy("symbol").agg(F.count("*").alias("n"), F.max("transaction_date").alias("last"))
    rank = t.read("customer").groupBy(F.col("c_mktsegment").alias("symbol")).agg(F.round(F.avg("c_acctbal"), 4).alias("avg_balance"))
    return per.join(rank, "symbol")


def call_07_coverage(spark, d):
    """Symbols with a session at the round's date, and at the last one."""
    b = Tables(spark, d).bars()
    per = b.groupBy("date").agg(F.countDistinct("symbol").alias("symbols"))
    total = b.agg(F.countDistinct("symbol").alias("total"))
    return per.crossJoin(F.broadcast(total)).select("date", "symbols", F.round(F.col("symbols") / F.col("total"), 6).alias("share"), (F.col("symbols") / F.col("total") < 0.98).alias("warn"))


def set_01_expectation(spark, d):
    """The walk-forward distribution, cut, as what rounds are graded against."""
    dist = bt.distribution(bt.top_excess(frame(Tables(spark, d)), 10.0)).filter("variant = 'momentum'")
    return dist.select("horizon", *(F.round(F.col(c) * HAIRCUT, 6).alias(c) for c in ("mean", "p10", "p90")))


def bt_06_hit_rate(spark, d):
    top = bt.with_deciles(frame(Tables(spark, d))).filter("decile = 9")
    return top.groupBy("variant", "horizon").agg(F.round(F.avg((F.col("excess_return") > 0).cast("double")), 6).alias("hit_rate"))


def bt_09_costs(spark, d):
    r = returns(Tables(spark, d)).filter("horizon = 21")
    return r.groupBy("symbol").agg(*(F.round(F.avg(net_return(F.col("fwd_return"), b)), 6).alias(f"net_{b}") for b in (0, 5, 10)))


def rank_05_latest_scored(spark, d):
    """The latest date's composite of the scored tier alone."""
    s = on_latest(signals(Tables(spark, d)), "as_of_date")
    tier = {"mom": ("change_90d_pct", True, 1.0), "value": ("pe_ratio", False, 1.0)}
    out = scoring.variant_scores(s, tier)
    return r4(out.withColumn("rank", F.rank().over(Window.partitionBy("as_of_date").orderBy(F.col("score").desc()))), ["symbol", "rank"], "score", 6)


def hld_04_latest_price(spark, d):
    b = Tables(spark, d).bars()
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    out = scoring.latest_price(b.filter(n % 2 == 0), b.withColumn("close", F.col("close") * 2))
    return r4(out, ["symbol"], "close")


def hld_06_held_freshness(spark, d):
    t = Tables(spark, d)
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    latest = t.prices.filter((n != 3) | (F.col("date") < "2000-01-01")).groupBy("symbol").agg(F.max("date").alias("last_date"))
    expected = positions(t).select("symbol").distinct().withColumn("critical", F.lit(True))
    return quality.freshness(latest, expected, F.lit("2001-09-01").cast("date")).select("symbol", "stale", "status")


def hld_08_decisions(spark, d):
    return held(Tables(spark, d)).groupBy(F.coalesce("call", F.lit("unscored")).alias("call")).agg(F.count("*").alias("n"), F.count_if("deteriorating").alias("falling"))


def ag_15_net_shares(spark, d):
    return hd.net_shares(Tables(spark, d).trades())


def ag_16_average_basis(spark, d):
    lots = hd.open_lots(Tables(spark, d).trades()).filter("price is not null")
    return lots.groupBy("symbol").agg(F.round(F.sum(F.col("open") * F.col("price")) / F.sum("open"), 4).alias("basis"), F.sum("open").alias("qty"))


def qa_02_last_session(spark, d):
    return quality.last_session(Tables(spark, d).bars().select("date"), F.lit("2000-07-04").cast("date"))


def qa_08_backwards(spark, d):
    """Sessions whose date is before that of the line that came before, in the order of order keys."""
    li = Tables(spark, d).lines().groupBy(F.col("p_brand").alias("symbol"), "l_orderkey").agg(F.to_date(F.min("l_shipdate")).alias("date"))
    w = Window.partitionBy("symbol").orderBy("l_orderkey")
    return li.withColumn("was", F.lag("date").over(w)).groupBy("symbol").agg(F.count_if(F.col("date") < F.col("was")).alias("backwards"))


def qa_11_mostly_null(spark, d):
    o = Tables(spark, d).read("orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")).alias("pending"))
    return quality.null_shares(o, 0.5).withColumn("null_share", F.round("null_share", 6))


def src_07_splits(spark, d):
    p = Tables(spark, d).raw_prices().filter("split_ratio > 0").select("symbol", F.col("date").alias("split_date"), "split_ratio")
    out = landing.with_provenance(p, "run-1", "files", F.col("split_date"), F.lit("2024-01-01").cast("timestamp"))
    return out.select("symbol", "split_date", "split_ratio", "_run_id", F.to_date("_source_event_ts").alias("event_date"))


def src_10_cutoff(spark, d):
    """Bars up to the session that was complete at a time."""
    now = F.lit("2000-03-15 20:00:00").cast("timestamp")
    return Tables(spark, d).bars().filter(F.col("date") <= quality.completed_session(now)).groupBy("symbol").agg(F.max("date").alias("last"), F.count("*").alias("n"))


def src_11_resume(spark, d):
    """Symbols that a resumed refresh still has to fetch."""
    t = Tables(spark, d)
    fresh = t.prices.filter("date >= '2001-11-03'").select("symbol").distinct()
    return t.securities().select("symbol").join(fresh, "symbol", "left_anti")


def snk_08_evolve(spark, d):
    """An upsert that brings a column: old rows have it as NULL."""
    n = Tables(spark, d).read("nation")
    target, updates = n.select("n_nationkey", "n_name"), n.filter("n_nationkey % 5 = 0").withColumn("n_name", F.upper("n_name")).withColumn("seen", F.lit(1))
    return sinks.upsert(target, updates.select("n_nationkey", "n_name", "seen"), ["n_nationkey"])


def call_settled_rounds(spark, d):
    """How many rounds each rung has settled."""
    t = Tables(spark, d)
    closed = returns(t).filter(F.col("symbol") == SPY).select("as_of_date", "horizon")
    return cl.rounds(calls(t), "v2").join(closed, "as_of_date").groupBy("horizon").agg(F.count("*").alias("rounds"), F.sum(F.size("calls")).alias("calls"))


def _gate(t: Tables, s: DataFrame, best: DataFrame, most: float) -> DataFrame:
    """All brands against the newest session of the bars."""
    newest = t.prices.agg(F.max("date").alias("session"))
    latest = s.groupBy("symbol").agg(F.max("as_of_date").alias("last_date")).crossJoin(F.broadcast(newest))
    return gold.gate(latest, t.securities(), best, F.col("session"), most=most).drop("session")


def gld_02_gate(spark, d):
    t = Tables(spark, d)
    s = signals(t)
    return _gate(t, s, gold.watchlist(s), 0.02).select("symbol", "last_date", "critical", "stale", "status")


def gld_03_snapshot(spark, d):
    """A day recorded once: a second run of the version changes nothing, a new version stands beside it."""
    t = Tables(spark, d)
    s = signals(t)
    best = sinks.stored(gold.watchlist(s), "watchlist")
    gated = sinks.stored(_gate(t, s, best, 1.0), "gate")
    path = sinks.scratch(spark, "recommendations")
    for version, run, more in (("v1", "run-1", 0.0), ("v1", "run-2", 1.0), ("v2", "run-3", 0.5)):
        changed = best.withColumn("composite_score", F.col("composite_score") + more)
        commits.first_write(gold.snapshot(changed, gated, version, run), path)
    return r4(commits.read(spark, path), ["symbol", "as_of_date", "composite_rank", "trade_signal", "methodology_version", "_run_id"], "composite_score, last_closing_price")


def view_03_levels(spark, d):
    """Oversold with quality at the documented thresholds, two of return on equity, and at the looser ones of ``view_03_oversold_quality``."""
    x = on_latest(wide(Tables(spark, d)), "as_of_date")
    levels = {"strict": "rsi < 30 and pe_ratio < 25 and roe > 0.15", "documented": "rsi < 30 and pe_ratio < 25 and roe > 0.10", "loose": "rsi < 45 and pe_ratio < 60 and roe > 0.01", "widest": "rsi < 60 and pe_ratio > 0 and roe > 0"}
    return _at_levels(x, levels, "rsi, pe_ratio, roe")


def view_04_levels(spark, d):
    """Value with dividend safety at the two documented strictnesses, payout being dividends by earnings, and at that of ``view_04_value_dividend``."""
    x = on_latest(wide(Tables(spark, d)), "as_of_date").withColumn("payout", F.try_divide(F.col("dividend_yield") * F.col("close"), F.col("eps")))
    safe = "dividend_yield > 0.02 and not dividend_yield_trap"
    levels = {"strict": f"pe_ratio between 8 and 20 and {safe} and payout < 0.70 and roe > 0.12", "documented": f"pe_ratio between 8 and 18 and {safe} and payout < 0.75",
              "loose": "pe_ratio between 0 and 30 and dividend_yield > 0.005 and not dividend_yield_trap"}
    return _at_levels(x, levels, "pe_ratio, dividend_yield, payout")


def _at_levels(x: DataFrame, levels: dict[str, str], values: str) -> DataFrame:
    """Each row once for every level that it meets, in one pass."""
    met = F.array_compact(F.array(*(F.when(F.expr(c), F.lit(n)) for n, c in levels.items())))
    return r4(x.withColumn("level", F.explode(met)), ["symbol", "level"], values)


def view_08_beta(spark, d):
    """Risk and return with beta."""
    t = Tables(spark, d)
    x = on_latest(wide(t), "as_of_date").join(ind.beta(t.prices, SPY), "symbol", "left")
    return r4(x.filter("change_365d_pct is not null and atr_14d is not null"), ["symbol"], "beta, atr_14d, change_365d_pct")


def view_09_alert_rows(spark, d):
    """All active alerts."""
    return r4(gold.alerts(signals(Tables(spark, d))), ["symbol", "as_of_date", "alert_type"], "alert_value")


def view_12_spans(spark, d):
    """The last 90 rows of a symbol's indicators, each with the shortest of the spans 30, 60 and 90 that holds it."""
    w = Window.partitionBy("symbol").orderBy(F.col("as_of_date").desc())
    x = signals(Tables(spark, d)).withColumn("rn", F.row_number().over(w)).filter("rn <= 90")
    return r4(x.withColumn("span", F.ceil(F.col("rn") / 30).cast("int") * 30), ["symbol", "as_of_date", "span"], "rsi, macd_histogram, bollinger_bandwidth")


def view_14_recent(spark, d):
    """Weekly averages by sector over the last 90 days."""
    t = Tables(spark, d)
    newest = t.prices.agg(F.max("date").alias("_newest"))
    x = wide(t).join(F.broadcast(newest), F.col("as_of_date") >= F.date_sub("_newest", 90)).filter("sector is not null")
    x = x.groupBy("sector", F.to_date(F.date_trunc("week", "as_of_date")).alias("week")).agg(F.avg("rsi").alias("avg_rsi"), F.avg("change_30d_pct").alias("avg_change"))
    return r4(x, ["sector", "week"], "avg_rsi, avg_change")


def view_17_candidates(spark, d):
    """The candidates of every bucket, best momentum first within it."""
    x = gold.portfolio_candidates(signals(Tables(spark, d)))
    place = F.row_number().over(Window.partitionBy("candidate_bucket").orderBy(F.col("change_30d_pct").desc_nulls_last(), "symbol"))
    return r4(x.withColumn("place", place), ["symbol", "candidate_bucket", "place"], "rsi, pe_ratio, change_30d_pct")


def view_24_top(spark, d):
    """The ten best composites of the latest date."""
    return r4(gold.watchlist(signals(Tables(spark, d))).orderBy("composite_rank", "symbol").limit(10), ["symbol", "composite_rank", "trade_signal"], "composite_score")


def view_29_ranked(spark, d):
    """Transactions of each brand by kind beside its latest rank."""
    t = Tables(spark, d)
    per = t.lines().groupBy(F.col("p_brand").alias("symbol"), F.col("l_returnflag").alias("type")).agg(F.count("*").alias("n"), F.to_date(F.max("l_shipdate")).alias("last"))
    return r4(per.join(gold.watchlist(signals(t)).select("symbol", "composite_rank", "composite_score"), "symbol"), ["symbol", "type", "n", "last", "composite_rank"], "composite_score")


def hld_08_emerging(spark, d):
    """Names outside the top that are picking up, with their latest call."""
    t = Tables(spark, d)
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    tags = t.securities().select("symbol", (n % 2 == 0).alias("is_watchlist"), (n % 5 == 0).alias("is_held"), (n % 3 == 0).alias("is_top_n"))
    sight = scoring.line_of_sight(t.prices, tags, (1.0, 1.0, 0.5, 0.0, 0.9)).filter("emerging")
    newest = calls(t).groupBy("symbol").agg(F.max_by("call", "as_of_date").alias("call"))
    return r4(sight.join(newest, "symbol", "left"), ["symbol", "is_held", "call"], "mom_12_1, dv_acceleration")


QUERIES = {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__ and k[0] != "_" and k not in ("trade_log",)}

_SIGHT = GOLD_SQL["rank_11_line_of_sight"]
_PAYOUT = "dividend_yield * close / nullif(eps, 0)"


def _levels_sql(levels: dict[str, str], values: str) -> str:
    parts = " UNION ALL ".join(f"SELECT symbol, '{n}' AS level, {rounded(values)} FROM wp WHERE {c}" for n, c in levels.items())
    return f"{WIDE}, wp AS (SELECT *, {_PAYOUT} AS payout FROM wl) {parts.replace('SELECT symbol', 'SELECT wp.symbol')}"


_WATCH = "p AS (SELECT *, {pct} FROM lst), c AS (SELECT *, {comp} AS composite_score FROM p), k AS (SELECT *, rank() OVER (ORDER BY composite_score DESC) AS composite_rank FROM c)".format(pct=_PCT, comp=_COMP)

SQL = {
    "gld_02_gate": f"""{SIG}, {_WATCH}, g AS (SELECT sec.symbol, m AS last_date, coalesce(composite_rank <= 20, false) AS critical, coalesce(m < (SELECT max(date) FROM bars), true) AS stale FROM sec
    LEFT JOIN (SELECT symbol, max(as_of_date) AS m FROM sig GROUP BY symbol) USING (symbol) LEFT JOIN k USING (symbol))
  SELECT symbol, last_date, critical, stale, CASE WHEN NOT stale THEN 'ok' WHEN critical OR (SELECT avg(stale::INT) FROM g) > 0.02 THEN 'error' ELSE 'warn' END AS status FROM g""",
    "gld_03_snapshot": f"""{SIG}, {_WATCH} SELECT symbol, as_of_date, composite_rank, trade_signal, v AS methodology_version, r AS _run_id, round(composite_score + x, 4) AS composite_score, round(last_closing_price, 4) AS last_closing_price
  FROM k, (VALUES ('v1', 'run-1', 0.0), ('v2', 'run-3', 0.5)) t(v, r, x)""",
    "view_03_levels": _levels_sql({"strict": "wp.rsi < 30 AND wp.pe_ratio < 25 AND wp.roe > 0.15", "documented": "wp.rsi < 30 AND wp.pe_ratio < 25 AND wp.roe > 0.10", "loose": "wp.rsi < 45 AND wp.pe_ratio < 60 AND wp.roe > 0.01", "widest": "wp.rsi < 60 AND wp.pe_ratio > 0 AND wp.roe > 0"}, "rsi, pe_ratio, roe"),
    "view_04_levels": _levels_sql({"strict": "wp.pe_ratio BETWEEN 8 AND 20 AND wp.dividend_yield > 0.02 AND NOT dividend_yield_trap AND wp.payout < 0.70 AND roe > 0.12",
      "documented": "wp.pe_ratio BETWEEN 8 AND 18 AND wp.dividend_yield > 0.02 AND NOT dividend_yield_trap AND wp.payout < 0.75",
      "loose": "wp.pe_ratio BETWEEN 0 AND 30 AND wp.dividend_yield > 0.005 AND NOT dividend_yield_trap"}, "pe_ratio, dividend_yield, payout"),
    "view_08_beta": f"""{WIDE}, q AS (SELECT symbol, date, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS r FROM bars),
  x AS (SELECT q.symbol, q.date, q.r, b.r AS b FROM q JOIN q b ON b.symbol = '{SPY}' AND b.date = q.date WHERE q.r IS NOT NULL AND b.r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY q.symbol ORDER BY q.date DESC) <= 252),
  be AS (SELECT symbol, CASE WHEN count(*) >= 20 THEN covar_samp(r, b) / nullif(var_samp(b), 0) END AS beta FROM x GROUP BY symbol)
  SELECT symbol, round(be.beta, 4) AS beta, round(wl.atr_14d, 4) AS atr_14d, round(wl.change_365d_pct, 4) AS change_365d_pct FROM wl LEFT JOIN be USING (symbol) WHERE wl.change_365d_pct IS NOT NULL AND wl.atr_14d IS NOT NULL""",
    "view_09_alert_rows": f"{_ALERTS} SELECT symbol, as_of_date, alert_type, round(alert_value, 4) AS alert_value FROM al",
    "view_12_spans": f"""{SIG}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY as_of_date DESC) AS rn FROM sig)
  SELECT symbol, as_of_date, ceil(rn / 30)::INT * 30 AS span, {rounded("rsi, macd_histogram, bollinger_bandwidth")} FROM r WHERE rn <= 90""",
    "view_14_recent": f"""{WIDE} SELECT sector, date_trunc('week', as_of_date)::DATE AS week, round(avg(rsi), 4) AS avg_rsi, round(avg(change_30d_pct), 4) AS avg_change FROM wide
  WHERE sector IS NOT NULL AND as_of_date >= (SELECT max(date) FROM bars) - 90 GROUP BY ALL""",
    "view_17_candidates": f"""{SIG}, t AS (SELECT *, CASE WHEN change_30d_pct > 5 THEN 'top_momentum' WHEN rsi < 30 THEN 'oversold' WHEN pe_ratio < 15 AND dividend_yield > 0.02 THEN 'value_dividend'
  WHEN bollinger_bandwidth < (SELECT quantile_cont(bollinger_bandwidth, 0.25) FROM lst) THEN 'low_volatility' ELSE 'watch' END AS candidate_bucket FROM lst)
  SELECT symbol, candidate_bucket, row_number() OVER (PARTITION BY candidate_bucket ORDER BY t.change_30d_pct DESC NULLS LAST, symbol) AS place, {rounded("rsi, pe_ratio, change_30d_pct")} FROM t WHERE candidate_bucket <> 'watch'""",
    "view_24_top": f"{SIG}, {_WATCH} SELECT symbol, composite_rank, trade_signal, round(composite_score, 4) AS composite_score FROM k ORDER BY composite_rank, symbol LIMIT 10",
    "view_29_ranked": f"""{SIG}, {_WATCH}, l AS (SELECT p_brand AS symbol, l_returnflag AS type, count(*) AS n, max(l_shipdate)::DATE AS last FROM lines GROUP BY ALL)
  SELECT symbol, type, n, last, composite_rank, round(composite_score, 4) AS composite_score FROM l JOIN k USING (symbol)""",
    "hld_08_emerging": f"""SELECT s.symbol, s.is_held, c.call, s.mom_12_1, s.dv_acceleration FROM ({_SIGHT}) s LEFT JOIN (WITH {CL} SELECT symbol, arg_max(call, as_of_date) AS call FROM cl GROUP BY symbol) c USING (symbol) WHERE s.emerging""",
    "view_09_active_alerts": f"{_ALERTS} SELECT alert_type, count(*) AS n, count(DISTINCT symbol) AS symbols FROM al GROUP BY ALL",
    "view_10_alerts_joined": f"{_ALERTS} SELECT al.symbol, alert_type, sector, round(close, 4) AS close, round(pe_ratio, 4) AS pe_ratio, round(alert_value, 4) AS alert_value FROM al JOIN wide USING (symbol, as_of_date)",
    "view_11_traps": f"{SIG} SELECT symbol, dividend_yield_trap, {rounded('dividend_yield, dividend_yield_gap', 6)} FROM lst WHERE lst.dividend_yield_gap IS NOT NULL",
    "view_13_versus_benchmarks": f"""{SIG} SELECT symbol, round(change_90d_pct - coalesce((SELECT change_90d_pct FROM lst WHERE symbol = '{SPY}'), 0), 4) AS vs_spy,
  round(change_90d_pct - coalesce((SELECT change_90d_pct FROM lst WHERE symbol = '{QQQ}'), 0), 4) AS vs_qqq FROM lst WHERE symbol NOT IN ('{SPY}', '{QQQ}')""",
    "view_16_three_facts": f"""{SIG}, p AS (SELECT symbol, year(date)::INT AS year, avg(close) AS c, sum(volume)::BIGINT AS volume FROM bars GROUP BY ALL), s AS (SELECT symbol, year(as_of_date)::INT AS year, avg(rsi) AS r FROM sig GROUP BY ALL)
  SELECT p.symbol, p.year, volume, ast AS assets, round(c, 4) AS close, round(r, 4) AS rsi FROM p LEFT JOIN s USING (symbol, year) LEFT JOIN fy ON fy.symbol = p.symbol AND fy.y = p.year""",
    "view_17_buckets": f"""{SIG}, t AS (SELECT *, CASE WHEN change_30d_pct > 5 THEN 'top_momentum' WHEN rsi < 30 THEN 'oversold' WHEN pe_ratio < 15 AND dividend_yield > 0.02 THEN 'value_dividend'
  WHEN bollinger_bandwidth < (SELECT quantile_cont(bollinger_bandwidth, 0.25) FROM lst) THEN 'low_volatility' ELSE 'watch' END AS candidate_bucket FROM lst)
  SELECT candidate_bucket, count(*) AS n, round(avg(rsi), 4) AS avg_rsi FROM t WHERE candidate_bucket <> 'watch' GROUP BY ALL""",
    "view_18_runs": f"""WITH {BARS} SELECT 'run-1' AS _run_id, count(*) AS n, DATE '2024-01-01' AS first, min(date) AS from_date, max(date) AS to_date FROM bars
  UNION ALL SELECT 'run-2', count(*), DATE '2024-01-02', min(date), max(date) FROM bars WHERE (date - DATE '1970-01-01') % 7 = 0""",
    "view_19_duplicates": f"WITH {BARS} SELECT symbol, date, 2::BIGINT AS n FROM bars WHERE (date - DATE '1970-01-01') % 7 = 0",
    "view_21_coverage": f"{WIDE} SELECT sector, count(DISTINCT symbol) AS symbols, count(pe_ratio) AS with_pe, round(avg(pe_ratio), 4) AS avg_pe, round(avg(composite_score), 4) AS avg_score FROM wl GROUP BY ALL",
    "view_22_heat_map": f"""{WIDE}, r AS (SELECT *, rank() OVER (ORDER BY composite_score DESC) AS k FROM wl)
  SELECT sector, industry, count(*) AS n, min(k) AS best_rank, round(avg(composite_score), 4) AS avg_score FROM r GROUP BY ALL""",
    "view_23_rank_and_risk": f"{WIDE} SELECT symbol, rank() OVER (ORDER BY composite_score DESC) AS composite_rank, {rounded('risk_pct, atr_14d, bollinger_bandwidth')} FROM wl",
    "gld_12_trade_log": f"""WITH {TR} SELECT symbol, count(*) AS n, sum(qty)::DOUBLE AS shares, round(sum((qty * price)::DECIMAL(14, 2))::DOUBLE, 0) AS total_cost FROM tr WHERE side = 'buy' AND price IS NOT NULL GROUP BY symbol""",
    "view_25_unrealised": f"""WITH {HL}, lp AS (SELECT symbol, arg_max(close, date) AS last FROM bars GROUP BY symbol)
  SELECT symbol, round(sum(qty * (last - price)), 2) AS pnl, count(*) AS n FROM tr LEFT JOIN lp USING (symbol) WHERE side = 'buy' AND price IS NOT NULL GROUP BY symbol""",
    "view_29_disclosures": """WITH p AS (SELECT c_mktsegment AS symbol, count(*) AS n, max(o_orderdate)::DATE AS last FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL), r AS (SELECT c_mktsegment AS symbol, round(avg(c_acctbal), 4) AS avg_balance FROM customer GROUP BY ALL) SELECT * FROM p JOIN r USING (symbol)""",
    "call_07_coverage": f"""WITH {BARS}, t AS (SELECT count(DISTINCT symbol) AS total FROM bars) SELECT date, count(DISTINCT symbol) AS symbols, round(count(DISTINCT symbol) / any_value(total), 6) AS share,
  count(DISTINCT symbol) / any_value(total) < 0.98 AS warn FROM bars, t GROUP BY date""",
    "set_01_expectation": f"""WITH {FR} SELECT horizon, round(avg(gross - 0.002) * 0.5, 6) AS mean, round(quantile_cont(gross - 0.002, 0.1) * 0.5, 6) AS p10, round(quantile_cont(gross - 0.002, 0.9) * 0.5, 6) AS p90
  FROM te WHERE variant = 'momentum' GROUP BY ALL""",
    "bt_06_hit_rate": f"WITH {FR} SELECT variant, horizon, round(avg((excess_return > 0)::INT), 6) AS hit_rate FROM dc WHERE decile = 9 GROUP BY ALL",
    "bt_09_costs": f"WITH {FR} SELECT symbol, round(avg(fwd_return), 6) AS net_0, round(avg(fwd_return - 0.001), 6) AS net_5, round(avg(fwd_return - 0.002), 6) AS net_10 FROM fr WHERE horizon = 21 GROUP BY symbol",
    "rank_05_latest_scored": f"""{SIG}, p AS (SELECT symbol, CASE WHEN change_90d_pct IS NOT NULL THEN percent_rank() OVER (PARTITION BY change_90d_pct IS NULL ORDER BY change_90d_pct) END AS a,
    CASE WHEN pe_ratio IS NOT NULL THEN percent_rank() OVER (PARTITION BY pe_ratio IS NULL ORDER BY pe_ratio DESC) END AS b FROM lst), s AS (SELECT symbol, round((coalesce(a, 0.5) + coalesce(b, 0.5)) / 2, 9) AS score FROM p)
  SELECT symbol, rank() OVER (ORDER BY score DESC) AS rank, round(score, 6) AS score FROM s""",
    "hld_04_latest_price": f"""WITH {BARS} SELECT symbol, round(arg_max(close, date) * CASE WHEN regexp_extract(symbol, '(\\d+)', 1)::INT % 2 = 0 THEN 1 ELSE 2 END, 4) AS close FROM bars GROUP BY symbol""",
    "hld_06_held_freshness": f"""WITH {HL}, l AS (SELECT symbol, max(date) AS m FROM bars WHERE symbol <> 'Brand#3' OR date < DATE '2000-01-01' GROUP BY symbol)
  SELECT symbol, coalesce(m < DATE '2001-09-01', true) AS stale, CASE WHEN coalesce(m < DATE '2001-09-01', true) THEN 'error' ELSE 'ok' END AS status FROM (SELECT DISTINCT symbol FROM ps) LEFT JOIN l USING (symbol)""",
    "hld_08_decisions": f"WITH {HL} SELECT coalesce(call, 'unscored') AS call, count(*) AS n, count(*) FILTER (deteriorating) AS falling FROM he GROUP BY ALL",
    "ag_15_net_shares": f"WITH {TR} SELECT account, symbol, net FROM nt",
    "ag_16_average_basis": f"WITH {TR} SELECT symbol, round(sum(open * price) / sum(open), 4) AS basis, sum(open) AS qty FROM lt WHERE open > 1e-9 AND price IS NOT NULL GROUP BY symbol",
    "qa_02_last_session": f"WITH {BARS} SELECT max(date) AS session FROM bars WHERE date <= DATE '2000-07-04'",
    "qa_08_backwards": """WITH l AS (SELECT p_brand AS symbol, l_orderkey, min(l_shipdate)::DATE AS date FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
  w AS (SELECT symbol, date, lag(date) OVER (PARTITION BY symbol ORDER BY l_orderkey) AS was FROM l) SELECT symbol, count(*) FILTER (date < was) AS backwards FROM w GROUP BY symbol""",
    "qa_11_mostly_null": """SELECT 'o_orderkey' AS "column", 0.0 AS null_share, false AS failed UNION ALL SELECT 'pending', round(avg((o_orderstatus <> 'P')::INT), 6), avg((o_orderstatus <> 'P')::INT) > 0.5 FROM orders""",
    "src_07_splits": f"WITH {RAW} SELECT symbol, date AS split_date, split_ratio, 'run-1' AS _run_id, date AS event_date FROM raw WHERE split_ratio > 0",
    "src_10_cutoff": f"WITH {BARS} SELECT symbol, max(date) AS last, count(*) AS n FROM bars WHERE date <= DATE '2000-03-14' GROUP BY symbol",
    "src_11_resume": f"WITH {BARS}, {SEC} SELECT symbol FROM sec WHERE symbol NOT IN (SELECT symbol FROM bars WHERE date >= DATE '2001-11-03')",
    "snk_08_evolve": "SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN upper(n_name) ELSE n_name END AS n_name, CASE WHEN n_nationkey % 5 = 0 THEN 1 END AS seen FROM nation",
    "call_settled_rounds": f"""WITH {FRCL} SELECT horizon, count(DISTINCT cl.as_of_date) AS rounds, count(*) AS calls FROM cl JOIN rt ON rt.symbol = '{SPY}' AND rt.as_of_date = cl.as_of_date GROUP BY horizon""",
}
