"""Queries over backtests, calls, settlements and the held book."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import indicators as ind
from ..operators.windows import change, overlap_turnover, pct_rank, series
from ..plans import backtest as bt
from ..plans import calls as cl
from ..plans import holdings as hd
from ..plans import scoring
from ..sources import commits, sinks
from ..sources.tables import SPY, Tables
from .prices import r4
from .sqltext import ADJUSTED, BARS, LINES, rounded

_RUNGS = bt.HORIZONS
#: Every month out to a year; the horizons 21, 63, 126 and 252 are among its rungs.
_LADDER = tuple(21 * k for k in range(1, 13))


def returns(t: Tables, rungs: tuple[int, ...] = _RUNGS) -> DataFrame:
    return bt.forward_returns(ind.adjusted(t.raw_prices()), SPY, rungs)


def signals(t: Tables) -> DataFrame:
    """Two simple signals of every session: one month's change, and its opposite over a quarter."""
    b = t.prices.withColumn("momentum", change("close", 21, series())).withColumn("reversal", -change("close", 63, series()))
    return b.unpivot(["symbol", "date"], ["momentum", "reversal"], "variant", "signal").withColumnRenamed("date", "as_of_date")


def frame(t: Tables, rungs: tuple[int, ...] = _RUNGS) -> DataFrame:
    return bt.evaluation_frame(signals(t), returns(t, rungs), SPY)


def scores(t: Tables) -> DataFrame:
    """Percentiles of the one-month change on month ends, the benchmark left out before it is ranked."""
    s = signals(t).filter(f"variant = 'momentum' and signal is not null and symbol <> '{SPY}'")
    s = s.join(scoring.month_ends(t.prices.select(F.col("date").alias("as_of_date"))), "as_of_date")
    w = Window.partitionBy("as_of_date")
    return s.select(
        "symbol", "as_of_date", F.col("signal").alias("score"), F.rank().over(w.orderBy(F.col("signal").desc())).alias("rank"),
        F.percent_rank().over(w.orderBy("signal")).alias("score_percentile"),
    )


def calls(t: Tables) -> DataFrame:
    return cl.hysteresis(scores(t))


def bt_01_forward_returns(spark, d):
    return r4(returns(Tables(spark, d)), ["symbol", "as_of_date", "horizon", "entry_date", "exit_date"], "fwd_return, benchmark_return, excess_return", 6)


def bt_01_by_date(spark, d):
    """The same returns added up by date and horizon."""
    by = returns(Tables(spark, d)).groupBy("as_of_date", "horizon").agg(
        F.count("*").alias("n"), F.count("excess_return").alias("n_excess"), F.min("entry_date").alias("entry_date"), F.max("exit_date").alias("exit_date"),
        *(F.avg(c).alias(c) for c in ("fwd_return", "benchmark_return", "excess_return")), F.min_by("symbol", F.struct("fwd_return", "symbol")).alias("worst"),
    )
    return r4(by, ["as_of_date", "horizon", "n", "n_excess", "entry_date", "exit_date", "worst"], "fwd_return, benchmark_return, excess_return", 6)


def bt_02_frame(spark, d):
    return r4(frame(Tables(spark, d)), ["variant", "horizon", "as_of_date", "symbol"], "signal, fwd_return, excess_return", 6)


def bt_03_ic(spark, d):
    return r4(bt.ic_by_date(frame(Tables(spark, d))), ["variant", "horizon", "as_of_date"], "ic")


def bt_04_ic_summary(spark, d):
    return r4(bt.ic_summary(bt.ic_by_date(frame(Tables(spark, d)))), ["variant", "horizon", "n_dates"], "mean_ic, t_stat, fold_t")


def bt_05_deciles(spark, d):
    return r4(bt.decile_means(frame(Tables(spark, d))), ["variant", "horizon", "decile"], "mean_excess", 6)


def bt_07_turnover(spark, d):
    top = bt.with_deciles(frame(Tables(spark, d))).filter("decile = 9")
    return r4(overlap_turnover(top, ["variant", "horizon"]), ["variant", "horizon", "as_of_date"], "turnover")


def bt_08_distribution(spark, d):
    return r4(bt.distribution(bt.top_excess(frame(Tables(spark, d)), 10.0)), ["variant", "horizon", "n_dates"], "mean, p10, p90", 6)


def bt_10_evaluate(spark, d):
    out = bt.evaluate(frame(Tables(spark, d)))
    return r4(out, ["variant", "horizon", "n_dates"], "mean_ic, monotonicity, hit_rate, turnover, excess_gross, mean, p10, p90")


def bt_10_decay_ladder(spark, d):
    out = bt.evaluate(frame(Tables(spark, d), _LADDER))
    return r4(out, ["variant", "horizon", "n_dates"], "mean_ic, monotonicity, hit_rate, turnover, excess_gross, mean, p10, p90")


def call_01_hysteresis(spark, d):
    return r4(calls(Tables(spark, d)), ["symbol", "as_of_date", "rank", "in_position", "prior", "call"], "score_percentile", 6)


def call_03_next_round(spark, d):
    t = Tables(spark, d)
    last = calls(t)
    newest = last.agg(F.max("as_of_date").alias("newest"))
    marked = last.crossJoin(F.broadcast(newest))
    log = marked.filter("as_of_date < newest").select("symbol", "as_of_date", "call")
    now = marked.filter("as_of_date = newest").select("symbol", "as_of_date", "score_percentile")
    return cl.next_round(log, now).select("symbol", "as_of_date", "prior", "call")


def call_04_emit(spark, d):
    """Rounds are emitted once: a second emission of everything, its scores turned round, adds only the rounds that are new."""
    c = calls(Tables(spark, d)).select("symbol", "as_of_date", "rank", "call", "score_percentile", F.lit("v2").alias("methodology_version"))
    path = sinks.scratch(spark, "rounds")
    commits.first_write(c.filter("as_of_date < '2000-01-01'"), path)
    commits.first_write(c.withColumn("score_percentile", -F.col("score_percentile")), path)
    return r4(commits.read(spark, path), ["symbol", "as_of_date", "rank", "call", "methodology_version"], "score_percentile", 6)


def call_05_flat(spark, d):
    nested = cl.rounds(calls(Tables(spark, d)), "v2")
    return r4(cl.flat_calls(nested), ["as_of_date", "methodology_version", "symbol", "rank", "call"], "score_percentile", 6)


def call_06_due_date(spark, d):
    return cl.due_date(Tables(spark, d).bars().select("date"), "2000-06-15")


def call_06_due_rules(spark, d):
    """In the middle and on the last day of a month, before the first month, and off the cycle with and without authorisation."""
    b = Tables(spark, d).bars().select("date")
    last = b.agg(F.max("date").cast("string").alias("vintage")).withColumn("action", F.lit("authorize_off_cycle"))
    cases = {
        "mid month": cl.due_date(b, "2000-06-15"), "month end": cl.due_date(b, "2000-06-30"), "too early": cl.due_date(b, "2000-06-30", "2000-07"),
        "authorised": cl.off_cycle_date(b, last), "other vintage": cl.off_cycle_date(b, last.withColumn("vintage", F.lit("2000-01-03"))),
    }
    out = None
    for name, one in cases.items():
        one = one.withColumn("rule", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def bt_11_call_excess(spark, d):
    t = Tables(spark, d)
    return r4(cl.call_excess(calls(t), returns(t), 21), ["as_of_date", "n_in", "n_out"], "in_position, out, spread", 6)


def bt_11_call_turnover(spark, d):
    return r4(cl.position_turnover(calls(Tables(spark, d))), [], "turnover")


#: The share of a walk-forward result that a frozen expectation keeps, and the definition of the scores it is of.
HAIRCUT, DEFINITION = 0.5, "momentum: change over 21 sessions; reversal: the opposite of that over 63"


def expected(t: Tables, rs: DataFrame | None = None) -> DataFrame:
    """Expectations of all variants, frozen from the walk-forward evaluation; the frame is stored, as two readings grade it."""
    rs = returns(t, cl.EXPECTATION_HORIZONS) if rs is None else rs
    f = sinks.stored(bt.evaluation_frame(signals(t), rs, SPY), "frame")
    return cl.freeze(bt.distribution(bt.top_excess(f, 10.0)), bt.ic_by_date(f), DEFINITION, HAIRCUT)


def set_01_frozen(spark, d):
    out = expected(Tables(spark, d))
    return r4(out, ["variant", "horizon", "n_dates", "ic_by_year", "haircut", "definition_hash", "source_sha256"], "mean, p10, p90, ic_mean", 6)


def settled(t: Tables, rs: DataFrame | None = None) -> DataFrame:
    """The calls' rounds graded against the frozen expectation; returns and calls are stored, as several steps read them."""
    rs = sinks.stored(returns(t, cl.EXPECTATION_HORIZONS), "returns") if rs is None else rs
    frozen = expected(t, rs).filter("variant = 'momentum'").select("horizon", "mean", "p10")
    return cl.settle(sinks.stored(calls(t), "calls"), frozen, rs, SPY)


def set_02_settle(spark, d):
    return r4(settled(Tables(spark, d)), ["as_of_date", "horizon", "n_symbols", "n_missing", "below_mean", "below_p10"], "realized_excess_net, realized_ic, mean, p10", 5)


def attributed(t: Tables, rs: DataFrame | None = None) -> DataFrame:
    b = t.prices.withColumn("m", change("close", 21, series())).withColumn("v", F.col("volume"))
    b = b.join(scoring.month_ends(t.prices.select(F.col("date").alias("as_of_date"))).withColumnRenamed("as_of_date", "date"), "date").withColumnRenamed("date", "as_of_date")
    parts = b.select("symbol", "as_of_date", pct_rank(F.col("m"), ["as_of_date"]).alias("momentum_pct"), pct_rank(F.col("v").cast("double"), ["as_of_date"]).alias("volume_pct"))
    return cl.attribution(parts, returns(t) if rs is None else rs, ["momentum_pct", "volume_pct"])


def set_02_attribution(spark, d):
    return r4(attributed(Tables(spark, d)), ["as_of_date", "horizon", "component"], "ic")


def set_03_trailing(spark, d):
    return cl.trailing_runs(settled(Tables(spark, d)), ["below_mean", "below_p10"])


def set_03_drift(spark, d):
    t = Tables(spark, d)
    rs = sinks.stored(returns(t), "returns")
    graded = settled(t, rs.filter(F.col("horizon").isin(*cl.EXPECTATION_HORIZONS)))
    return r4(cl.drift(sinks.stored(graded, "settled"), attributed(t, rs)), ["signal", "n", "action"], "t", 3)


def set_04_agreement(spark, d):
    t = Tables(spark, d)
    return cl.agreement(t.trades(), calls(t).filter("as_of_date < '2000-01-01'"))


def hld_01_open_lots(spark, d):
    lots = hd.open_lots(Tables(spark, d).trades())
    return lots.select("account", "symbol", "date", "seed", F.col("id.l_orderkey").alias("order_id"), F.col("id.l_linenumber").alias("line"), F.round("price", 4).alias("price"), "open")


def positions(t: Tables) -> DataFrame:
    """What a broker would say: the journal's net, one share more for every tenth order of a customer."""
    n = hd.net_shares(t.trades())
    key = F.regexp_extract("account", r"(\d+)$", 1).cast("int")
    q = n.withColumn("quantity", F.when(key % 10 == 0, F.col("net") + 1).otherwise(F.col("net")))
    return q.filter((key % 7 != 0) & (F.col("quantity") > 0)).select("account", "symbol", "quantity")


def src_15_positions(spark, d):
    return positions(Tables(spark, d))


def hld_02_reconcile(spark, d):
    t = Tables(spark, d)
    return hd.reconcile(t.trades(), positions(t))


def hld_03_loss_harvest(spark, d):
    t = Tables(spark, d)
    bars = t.prices
    out = hd.loss_harvest(t.trades(), bars, scoring.latest_price(bars, bars), "2001-06-01")
    return r4(out, ["account", "symbol", "qty", "acquired", "long_term", "wash_sale"], "basis, price, loss_pct")


def tk_05_worst_losses(spark, d):
    """The 25 lots with the worst losses, worst first."""
    t = Tables(spark, d)
    out = hd.loss_harvest(t.trades(), t.prices, scoring.latest_price(t.prices, t.prices), "2001-06-01").withColumn("loss_pct", F.round("loss_pct", 6))
    order = ["loss_pct", "account", "symbol", "acquired", "qty", F.round("basis", 4)]
    return r4(out.orderBy(*order).limit(25), ["account", "symbol", "qty", "acquired", "loss_pct"], "basis")


def hld_05_held(spark, d):
    return held(Tables(spark, d)).select("symbol", "accounts_n", "total_quantity", "tracked", "composite_rank", "call", "deteriorating")


def held(t: Tables) -> DataFrame:
    pos = positions(t)
    c = calls(t)
    newest = c.groupBy("symbol").agg(F.max_by(F.struct("call", "rank"), "as_of_date").alias("l")).select("symbol", "l.call", F.col("l.rank").alias("composite_rank"))
    tags = t.securities().select("symbol", F.lit(False).alias("is_watchlist"), F.lit(True).alias("is_held"), F.lit(False).alias("is_top_n"))
    sight = scoring.line_of_sight(t.prices, tags)
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    tracked = t.securities().select("symbol").filter(n % 4 != 0)
    out = hd.held_table(pos, tracked, newest, newest, sight)
    return out.withColumn("accounts_n", F.size(F.split("accounts", ", ")).cast("long"))


def hld_07_verdicts(spark, d):
    t = Tables(spark, d)
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    prior = t.securities().select("symbol", (n % 2 == 0).alias("flagged"))
    bought = t.trades().filter("side = 'buy'").groupBy("symbol").agg(F.max("date").alias("bought"))
    return hd.verdicts(held(t), prior, bought, "2002-01-15").select("symbol", "verdict", "flagged", "newly")


QUERIES = {
    "bt_01_forward_returns": bt_01_forward_returns, "bt_01_by_date": bt_01_by_date, "bt_02_frame": bt_02_frame, "bt_03_ic": bt_03_ic, "bt_04_ic_summary": bt_04_ic_summary,
    "bt_05_deciles": bt_05_deciles, "bt_07_turnover": bt_07_turnover, "bt_08_distribution": bt_08_distribution, "bt_10_evaluate": bt_10_evaluate,
    "bt_10_decay_ladder": bt_10_decay_ladder,
    "call_01_hysteresis": call_01_hysteresis, "call_03_next_round": call_03_next_round, "call_04_emit": call_04_emit, "src_15_positions": src_15_positions, "tk_05_worst_losses": tk_05_worst_losses, "call_05_flat": call_05_flat, "call_06_due_date": call_06_due_date,
    "bt_11_call_excess": bt_11_call_excess, "bt_11_call_turnover": bt_11_call_turnover, "set_02_settle": set_02_settle, "set_02_attribution": set_02_attribution,
    "set_01_frozen": set_01_frozen, "set_03_trailing": set_03_trailing, "set_03_drift": set_03_drift, "call_06_due_rules": call_06_due_rules, "set_04_agreement": set_04_agreement, "hld_01_open_lots": hld_01_open_lots, "hld_02_reconcile": hld_02_reconcile,
    "hld_03_loss_harvest": hld_03_loss_harvest, "hld_05_held": hld_05_held, "hld_07_verdicts": hld_07_verdicts,
}

# --- SQL ------------------------------------------------------------------------------------------------------------


def _rungs_sql(rungs: tuple[int, ...]) -> str:
    one = "SELECT symbol, date AS as_of_date, {h} AS horizon, entry_date, d{h} AS exit_date, o{h} / entry - 1 AS fwd_return FROM od WHERE entry > 0 AND o{h} IS NOT NULL"
    return " UNION ALL ".join(one.format(h=h) for h in rungs)


def _returns_sql(rungs: tuple[int, ...]) -> str:
    return f"""
od AS (SELECT symbol, date, lead(date) OVER w AS entry_date, lead(adj_open) OVER w AS entry,
  {", ".join(f"lead(date, {1 + h}) OVER w AS d{h}, lead(adj_open, {1 + h}) OVER w AS o{h}" for h in rungs)} FROM adjusted WINDOW w AS (PARTITION BY symbol ORDER BY date)),
rt AS ({_rungs_sql(rungs)}),
"""


FR = (
    ADJUSTED
    + ","
    + _returns_sql(_RUNGS)
    + f"""
fr AS (SELECT rt.*, b.fwd_return AS benchmark_return, rt.fwd_return - b.fwd_return AS excess_return FROM rt
  LEFT JOIN (SELECT * FROM rt WHERE symbol = '{SPY}') b USING (as_of_date, horizon)),
sg AS (SELECT symbol, date AS as_of_date, unnest(['momentum', 'reversal']) AS variant,
  unnest([close / nullif(lag(close, 21) OVER w, 0) - 1, -(close / nullif(lag(close, 63) OVER w, 0) - 1)]) AS signal FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)),
me AS (SELECT horizon, max(as_of_date) AS as_of_date FROM rt WHERE symbol = '{SPY}' GROUP BY horizon, date_trunc('month', as_of_date)),
fm AS (SELECT variant, horizon, as_of_date, symbol, signal, fwd_return, excess_return FROM fr JOIN me USING (as_of_date, horizon) JOIN sg USING (symbol, as_of_date)
  WHERE signal IS NOT NULL AND symbol <> '{SPY}'),
dc AS (SELECT *, ceil(row_number() OVER (PARTITION BY variant, horizon, as_of_date ORDER BY signal, symbol) * 10 / count(*) OVER (PARTITION BY variant, horizon, as_of_date))::INT - 1 AS decile FROM fm),
ic AS (SELECT variant, horizon, as_of_date, corr(a, b) AS ic FROM (SELECT *, rank() OVER (PARTITION BY variant, horizon, as_of_date ORDER BY signal)
    + (count(*) OVER (PARTITION BY variant, horizon, as_of_date, signal) - 1) / 2 AS a, rank() OVER (PARTITION BY variant, horizon, as_of_date ORDER BY excess_return)
    + (count(*) OVER (PARTITION BY variant, horizon, as_of_date, excess_return) - 1) / 2 AS b FROM fm WHERE excess_return IS NOT NULL)
  GROUP BY ALL HAVING min(signal) < max(signal) AND min(excess_return) < max(excess_return)),
dm AS (SELECT variant, horizon, decile, avg(m) AS mean_excess FROM (SELECT variant, horizon, as_of_date, decile, avg(excess_return) AS m FROM dc GROUP BY ALL) GROUP BY ALL),
dt AS (SELECT *, lead(as_of_date) OVER (PARTITION BY variant, horizon ORDER BY as_of_date) AS nx FROM (SELECT DISTINCT variant, horizon, as_of_date FROM dc WHERE decile = 9)),
tn AS (SELECT c.variant, c.horizon, c.as_of_date, 1 - count(p.symbol) / count(*) AS turnover FROM (SELECT * FROM dc WHERE decile = 9) c JOIN dt d ON d.variant = c.variant AND d.horizon = c.horizon AND d.nx = c.as_of_date
  LEFT JOIN (SELECT * FROM dc WHERE decile = 9) p ON p.variant = c.variant AND p.horizon = c.horizon AND p.as_of_date = d.as_of_date AND p.symbol = c.symbol GROUP BY ALL),
te AS (SELECT variant, horizon, as_of_date, avg(fwd_return) FILTER (decile = 9) - avg(fwd_return) AS gross FROM dc GROUP BY ALL)"""
)
CL = (
    BARS
    + f""",
mo AS (SELECT symbol, date AS as_of_date, close / nullif(lag(close, 21) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS score FROM bars),
sc AS (SELECT *, rank() OVER (PARTITION BY as_of_date ORDER BY score DESC) AS rank, percent_rank() OVER (PARTITION BY as_of_date ORDER BY score) AS score_percentile FROM mo
  WHERE score IS NOT NULL AND symbol <> '{SPY}' AND as_of_date IN (SELECT max(date) FROM bars GROUP BY date_trunc('month', date))),
st AS (SELECT *, coalesce(last_value(CASE WHEN score_percentile >= 0.9 THEN true WHEN score_percentile < 0.5 THEN false END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY as_of_date), false) AS in_position FROM sc),
pr AS (SELECT *, coalesce(lag(in_position) OVER (PARTITION BY symbol ORDER BY as_of_date), false) AS prior FROM st),
cl AS (SELECT *, CASE WHEN NOT prior AND in_position THEN 'buy' WHEN prior AND in_position THEN 'hold' WHEN prior THEN 'sell' ELSE 'none' END AS call FROM pr)"""
)
FRCL = FR + "," + CL.split("FROM lines GROUP BY ALL),", 1)[1]
ST = (
    FRCL
    + f""",
ex AS (SELECT variant, horizon, count(*) AS n_dates, avg(gross - 0.002) AS mean, quantile_cont(gross - 0.002, 0.1) AS p10, quantile_cont(gross - 0.002, 0.9) AS p90 FROM te
  WHERE horizon IN {cl.EXPECTATION_HORIZONS} GROUP BY ALL),
fx AS (SELECT cl.as_of_date, cl.symbol, cl.score, cl.score_percentile, fr.horizon, fr.fwd_return, fr.excess_return FROM cl JOIN fr USING (symbol, as_of_date)
  WHERE EXISTS (SELECT 1 FROM rt b WHERE b.symbol = '{SPY}' AND b.as_of_date = cl.as_of_date AND b.horizon = fr.horizon)),
fy2 AS (SELECT *, rank() OVER (PARTITION BY as_of_date, horizon ORDER BY score) + (count(*) OVER (PARTITION BY as_of_date, horizon, score) - 1) / 2 AS a,
  rank() OVER (PARTITION BY as_of_date, horizon ORDER BY excess_return) + (count(*) OVER (PARTITION BY as_of_date, horizon, excess_return) - 1) / 2 AS b FROM fx),
gr AS (SELECT as_of_date, horizon, count(*) AS n_symbols, avg(fwd_return) FILTER (score_percentile >= 0.9) - 0.002 - avg(fwd_return) AS realized_excess_net, corr(a, b) AS realized_ic FROM fy2 GROUP BY ALL),
se AS (SELECT gr.*, n - n_symbols AS n_missing, e.mean, e.p10, coalesce(realized_excess_net < e.mean, false) AS below_mean, coalesce(realized_excess_net < e.p10, false) AS below_p10 FROM gr
  JOIN (SELECT as_of_date, count(*) AS n FROM cl GROUP BY as_of_date) USING (as_of_date) JOIN (SELECT horizon, mean * {HAIRCUT} AS mean, p10 * {HAIRCUT} AS p10 FROM ex WHERE variant = 'momentum') e USING (horizon))"""
)
TR = (
    LINES
    + """,
by0 AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN 'ira-' WHEN o_custkey % 5 = 0 THEN 'My 401(k)-' ELSE 'tax-' END || o_custkey AS account, p_brand AS symbol, l_shipdate::DATE AS date, 'buy' AS side, l_quantity AS qty,
  CASE WHEN l_linenumber <> 3 THEN px END AS price, l_orderkey, l_linenumber, px, l_linenumber = 7 AS seed FROM lines JOIN orders ON l_orderkey = o_orderkey),
tr AS (SELECT * FROM by0 UNION ALL SELECT account, symbol, date + 30, 'sell', floor(qty / 2), price, l_orderkey, l_linenumber, px, false FROM by0 WHERE l_linenumber % 2 = 0 AND floor(qty / 2) > 0),
nt AS (SELECT account, symbol, sum(CASE WHEN side = 'buy' THEN qty ELSE -qty END) AS net, regexp_extract(account, '(\\d+)$', 1)::INT AS k FROM tr GROUP BY ALL),
ps AS (SELECT account, symbol, CASE WHEN k % 10 = 0 THEN net + 1 ELSE net END AS quantity FROM nt WHERE k % 7 <> 0 AND CASE WHEN k % 10 = 0 THEN net + 1 ELSE net END > 0),
lt AS (SELECT *, greatest(0, least(qty, sum(qty) OVER (PARTITION BY account, symbol ORDER BY date, l_orderkey, l_linenumber, px ROWS UNBOUNDED PRECEDING) - sold)) AS open
  FROM tr JOIN (SELECT account, symbol, coalesce(sum(qty) FILTER (side = 'sell'), 0) AS sold FROM tr GROUP BY ALL) USING (account, symbol) WHERE side = 'buy')"""
)
HL = (
    TR
    + ","
    + CL.split("JOIN part ON l_partkey = p_partkey),", 1)[1]
    + """,
nw AS (SELECT symbol, arg_max(call, as_of_date) AS call, arg_max(rank, as_of_date) AS composite_rank FROM cl GROUP BY symbol),
rr AS (SELECT symbol, close, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM bars),
sx AS (SELECT symbol, coalesce(max(close) FILTER (rn = 1) / nullif(max(close) FILTER (rn = 63), 0) < 1 AND max(close) FILTER (rn = 1) / nullif(max(close) FILTER (rn = 126), 0) < 1
  AND max(close) FILTER (rn = 1) / nullif(max(close) FILTER (rn = 252), 0) < 1, false) AS deteriorating FROM rr GROUP BY symbol),
hd AS (SELECT p.symbol, count(DISTINCT account) AS accounts_n, sum(quantity) AS total_quantity, regexp_extract(p.symbol, '(\\d+)', 1)::INT % 4 <> 0 AS tracked FROM ps p GROUP BY p.symbol),
he AS (SELECT hd.*, call, composite_rank, deteriorating FROM hd LEFT JOIN nw USING (symbol) LEFT JOIN sx USING (symbol))"""
)
_ATTR = f"""x AS (SELECT symbol, date AS as_of_date, volume::DOUBLE AS v, close / nullif(lag(close, 21) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS m FROM bars),
  y AS (SELECT symbol, as_of_date, CASE WHEN m IS NOT NULL THEN percent_rank() OVER (PARTITION BY as_of_date, m IS NULL ORDER BY m) END AS momentum_pct,
    percent_rank() OVER (PARTITION BY as_of_date ORDER BY v) AS volume_pct FROM x WHERE as_of_date IN (SELECT max(date) FROM bars GROUP BY date_trunc('month', date))),
  z AS (SELECT symbol, as_of_date, unnest(['momentum_pct', 'volume_pct']) AS component, unnest([momentum_pct, volume_pct]) AS pct FROM y),
  k AS (SELECT as_of_date, horizon, component, rank() OVER (PARTITION BY as_of_date, horizon, component ORDER BY pct) + (count(*) OVER (PARTITION BY as_of_date, horizon, component, pct) - 1) / 2 AS a,
    rank() OVER (PARTITION BY as_of_date, horizon, component ORDER BY excess_return) + (count(*) OVER (PARTITION BY as_of_date, horizon, component, excess_return) - 1) / 2 AS b
    FROM z JOIN fr USING (symbol, as_of_date) WHERE pct IS NOT NULL AND excess_return IS NOT NULL)"""
_T = "CASE WHEN count({c}) > 1 AND stddev_samp({c}) > 0 THEN avg({c}) / stddev_samp({c}) * sqrt(count({c})) WHEN avg({c}) > 0 THEN 'inf'::DOUBLE WHEN avg({c}) < 0 THEN '-inf'::DOUBLE WHEN avg({c}) = 0 THEN 0 END"

SQL = {
    "bt_01_forward_returns": f"WITH {FR} SELECT symbol, as_of_date, horizon, entry_date, exit_date, {rounded('fwd_return, benchmark_return, excess_return', 6)} FROM fr",
    "bt_01_by_date": f"""WITH {FR} SELECT as_of_date, horizon, count(*) AS n, count(excess_return) AS n_excess, min(entry_date) AS entry_date, max(exit_date) AS exit_date,
  arg_min(symbol, (fwd_return, symbol)) AS worst, {", ".join(f"round(avg({c}), 6) AS {c}" for c in ("fwd_return", "benchmark_return", "excess_return"))} FROM fr GROUP BY ALL""",
    "bt_02_frame": f"WITH {FR} SELECT variant, horizon, as_of_date, symbol, {rounded('signal, fwd_return, excess_return', 6)} FROM fm",
    "bt_03_ic": f"WITH {FR} SELECT variant, horizon, as_of_date, round(ic, 4) AS ic FROM ic",
    "bt_04_ic_summary": f"""WITH {FR}, ye AS (SELECT variant, horizon, avg(ic) AS ic FROM ic GROUP BY variant, horizon, year(as_of_date)),
  fo AS (SELECT variant, horizon, {_T.format(c="ic")} AS fold_t FROM ye GROUP BY ALL), su AS (SELECT variant, horizon, count(*) AS n_dates, avg(ic) AS mean_ic, {_T.format(c="ic")} AS t_stat FROM ic GROUP BY ALL)
  SELECT variant, horizon, n_dates, {rounded("mean_ic, t_stat, fold_t")} FROM su JOIN fo USING (variant, horizon)""",
    "bt_05_deciles": f"WITH {FR} SELECT variant, horizon, decile, round(mean_excess, 6) AS mean_excess FROM dm",
    "bt_07_turnover": f"WITH {FR} SELECT variant, horizon, as_of_date, round(turnover, 4) AS turnover FROM tn",
    "bt_08_distribution": f"""WITH {FR} SELECT variant, horizon, count(*) AS n_dates, round(avg(gross - 0.002), 6) AS mean, round(quantile_cont(gross - 0.002, 0.1), 6) AS p10,
  round(quantile_cont(gross - 0.002, 0.9), 6) AS p90 FROM te GROUP BY ALL""",
    "bt_10_evaluate": f"""WITH {FR}, i AS (SELECT variant, horizon, count(*) AS n_dates, avg(ic) AS mean_ic FROM ic GROUP BY ALL),
  m AS (SELECT variant, horizon, corr(a, b) AS monotonicity FROM (SELECT *, rank() OVER (PARTITION BY variant, horizon ORDER BY decile) AS a, rank() OVER (PARTITION BY variant, horizon ORDER BY mean_excess) AS b FROM dm) GROUP BY ALL),
  h AS (SELECT variant, horizon, avg((excess_return > 0)::INT) AS hit_rate FROM dc WHERE decile = 9 GROUP BY ALL),
  t AS (SELECT variant, horizon, avg(turnover) AS turnover FROM tn GROUP BY ALL),
  x AS (SELECT variant, horizon, avg(gross) AS excess_gross, avg(gross - 0.002) AS mean, quantile_cont(gross - 0.002, 0.1) AS p10, quantile_cont(gross - 0.002, 0.9) AS p90 FROM te GROUP BY ALL)
  SELECT variant, horizon, n_dates, {rounded("mean_ic, monotonicity, hit_rate, turnover, excess_gross, mean, p10, p90")}
  FROM i JOIN m USING (variant, horizon) JOIN h USING (variant, horizon) JOIN t USING (variant, horizon) JOIN x USING (variant, horizon)""",
    "call_01_hysteresis": f"WITH {CL} SELECT symbol, as_of_date, rank, in_position, prior, call, round(score_percentile, 6) AS score_percentile FROM cl",
    "call_03_next_round": f"WITH {CL} SELECT symbol, as_of_date, prior, call FROM cl WHERE as_of_date = (SELECT max(as_of_date) FROM cl)",
    "call_04_emit": f"""WITH {CL} SELECT symbol, as_of_date, rank, call, 'v2' AS methodology_version,
  round(CASE WHEN as_of_date < DATE '2000-01-01' THEN score_percentile ELSE -score_percentile END, 6) AS score_percentile FROM cl""",
    "src_15_positions": f"WITH {TR} SELECT account, symbol, quantity FROM ps",
    "call_05_flat": f"WITH {CL} SELECT as_of_date, 'v2' AS methodology_version, symbol, rank, call, round(score_percentile, 6) AS score_percentile FROM cl",
    "call_06_due_date": f"WITH {BARS} SELECT max(date) AS due FROM bars WHERE date < DATE '2000-06-01'",
    "bt_11_call_excess": f"""WITH {FRCL} SELECT as_of_date, count(*) FILTER (call IN ('buy', 'hold')) AS n_in, count(*) FILTER (call NOT IN ('buy', 'hold')) AS n_out,
  round(avg(excess_return) FILTER (call IN ('buy', 'hold')), 6) AS in_position, round(avg(excess_return) FILTER (call NOT IN ('buy', 'hold')), 6) AS out,
  round(avg(excess_return) FILTER (call IN ('buy', 'hold')) - avg(excess_return) FILTER (call NOT IN ('buy', 'hold')), 6) AS spread
  FROM cl JOIN fr USING (symbol, as_of_date) WHERE horizon = 21 GROUP BY as_of_date""",
    "bt_11_call_turnover": f"""WITH {CL}, i AS (SELECT symbol, as_of_date FROM cl WHERE call IN ('buy', 'hold')), q AS (SELECT as_of_date, lead(as_of_date) OVER (ORDER BY as_of_date) AS nx FROM (SELECT DISTINCT as_of_date FROM i)),
  r AS (SELECT i.as_of_date, 1 - count(p.symbol) / count(*) AS turnover FROM i JOIN q ON q.nx = i.as_of_date LEFT JOIN i p ON p.as_of_date = q.as_of_date AND p.symbol = i.symbol GROUP BY i.as_of_date)
  SELECT round(avg(turnover), 4) AS turnover FROM r""",
    "set_02_settle": f"WITH {ST} SELECT as_of_date, horizon, n_symbols, n_missing, below_mean, below_p10, {rounded('realized_excess_net, realized_ic, mean, p10', 5)} FROM se",
    "set_01_frozen": f"""WITH {ST}, iy AS (SELECT variant, horizon, year(as_of_date) AS y, avg(ic) AS ic FROM ic GROUP BY ALL),
  ib AS (SELECT variant, horizon, string_agg(y || ':' || round(ic, 6)::DECIMAL(18, 6), ',' ORDER BY y) AS ic_by_year FROM iy GROUP BY ALL), im AS (SELECT variant, horizon, avg(ic) AS ic_mean FROM ic GROUP BY ALL),
  sh AS (SELECT variant, sha256(string_agg(lpad(horizon::VARCHAR, 4, '0') || ':' || round(mean, 6)::DECIMAL(18, 6) || ':' || round(p10, 6)::DECIMAL(18, 6) || ':' || round(p90, 6)::DECIMAL(18, 6) || ':' || n_dates, ',' ORDER BY horizon)) AS source_sha256
    FROM ex GROUP BY variant)
  SELECT variant, horizon, n_dates, ic_by_year, {HAIRCUT}::DOUBLE AS haircut, sha256('{DEFINITION}') AS definition_hash, source_sha256, round(mean * {HAIRCUT}, 6) AS mean, round(p10 * {HAIRCUT}, 6) AS p10,
    round(p90 * {HAIRCUT}, 6) AS p90, round(ic_mean, 6) AS ic_mean FROM ex JOIN ib USING (variant, horizon) JOIN im USING (variant, horizon) JOIN sh USING (variant)""",
    "call_06_due_rules": f"""WITH {BARS}, m AS (SELECT max(date) FILTER (date < DATE '2000-06-01') AS a, max(date) FILTER (date <= DATE '2000-06-30') AS b, max(date) AS c FROM bars)
  SELECT 'mid month' AS rule, a AS due FROM m UNION ALL SELECT 'month end', b FROM m UNION ALL SELECT 'too early', NULL UNION ALL SELECT 'authorised', c FROM m UNION ALL SELECT 'other vintage', NULL""",
    "set_02_attribution": f"""WITH {FR}, {_ATTR} SELECT as_of_date, horizon, component, round(corr(a, b), 4) AS ic FROM k GROUP BY ALL""",
    "set_03_drift": f"""WITH {ST}, {_ATTR}, sr AS (SELECT * FROM se WHERE horizon = 21),
  g AS (SELECT count(*) FILTER (as_of_date > coalesce((SELECT max(as_of_date) FROM sr WHERE NOT below_mean), DATE '0001-01-01')) AS m,
    count(*) FILTER (as_of_date > coalesce((SELECT max(as_of_date) FROM sr WHERE NOT below_p10), DATE '0001-01-01')) AS p FROM sr),
  c AS (SELECT as_of_date, component, nullif(corr(a, b), 'NaN'::DOUBLE) AS ic FROM k WHERE horizon = 21 AND as_of_date IN (SELECT as_of_date FROM sr) GROUP BY ALL),
  t AS (SELECT component AS signal, count(ic) AS n, avg(ic) / nullif(stddev_samp(ic), 0) * sqrt(count(ic)) AS t FROM c WHERE ic IS NOT NULL GROUP BY ALL)
  SELECT 'below_mean' AS signal, m AS n, NULL::DOUBLE AS t, CASE WHEN m >= 3 THEN 'review' END AS action FROM g UNION ALL SELECT 'below_p10', p, NULL, CASE WHEN p >= 2 THEN 'review' END FROM g
  UNION ALL SELECT signal, n, round(t, 3), CASE WHEN n >= 3 AND abs(t) < 1 THEN 'demotion_review' END FROM t""",
    "set_03_trailing": f"""WITH {ST} SELECT horizon, count(*) FILTER (as_of_date > coalesce((SELECT max(as_of_date) FROM se s WHERE s.horizon = se.horizon AND NOT s.below_mean), DATE '0001-01-01')) AS trailing_below_mean,
  count(*) FILTER (as_of_date > coalesce((SELECT max(as_of_date) FROM se s WHERE s.horizon = se.horizon AND NOT s.below_p10), DATE '0001-01-01')) AS trailing_below_p10 FROM se GROUP BY horizon""",
    "set_04_agreement": f"""WITH {HL}, v AS (SELECT max(as_of_date) AS vintage FROM cl WHERE as_of_date < DATE '2000-01-01'),
  o AS (SELECT symbol, call FROM cl WHERE as_of_date = (SELECT vintage FROM v))
  SELECT CASE WHEN (side = 'buy' AND call IN ('buy', 'hold')) OR (side = 'sell' AND call = 'sell') THEN 'followed'
    WHEN (side = 'buy' AND call = 'sell') OR (side = 'sell' AND call IN ('buy', 'hold')) THEN 'contradicted' ELSE 'unprompted' END AS bucket, count(*) AS n
  FROM tr LEFT JOIN o USING (symbol) WHERE NOT seed AND date > (SELECT vintage FROM v) GROUP BY ALL""",
    "hld_01_open_lots": f"WITH {TR} SELECT account, symbol, date, seed, l_orderkey AS order_id, l_linenumber AS line, round(price, 4) AS price, open FROM lt WHERE open > 1e-9",
    "hld_02_reconcile": f"""WITH {TR}, w AS (SELECT account, symbol, net, quantity, CASE WHEN net < -1e-9 THEN 'oversold' WHEN quantity IS NOT NULL AND abs(quantity - net) > 1e-9 THEN 'differs'
  WHEN quantity IS NULL AND net > 1e-9 THEN 'missing' END AS warning FROM nt LEFT JOIN ps USING (account, symbol)) SELECT * FROM w WHERE warning IS NOT NULL""",
    "hld_03_loss_harvest": f"""WITH {HL}, lp AS (SELECT symbol, arg_max(close, date) AS last FROM bars GROUP BY symbol),
  b AS (SELECT lt.*, bars.close AS thn FROM lt ASOF LEFT JOIN bars ON bars.symbol = lt.symbol AND bars.date <= lt.date WHERE lt.open > 1e-9 AND account NOT LIKE 'ira%' AND account NOT LIKE '%401%'),
  c AS (SELECT *, coalesce(price, thn) AS basis FROM b JOIN lp USING (symbol))
  SELECT account, symbol, open AS qty, date AS acquired, (DATE '2001-06-01' - date) >= 365 AS long_term,
    symbol IN (SELECT symbol FROM tr WHERE side = 'buy' AND NOT seed AND date >= DATE '2001-06-01' - 30) AS wash_sale,
    round(basis, 4) AS basis, round(last, 4) AS price, round(last / basis - 1, 4) AS loss_pct FROM c WHERE last < basis""",
    "tk_05_worst_losses": f"""WITH {HL}, lp AS (SELECT symbol, arg_max(close, date) AS last FROM bars GROUP BY symbol),
  b AS (SELECT lt.*, bars.close AS thn FROM lt ASOF LEFT JOIN bars ON bars.symbol = lt.symbol AND bars.date <= lt.date WHERE lt.open > 1e-9 AND account NOT LIKE 'ira%' AND account NOT LIKE '%401%'),
  c AS (SELECT *, coalesce(price, thn) AS basis FROM b JOIN lp USING (symbol))
  SELECT account, symbol, open AS qty, date AS acquired, round(last / basis - 1, 6) AS loss_pct, round(basis, 4) AS basis FROM c WHERE last < c.basis
  ORDER BY 5, 1, 2, 4, 3, 6 LIMIT 25""",
    "hld_05_held": f"WITH {HL} SELECT symbol, accounts_n, total_quantity, tracked, composite_rank, call, deteriorating FROM he",
    "hld_07_verdicts": f"""WITH {HL}, f AS (SELECT he.*, coalesce(deteriorating, false) OR coalesce(call = 'sell', false) AS flagged, regexp_extract(symbol, '(\\d+)', 1)::INT % 2 = 0 AS was,
  (SELECT max(date) FROM tr WHERE side = 'buy' AND tr.symbol = he.symbol) AS bought FROM he)
  SELECT symbol, CASE WHEN NOT tracked THEN 'punt' WHEN flagged AND DATE '2002-01-15' - bought < 60 THEN 'too-soon' WHEN flagged THEN 'act' ELSE 'keep' END AS verdict, flagged, flagged AND NOT was AS newly FROM f""",
}

SQL["bt_10_decay_ladder"] = SQL["bt_10_evaluate"].replace(_returns_sql(_RUNGS), _returns_sql(_LADDER))
