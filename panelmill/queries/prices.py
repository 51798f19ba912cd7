"""Queries over prices and indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import indicators as ind
from ..operators.ema import emas
from ..operators.windows import change, latest_per_key, rolling, running_product, series, with_extremes
from ..sources.tables import QQQ, SPY, Tables
from .sqltext import ADJUSTED, BARS, RAW, SIGNALS, frames, full, rounded



def r4(df: DataFrame, keep: list[str], values: str, digits: int = 4) -> DataFrame:
    """``keep`` as they are and ``values`` rounded."""
    return df.select(*keep, *(F.round(c.strip(), digits).alias(c.strip()) for c in values.split(",")))


SIGNAL_VALUES = (
    "last_closing_price, macd, macd_signal_line, macd_histogram, rsi, ema_50, ema_200, atr_14d, bollinger_upper, bollinger_lower, bollinger_pct_b, "
    "bollinger_bandwidth, mfi, ma_50, ma_200, last_day_change_abs, last_day_change_pct, change_30d_pct, change_90d_pct, change_365d_pct"
)


def bars(spark, d):
    return Tables(spark, d).bars()


def wn_01_latest_landed(spark, d):
    landed = Tables(spark, d).landed_prices()
    return latest_per_key(landed, ["symbol", "date"], F.col("_ingest_ts").desc(), F.col("_run_id").desc()).drop("_ingest_ts")


def ind_01_change(spark, d):
    both = {n: ind.change_over(n) for n in ind.CHANGE_ROWS}
    out = bars(spark, d).withColumns({f"change_{n}d_abs": x for n, (x, _) in both.items()} | {f"change_{n}d_pct": x for n, (_, x) in both.items()})
    return r4(out, ["symbol", "date"], ", ".join(f"change_{n}d_abs, change_{n}d_pct" for n in both))


def ind_03_changes(spark, d):
    return r4(ind.with_changes(bars(spark, d)), ["symbol", "date"], "last_day_change_abs, last_day_change_pct, change_30d_pct, change_90d_pct, change_365d_pct")


def ind_04_sma(spark, d):
    b = bars(spark, d).withColumns({f"ma_{n}": rolling(F.avg, "close", n, series()) for n in ind.SMA_ROWS})
    return r4(b, ["symbol", "date"], ", ".join(f"ma_{n}" for n in ind.SMA_ROWS))


def ind_05_ema(spark, d):
    return r4(emas(Tables(spark, d).prices, {"ema_50": ("close", 2 / 51), "ema_200": ("close", 2 / 201)}), ["symbol", "date"], "ema_50, ema_200")


def _recursive(columns):
    return lambda spark, d: r4(ind.with_recursive(Tables(spark, d).prices), ["symbol", "date"], columns)


def ind_08_bollinger(spark, d):
    return r4(ind.with_bollinger(bars(spark, d)), ["symbol", "date"], "bollinger_upper, bollinger_lower, bollinger_pct_b, bollinger_bandwidth")


def ind_09_volume_trend(spark, d):
    b = bars(spark, d).withColumns({f"vol_trend_{n}d": rolling(F.avg, "volume", n, series()) for n in ind.VOLUME_ROWS})
    return r4(b, ["symbol", "date"], ", ".join(f"vol_trend_{n}d" for n in ind.VOLUME_ROWS))


def ind_12_atr(spark, d):
    """All average true ranges in one scan."""
    return r4(ind.with_recursive(Tables(spark, d).prices, ind.ATR_ROWS), ["symbol", "date"], ", ".join(f"atr_{n}d" for n in ind.ATR_ROWS))


def ind_10_obv_mfi(spark, d):
    return r4(ind.with_volume(bars(spark, d)), ["symbol", "date", "obv"], "mfi")


def ind_13_high_low(spark, d):
    specs = {f"{kind}_{n}d": (f, kind, n) for n in ind.HIGH_LOW_ROWS for kind, f in (("high", "max"), ("low", "min"))}
    b = with_extremes(bars(spark, d), specs, series())
    return r4(b, ["symbol", "date"], ", ".join(f"high_{n}d, low_{n}d" for n in ind.HIGH_LOW_ROWS))


def ind_14_risk(spark, d):
    return r4(ind.with_risk(bars(spark, d)), ["symbol", "date", "no_downside"], "sharpe, sortino")


def ind_16_max_drawdown(spark, d):
    return r4(ind.max_drawdown(bars(spark, d)), ["symbol"], "max_drawdown")


def ind_17_beta(spark, d):
    return r4(ind.beta(bars(spark, d), SPY), ["symbol"], "beta")


def ind_21_signal_series(spark, d):
    return r4(ind.signal_series(Tables(spark, d).prices), ["symbol", "as_of_date", "obv", "trade_signal"], SIGNAL_VALUES)


def ind_22_signal_row(spark, d):
    """All keys of the latest row; the quoted fundamentals are stand-ins made of a brand's number."""
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("double")
    quoted = Tables(spark, d).securities().select("symbol", n.alias("forward_eps"), (n * 2).alias("forward_pe"), (n > 30).alias("dividend_yield_trap"))
    row = ind.signal_row(Tables(spark, d).prices, quoted)
    plain = ["symbol", "date", "trade_signal", "obv", "dividend_yield_trap"]
    return r4(row, plain, ", ".join(c for c in row.columns if c not in plain))


def ind_24_adjusted(spark, d):
    return r4(ind.adjusted(Tables(spark, d).raw_prices()), ["symbol", "date"], "adj_factor, adj_open, adj_close", 6)


def ind_25_split_factors(spark, d):
    p = Tables(spark, d).raw_prices().filter("split_ratio > 0")
    return p.select("symbol", "date", (1 / F.col("split_ratio")).alias("pre_factor"), F.col("split_ratio").alias("post_factor"))


def wn_09_cumulative_split(spark, d):
    p = Tables(spark, d).raw_prices()
    split = F.coalesce(F.nullif("split_ratio", F.lit(0.0)), F.lit(1.0))
    return p.select("symbol", "date", F.round(running_product(split, series()), 6).alias("cum_split"))


def wn_11_rolling(spark, d):
    b = bars(spark, d).withColumns(
        {f"{n}_10": rolling(fn, "close", 10, series()) for n, fn in (("avg", F.avg), ("std", F.stddev_samp), ("sum", F.sum), ("max", F.max), ("min", F.min))}
    )
    return r4(b, ["symbol", "date"], "avg_10, std_10, sum_10, max_10, min_10")


def wn_13_running(spark, d):
    run = series().rowsBetween(Window.unboundedPreceding, 0)
    return bars(spark, d).select("symbol", "date", F.sum("volume").over(run).alias("cum_volume"), F.max("close").over(run).alias("cum_max"))


def fct_01_market(spark, d):
    t = Tables(spark, d)
    b = t.bars().withColumns({f"return_{k}d": change("close", k, series()) for k in (1, 5, 21, 63, 252)})
    dim = t.securities().select("symbol", "sector")
    b = b.join(dim, "symbol", "left").withColumn("date_key", F.date_format("date", "yyyyMMdd").cast("int"))
    return r4(b, ["symbol", "date_key", "sector", "volume"], "close, return_1d, return_5d, return_21d, return_63d, return_252d", 6)


def dsum_monthly(spark, d):
    return bars(spark, d).groupBy("symbol", F.to_date(F.date_trunc("month", "date")).alias("month")).agg(
        F.round(F.avg("close"), 4).alias("avg_close"), F.count("*").alias("sessions"), F.max("date").alias("last_session")
    )


def jn_17_benchmark_columns(spark, d):
    b = ind.with_changes(bars(spark, d)).withColumn("_last", F.max("date").over(Window.partitionBy("symbol"))).filter("date = _last").drop("_last")
    one = b.agg(*(F.max(F.when(F.col("symbol") == s, F.col("change_30d_pct"))).alias(f"{n}_change_30d") for n, s in (("spy", SPY), ("qqq", QQQ))))
    return r4(b.crossJoin(F.broadcast(one)), ["symbol"], "change_30d_pct, spy_change_30d, qqq_change_30d")


_W = "WINDOW w AS (PARTITION BY symbol ORDER BY date)"


def _signals_sql(columns: str) -> str:
    """Columns of the recursion before its warm-up is cut."""
    return f"WITH RECURSIVE {SIGNALS} SELECT symbol, date, {rounded(columns)} FROM s3"


QUERIES = {
    "src_bars": bars,
    "wn_01_latest_landed": wn_01_latest_landed,
    "ind_01_change": ind_01_change,
    "ind_03_changes": ind_03_changes,
    "ind_04_sma": ind_04_sma,
    "ind_05_ema": ind_05_ema,
    "ind_06_rsi": _recursive("rsi"),
    "ind_07_macd": _recursive("macd, macd_signal_line, macd_histogram"),
    "ind_12_atr": ind_12_atr,
    "ind_08_bollinger": ind_08_bollinger,
    "ind_09_volume_trend": ind_09_volume_trend,
    "ind_10_obv_mfi": ind_10_obv_mfi,
    "ind_13_high_low": ind_13_high_low,
    "ind_14_risk": ind_14_risk,
    "ind_16_max_drawdown": ind_16_max_drawdown,
    "ind_17_beta": ind_17_beta,
    "ind_21_signal_series": ind_21_signal_series,
    "ind_22_signal_row": ind_22_signal_row,
    "ind_24_adjusted": ind_24_adjusted,
    "ind_25_split_factors": ind_25_split_factors,
    "wn_09_cumulative_split": wn_09_cumulative_split,
    "wn_11_rolling": wn_11_rolling,
    "wn_13_running": wn_13_running,
    "fct_01_market": fct_01_market,
    "ag_11_monthly": dsum_monthly,
    "jn_17_benchmark_columns": jn_17_benchmark_columns,
}

_CHG = "100 * (close / nullif(lag(close, {k}) OVER w, 0) - 1)"
_ATR = f"""at0 AS (SELECT symbol, date, row_number() OVER w AS rn, greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr FROM bars {_W}),
at1 AS (SELECT symbol, date, rn, {", ".join(f"tr AS a{n}" for n in ind.ATR_ROWS)} FROM at0 WHERE rn = 1
  UNION ALL SELECT x.symbol, x.date, x.rn, {", ".join(f"y.a{n} * (1 - 1.0::DOUBLE / {n}) + x.tr / {n}" for n in ind.ATR_ROWS)} FROM at1 y JOIN at0 x ON x.symbol = y.symbol AND x.rn = y.rn + 1)"""


def _row_sql() -> str:
    at = lambda c, n=1: f"max({c}) FILTER (back = {n})"
    over = lambda f, c, n: f"CASE WHEN count({c}) FILTER (back <= {n}) = {n} THEN {f}({c}) FILTER (back <= {n}) END"
    keys = [(c, at(c)) for c in ("rsi", "macd", "macd_signal_line", "macd_histogram", "bollinger_upper", "bollinger_lower", "bollinger_pct_b", "bollinger_bandwidth", "mfi", "ema_50", "ema_200")]
    keys += [("last_closing_price", at("close")), ("last_opening_price", at("open"))]
    for name, n in (("last_day_change", 2), *((f"change_{n}d", n) for n in ind.CHANGE_ROWS)):
        keys += [(f"{name}_abs", f"{at('close')} - nullif({at('close', n)}, 0)"), (f"{name}_pct", f"({at('close')} - {at('close', n)}) / nullif({at('close', n)}, 0) * 100")]
    for n in ind.HIGH_LOW_ROWS:
        keys += [(f"high_{n}d", over("max", "high", n)), (f"low_{n}d", over("min", "low", n))]
    keys += [(f"ma_{n}", over("avg", "close", n)) for n in ind.SMA_ROWS] + [(f"vol_trend_{n}d", over("avg", "volume", n)) for n in ind.VOLUME_ROWS]
    keys += [(f"atr_{n}d", f"CASE WHEN count(*) > {n} THEN {at(f'a{n}')} END") for n in ind.ATR_ROWS]
    number = "regexp_extract(symbol, '(\\d+)', 1)::DOUBLE"
    keys += [("forward_eps", number), ("forward_pe", f"{number} * 2")] + [(c, "NULL::DOUBLE") for c in ("eps", "pe_ratio", "dividend_yield", "dividend_yield_gap")]
    return f"""WITH RECURSIVE {SIGNALS}, {_ATR}, s4 AS (SELECT s3.*, mid + 2 * dev AS bollinger_upper, mid - 2 * dev AS bollinger_lower, (close - (mid - 2 * dev)) / nullif(4 * dev, 0) AS bollinger_pct_b,
  4 * dev / nullif(mid, 0) AS bollinger_bandwidth, CASE WHEN su = 0 THEN 0 WHEN sd = 0 THEN 100 ELSE 100 - 100 / (1 + su / sd) END AS mfi,
  CASE WHEN macd > macd_signal_line AND rsi < 70 THEN 'Buy' WHEN macd < macd_signal_line AND rsi > 30 THEN 'Sell' ELSE 'Hold' END AS trade_signal,
  {", ".join(f"a{n}" for n in ind.ATR_ROWS)}, row_number() OVER (PARTITION BY s3.symbol ORDER BY s3.date DESC) AS back FROM s3 JOIN at1 ON at1.symbol = s3.symbol AND at1.date = s3.date)
  SELECT symbol, {at("date")} AS date, {at("trade_signal")} AS trade_signal, {at("obv")} AS obv, {number} > 30 AS dividend_yield_trap, {", ".join(f"round({v}, 4) AS {k}" for k, v in keys)} FROM s4 GROUP BY symbol"""


SQL = {
    "src_bars": f"WITH {BARS} SELECT * FROM bars",
    "wn_01_latest_landed": f"""WITH {BARS} SELECT symbol, date, open, high, low, volume,
  CASE WHEN (date - DATE '1970-01-01') % 7 = 0 THEN close * 1.5 ELSE close END AS close,
  CASE WHEN (date - DATE '1970-01-01') % 7 = 0 THEN 'run-2' ELSE 'run-1' END AS _run_id FROM bars""",
    "ind_01_change": f"""WITH {BARS} SELECT symbol, date, {", ".join(f"round(close - nullif(lag(close, {n - 1}) OVER w, 0), 4) AS change_{n}d_abs, "
  f"round((close - lag(close, {n - 1}) OVER w) / nullif(lag(close, {n - 1}) OVER w, 0) * 100, 4) AS change_{n}d_pct" for n in ind.CHANGE_ROWS)} FROM bars {_W}""",
    "ind_03_changes": f"""WITH {BARS} SELECT symbol, date, round(close - lag(close) OVER w, 4) AS last_day_change_abs,
  {", ".join(f"round({_CHG.format(k=k)}, 4) AS {n}" for k, n in ((1, "last_day_change_pct"), (21, "change_30d_pct"), (63, "change_90d_pct"), (252, "change_365d_pct")))}
  FROM bars {_W}""",
    "ind_04_sma": f"WITH {BARS} SELECT symbol, date, {', '.join(f'round({full('avg', 'close', n)}, 4) AS ma_{n}' for n in ind.SMA_ROWS)} FROM bars WINDOW {frames(*ind.SMA_ROWS)}",
    "ind_05_ema": _signals_sql("ema_50, ema_200"),
    "ind_06_rsi": _signals_sql("rsi"),
    "ind_07_macd": _signals_sql("macd, macd_signal_line, macd_histogram"),
    "ind_12_atr": f"WITH RECURSIVE {BARS}, {_ATR} SELECT symbol, date, {', '.join(f'round(a{n}, 4) AS atr_{n}d' for n in ind.ATR_ROWS)} FROM at1",
    "ind_08_bollinger": f"""WITH {BARS}, m AS (SELECT *, {full("avg", "close", 20)} AS mid, {full("stddev_samp", "close", 20)} AS dev FROM bars WINDOW {frames(20)})
  SELECT symbol, date, round(mid + 2 * dev, 4) AS bollinger_upper, round(mid - 2 * dev, 4) AS bollinger_lower,
  round((close - (mid - 2 * dev)) / nullif(4 * dev, 0), 4) AS bollinger_pct_b, round(4 * dev / nullif(mid, 0), 4) AS bollinger_bandwidth FROM m""",
    "ind_09_volume_trend": f"WITH {BARS} SELECT symbol, date, {', '.join(f'round({full('avg', 'volume', n)}, 4) AS vol_trend_{n}d' for n in ind.VOLUME_ROWS)} FROM bars WINDOW {frames(*ind.VOLUME_ROWS)}",
    "ind_10_obv_mfi": f"""WITH RECURSIVE {SIGNALS} SELECT symbol, date, obv,
  round(CASE WHEN su = 0 THEN 0 WHEN sd = 0 THEN 100 ELSE 100 - 100 / (1 + su / sd) END, 4) AS mfi FROM s3""",
    "ind_13_high_low": f"""WITH {BARS} SELECT symbol, date, {", ".join(f"round({full('max', 'high', n)}, 4) AS high_{n}d, round({full('min', 'low', n)}, 4) AS low_{n}d" for n in ind.HIGH_LOW_ROWS)}
  FROM bars WINDOW {frames(*ind.HIGH_LOW_ROWS)}""",
    "ind_14_risk": f"""WITH {BARS}, q AS (SELECT *, close / nullif(lag(close) OVER w, 0) - 1 AS ret FROM bars {_W}),
  k AS (SELECT *, {full("avg", "ret", 252)} AS mean, {full("stddev_samp", "ret", 252)} AS dev, stddev_samp(CASE WHEN ret < 0 THEN ret END) OVER r252 AS bad,
  count(CASE WHEN ret < 0 THEN ret END) OVER r252 AS n FROM q WINDOW {frames(252)})
  SELECT symbol, date, mean IS NOT NULL AND n = 0 AS no_downside, round(mean * 252 / (nullif(dev, 0) * sqrt(252)), 4) AS sharpe,
  round(CASE WHEN mean IS NOT NULL THEN mean * 252 / nullif(bad * sqrt(252), 0) END, 4) AS sortino FROM k""",
    "ind_16_max_drawdown": f"""WITH {BARS}, t AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 252),
  x AS (SELECT symbol, close / max(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS dd FROM t)
  SELECT symbol, round(min(dd), 4) AS max_drawdown FROM x GROUP BY symbol""",
    "ind_17_beta": f"""WITH {BARS}, q AS (SELECT symbol, date, close / nullif(lag(close) OVER w, 0) - 1 AS r FROM bars {_W}),
  x AS (SELECT q.symbol, q.date, q.r, b.r AS b FROM q JOIN q b ON b.symbol = '{SPY}' AND b.date = q.date WHERE q.r IS NOT NULL AND b.r IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY q.symbol ORDER BY q.date DESC) <= 252)
  SELECT symbol, round(CASE WHEN count(*) >= 20 THEN covar_samp(r, b) / nullif(var_samp(b), 0) END, 4) AS beta FROM x GROUP BY symbol""",
    "ind_21_signal_series": f"WITH RECURSIVE {SIGNALS} SELECT symbol, as_of_date, obv, trade_signal, {rounded(SIGNAL_VALUES)} FROM signals",
    "ind_22_signal_row": _row_sql(),
    "ind_24_adjusted": f"WITH {ADJUSTED} SELECT symbol, date, {rounded('adj_factor, adj_open, adj_close', 6)} FROM adjusted",
    "ind_25_split_factors": f"WITH {RAW} SELECT symbol, date, 1 / split_ratio AS pre_factor, split_ratio AS post_factor FROM raw WHERE split_ratio > 0",
    "wn_09_cumulative_split": f"""WITH {RAW} SELECT symbol, date,
  round(exp(sum(ln(coalesce(nullif(split_ratio, 0), 1))) OVER (PARTITION BY symbol ORDER BY date)), 6) AS cum_split FROM raw""",
    "wn_11_rolling": f"""WITH {BARS} SELECT symbol, date, {", ".join(f"round({full(f, 'close', 10)}, 4) AS {n}_10" for n, f in (("avg", "avg"), ("std", "stddev_samp"), ("sum", "sum"), ("max", "max"), ("min", "min")))}
  FROM bars WINDOW {frames(10)}""",
    "wn_13_running": f"WITH {BARS} SELECT symbol, date, (sum(volume) OVER w)::BIGINT AS cum_volume, max(close) OVER w AS cum_max FROM bars {_W}",
    "fct_01_market": f"""WITH {BARS}, dim AS (SELECT p_brand AS symbol, min(p_type) AS sector FROM part GROUP BY 1)
  SELECT symbol, strftime(date, '%Y%m%d')::INT AS date_key, sector, volume, round(close, 6) AS close,
  {", ".join(f"round(close / nullif(lag(close, {k}) OVER w, 0) - 1, 6) AS return_{k}d" for k in (1, 5, 21, 63, 252))} FROM bars LEFT JOIN dim USING (symbol) {_W}""",
    "ag_11_monthly": f"""WITH {BARS} SELECT symbol, date_trunc('month', date)::DATE AS month, round(avg(close), 4) AS avg_close, count(*) AS sessions,
  max(date) AS last_session FROM bars GROUP BY ALL""",
    "jn_17_benchmark_columns": f"""WITH {BARS}, c AS (SELECT symbol, date, 100 * (close / nullif(lag(close, 21) OVER w, 0) - 1) AS c, max(date) OVER (PARTITION BY symbol) AS last FROM bars {_W}),
  t AS (SELECT symbol, c FROM c WHERE date = last)
  SELECT symbol, round(c, 4) AS change_30d_pct, round((SELECT c FROM t WHERE symbol = '{SPY}'), 4) AS spy_change_30d,
  round((SELECT c FROM t WHERE symbol = '{QQQ}'), 4) AS qqq_change_30d FROM t""",
}
