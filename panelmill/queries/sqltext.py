"""Shared parts of the checking SQL: common table expressions over the given tables, in DuckDB's dialect."""

LINES = "lines AS (SELECT *, l_extendedprice / l_quantity * 0.91371693::DOUBLE AS px FROM lineitem JOIN part ON l_partkey = p_partkey)"
BARS = (
    LINES
    + """,
bars AS (SELECT p_brand AS symbol, l_shipdate::DATE AS date, first(px ORDER BY l_orderkey, l_linenumber, px) AS open, max(px) AS high,
  min(px) AS low, last(px ORDER BY l_orderkey, l_linenumber, px) AS close, sum(l_quantity)::BIGINT AS volume FROM lines GROUP BY ALL)"""
)
RAW = (
    BARS
    + """,
raw AS (SELECT *, CASE WHEN (date - DATE '1970-01-01') % 180 = 0 THEN close * 0.01 ELSE 0.0 END::DOUBLE AS dividend,
  CASE WHEN (date - DATE '1970-01-01') % 700 = 0 THEN 2.0 ELSE 0.0 END::DOUBLE AS split_ratio FROM bars)"""
)
ADJUSTED = (
    RAW
    + """,
pd AS (SELECT *, 1 - coalesce(dividend / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0), 0) AS paid FROM raw),
day AS (SELECT *, CASE WHEN paid > 0 THEN paid ELSE 1 END / coalesce(nullif(split_ratio, 0), 1) AS f FROM pd),
fac AS (SELECT *, coalesce(exp(sum(ln(f)) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)), 1) AS adj_factor FROM day),
adjusted AS (SELECT *, open * adj_factor AS adj_open, high * adj_factor AS adj_high, low * adj_factor AS adj_low, close * adj_factor AS adj_close FROM fac)"""
)


def full(f: str, c: str, n: int) -> str:
    return f"CASE WHEN count({c}) OVER r{n} = {n} THEN {f}({c}) OVER r{n} END"


def frames(*rows: int) -> str:
    return ", ".join(f"r{n} AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in rows)


SIGNALS = (
    BARS
    + f""",
s0 AS (SELECT *, row_number() OVER w AS rn, close - lag(close) OVER w AS d, (high + low + close) / 3 AS tp,
  greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)),
s1 AS (SELECT *, CASE WHEN d > 0 THEN d WHEN d IS NOT NULL THEN 0 END AS g, CASE WHEN d < 0 THEN -d WHEN d IS NOT NULL THEN 0 END AS l,
  CASE WHEN tp > lag(tp) OVER w THEN tp * volume ELSE 0 END AS up, CASE WHEN tp < lag(tp) OVER w THEN tp * volume ELSE 0 END AS dn
  FROM s0 WINDOW w AS (PARTITION BY symbol ORDER BY date)),
e AS (SELECT symbol, rn, close AS c12, close AS c26, close AS e50, close AS e200, tr AS atr, g AS eg, l AS el, 0.0::DOUBLE AS sig FROM s1 WHERE rn = 1
  UNION ALL SELECT s1.symbol, s1.rn, e.c12 * (1 - 2.0 / 13) + s1.close * 2.0 / 13, e.c26 * (1 - 2.0 / 27) + s1.close * 2.0 / 27,
  e.e50 * (1 - 2.0 / 51) + s1.close * 2.0 / 51, e.e200 * (1 - 2.0 / 201) + s1.close * 2.0 / 201, e.atr * (1 - 1.0 / 14) + s1.tr / 14,
  coalesce(e.eg * (1 - 1.0 / 14) + s1.g / 14, s1.g), coalesce(e.el * (1 - 1.0 / 14) + s1.l / 14, s1.l),
  e.sig * 0.8 + 0.2 * ((e.c12 * (1 - 2.0 / 13) + s1.close * 2.0 / 13) - (e.c26 * (1 - 2.0 / 27) + s1.close * 2.0 / 27))
  FROM e JOIN s1 ON s1.symbol = e.symbol AND s1.rn = e.rn + 1),
s2 AS (SELECT s1.*, e.c12 - e.c26 AS macd, e.sig AS macd_signal_line, e.e50 AS ema_50, e.e200 AS ema_200, e.atr AS atr_14d,
  CASE WHEN eg = 0 THEN 0 WHEN el = 0 THEN 100 ELSE 100 - 100 / (1 + eg / el) END AS rsi FROM s1 JOIN e USING (symbol, rn)),
s3 AS (SELECT *, macd - macd_signal_line AS macd_histogram, {full("avg", "close", 20)} AS mid, {full("stddev_samp", "close", 20)} AS dev,
  {full("sum", "up", 14)} AS su, {full("sum", "dn", 14)} AS sd, {full("avg", "close", 50)} AS ma_50, {full("avg", "close", 200)} AS ma_200,
  sum(sign(d) * volume) OVER (PARTITION BY symbol ORDER BY date) AS obv, d AS last_day_change_abs,
  100 * (close / nullif(lag(close) OVER w, 0) - 1) AS last_day_change_pct, 100 * (close / nullif(lag(close, 21) OVER w, 0) - 1) AS change_30d_pct,
  100 * (close / nullif(lag(close, 63) OVER w, 0) - 1) AS change_90d_pct, 100 * (close / nullif(lag(close, 252) OVER w, 0) - 1) AS change_365d_pct
  FROM s2 WINDOW w AS (PARTITION BY symbol ORDER BY date), {frames(14, 20, 50, 200)}),
signals AS (SELECT symbol, date AS as_of_date, close AS last_closing_price, macd, macd_signal_line, macd_histogram, rsi, ema_50, ema_200, atr_14d,
  mid + 2 * dev AS bollinger_upper, mid - 2 * dev AS bollinger_lower, (close - (mid - 2 * dev)) / nullif(4 * dev, 0) AS bollinger_pct_b,
  4 * dev / nullif(mid, 0) AS bollinger_bandwidth, obv, CASE WHEN su = 0 THEN 0 WHEN sd = 0 THEN 100 ELSE 100 - 100 / (1 + su / sd) END AS mfi,
  ma_50, ma_200, last_day_change_abs, last_day_change_pct, change_30d_pct, change_90d_pct, change_365d_pct,
  CASE WHEN macd > macd_signal_line AND rsi < 70 THEN 'Buy' WHEN macd < macd_signal_line AND rsi > 30 THEN 'Sell' ELSE 'Hold' END AS trade_signal
  FROM s3 WHERE rn > 200)"""
)


def rounded(columns: str, digits: int = 4) -> str:
    """``a, b`` as ``round(a, digits) AS a, ...``."""
    return ", ".join(f"round({c.strip()}, {digits}) AS {c.strip()}" for c in columns.split(","))
