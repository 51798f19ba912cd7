"""Technical indicators as columns over (symbol, date): ``add`` functions take prices and return them with more columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ema import emas
from ..operators.windows import change, product_after, rolling, series

# Rows of the windows of each family of keys.
CHANGE_ROWS = (2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 30, 60, 90, 180, 365, 730, 1095, 1460, 1825, 3650)
HIGH_LOW_ROWS = (3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 21, 30, 60, 90, 180, 365, 730, 1095, 1460, 1825, 3650)
SMA_ROWS = (3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 21, 30, 40, 50, 60, 100, 200, 300)
VOLUME_ROWS = (3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 21, 30, 40, 50, 60, 90)
ATR_ROWS = (2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 21, 30, 60, 90, 180)


def adjusted(prices: DataFrame) -> DataFrame:
    """``prices(open, high, low, close, dividend, split_ratio, ...)`` with ``adj_factor`` and back-adjusted prices.

    A row's factor is the product over later rows of (1 - dividend / close before) / split; the last row's is 1. A
    dividend of the whole close or more is an error of the source and ignored.
    """
    split = F.coalesce(F.nullif("split_ratio", F.lit(0.0)), F.lit(1.0))
    paid = 1 - F.coalesce(F.try_divide(F.col("dividend"), F.lag("close").over(series())), F.lit(0.0))
    out = prices.withColumn("_day", F.when(paid > 0, paid).otherwise(1.0) / split)
    out = out.withColumn("adj_factor", product_after(F.col("_day"), series())).drop("_day")
    return out.withColumns({f"adj_{c}": F.col(c) * F.col("adj_factor") for c in ("open", "high", "low", "close")})


def with_changes(p: DataFrame) -> DataFrame:
    """Day, month, quarter and year changes: over 1, 21, 63 and 252 rows, in percent."""
    return p.withColumns(
        {
            "last_day_change_abs": F.col("close") - F.lag("close").over(series()),
            "last_day_change_pct": change("close", 1, series()) * 100,
            "change_30d_pct": change("close", 21, series()) * 100,
            "change_90d_pct": change("close", 63, series()) * 100,
            "change_365d_pct": change("close", 252, series()) * 100,
        }
    )


def change_over(days: int) -> tuple[Column, Column]:
    """Absolute and percent change of the scalar form: against the row ``days - 1`` before."""
    was = F.lag("close", days - 1).over(series())
    return F.col("close") - F.nullif(was, F.lit(0.0)), F.try_divide(F.col("close") - was, was) * 100


def with_bollinger(p: DataFrame, rows: int = 20, width: float = 2.0) -> DataFrame:
    mid, dev = rolling(F.avg, "close", rows, series()), rolling(F.stddev_samp, "close", rows, series())
    p = p.withColumn("_mid", mid).withColumn("_dev", dev)
    p = p.withColumn("bollinger_upper", F.col("_mid") + width * F.col("_dev")).withColumn("bollinger_lower", F.col("_mid") - width * F.col("_dev"))
    span = F.col("bollinger_upper") - F.col("bollinger_lower")
    return p.withColumn("bollinger_pct_b", F.try_divide(F.col("close") - F.col("bollinger_lower"), span)).withColumn(
        "bollinger_bandwidth", F.try_divide(span, F.col("_mid"))
    ).drop("_mid", "_dev")


def with_volume(p: DataFrame) -> DataFrame:
    """On-balance volume and money flow index (14); a flat series has flow index 0."""
    diff = F.col("close") - F.lag("close").over(series())
    tp = (F.col("high") + F.col("low") + F.col("close")) / 3
    p = p.withColumn("_tp", tp).withColumn("_step", F.signum(diff) * F.col("volume"))
    move = F.col("_tp") - F.lag("_tp").over(series())
    flow = F.col("_tp") * F.col("volume")
    p = p.withColumn("_up", F.when(move > 0, flow).otherwise(0.0)).withColumn("_down", F.when(move < 0, flow).otherwise(0.0))
    p = p.withColumn("obv", F.sum("_step").over(series().rowsBetween(Window.unboundedPreceding, 0)))
    up, down = rolling(F.sum, "_up", 14, series()), rolling(F.sum, "_down", 14, series())
    p = p.withColumn("_u", up).withColumn("_d", down)
    mfi = F.when(F.col("_u") == 0, 0.0).when(F.col("_d") == 0, 100.0).otherwise(100 - 100 / (1 + F.try_divide(F.col("_u"), F.col("_d"))))
    return p.withColumn("mfi", F.when(F.col("_u").isNotNull(), mfi)).drop("_tp", "_step", "_up", "_down", "_u", "_d")


def with_averages(p: DataFrame, rows: tuple[int, ...] = (50, 200)) -> DataFrame:
    return p.withColumns({f"ma_{n}": rolling(F.avg, "close", n, series()) for n in rows})


def true_range() -> Column:
    before = F.lag("close").over(series())
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def with_recursive(p: DataFrame, atr_rows: tuple[int, ...] = (14,)) -> DataFrame:
    """RSI (14), MACD (12, 26, 9), exponential means (50, 200) and average true ranges, in two block scans."""
    diff = F.col("close") - F.lag("close").over(series())
    p = p.withColumn("_diff", diff).withColumn("_tr", true_range())
    p = p.withColumn("_gain", F.greatest("_diff", F.lit(0.0))).withColumn("_loss", F.greatest(-F.col("_diff"), F.lit(0.0)))
    p = p.withColumn("_gain", F.when(F.col("_diff").isNotNull(), F.col("_gain"))).withColumn("_loss", F.when(F.col("_diff").isNotNull(), F.col("_loss")))
    specs = {
        "_g": ("_gain", 1 / 14), "_l": ("_loss", 1 / 14), "_fast": ("close", 2 / 13), "_slow": ("close", 2 / 27),
        "ema_50": ("close", 2 / 51), "ema_200": ("close", 2 / 201),
    } | {f"atr_{n}d": ("_tr", 1 / n) for n in atr_rows}
    p = emas(p, specs).withColumn("macd", F.col("_fast") - F.col("_slow"))
    p = emas(p, {"macd_signal_line": ("macd", 2 / 10)}).withColumn("macd_histogram", F.col("macd") - F.col("macd_signal_line"))
    rsi = F.when(F.col("_g") == 0, 0.0).when(F.col("_l") == 0, 100.0).otherwise(100 - 100 / (1 + F.try_divide(F.col("_g"), F.col("_l"))))
    p = p.withColumn("rsi", F.when(F.col("_g").isNotNull(), rsi))
    return p.drop("_diff", "_tr", "_gain", "_loss", "_g", "_l", "_fast", "_slow")


def trade_signal() -> Column:
    up = F.col("macd") > F.col("macd_signal_line")
    down = F.col("macd") < F.col("macd_signal_line")
    return F.when(up & (F.col("rsi") < 70), "Buy").when(down & (F.col("rsi") > 30), "Sell").otherwise("Hold")


def with_risk(p: DataFrame, rows: int = 252, risk_free: float = 0.0) -> DataFrame:
    """Sharpe and Sortino ratios over ``rows`` daily returns; no downside gives NULL and ``no_downside``."""
    p = p.withColumn("ret", change("close", 1, series()))
    mean, dev = rolling(F.avg, "ret", rows, series()), rolling(F.stddev_samp, "ret", rows, series())
    frame = series().rowsBetween(-(rows - 1), 0)
    bad = F.when(F.col("ret") < risk_free / 252, F.col("ret"))
    p = p.withColumn("_mean", mean).withColumn("_dev", dev).withColumn("_bad", F.stddev_samp(bad).over(frame)).withColumn("_n", F.count(bad).over(frame))
    excess = F.col("_mean") * 252 - risk_free
    p = p.withColumn("sharpe", F.try_divide(excess, F.nullif(F.col("_dev"), F.lit(0.0)) * F.sqrt(F.lit(252.0))))
    p = p.withColumn("sortino", F.when(F.col("_mean").isNotNull(), F.try_divide(excess, F.col("_bad") * F.sqrt(F.lit(252.0)))))
    return p.withColumn("no_downside", F.col("_mean").isNotNull() & (F.col("_n") == 0)).drop("_mean", "_dev", "_bad", "_n")


def last_rows(p: DataFrame, rows: int) -> DataFrame:
    """The last ``rows`` rows of each symbol."""
    w = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    return p.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= rows).drop("_rn")


def max_drawdown(p: DataFrame, rows: int = 252) -> DataFrame:
    """``symbol, max_drawdown``: the deepest fall below the running maximum within the last ``rows`` rows."""
    tail = last_rows(p, rows)
    top = F.max("close").over(series().rowsBetween(Window.unboundedPreceding, 0))
    return tail.withColumn("_dd", F.col("close") / top - 1).groupBy("symbol").agg(F.min("_dd").alias("max_drawdown"))


def beta(p: DataFrame, benchmark: str, rows: int = 252, least: int = 20) -> DataFrame:
    """``symbol, beta`` of the last ``rows`` daily returns that the benchmark has too, aligned by date."""
    r = p.withColumn("r", change("close", 1, series())).select("symbol", "date", "r").filter("r is not null")
    b = r.filter(F.col("symbol") == benchmark).select("date", F.col("r").alias("b"))
    both = last_rows(r.join(b, "date"), rows)
    return both.groupBy("symbol").agg(
        F.when(F.count("*") >= least, F.try_divide(F.covar_samp("r", "b"), F.var_samp("b"))).alias("beta")
    )


def signal_series(prices: DataFrame, warm_up: int = 200) -> DataFrame:
    """Every indicator for every session after a symbol's first ``warm_up`` rows."""
    p = with_changes(with_averages(with_volume(with_bollinger(with_recursive(prices)))))
    p = p.withColumn("trade_signal", trade_signal()).withColumn("_rn", F.row_number().over(series()))
    p = p.filter(F.col("_rn") > warm_up).drop("_rn")
    return p.withColumn("as_of_date", F.col("date")).withColumn("last_closing_price", F.col("close")).drop("date", "open", "high", "low", "close", "volume")


#: Keys of the latest row that come from the series as they are.
_SERIES_KEYS = (
    "rsi", "macd", "macd_signal_line", "macd_histogram", "bollinger_upper", "bollinger_lower", "bollinger_pct_b", "bollinger_bandwidth",
    "obv", "mfi", "ema_50", "ema_200",
)
FUNDAMENTAL_KEYS = ("eps", "pe_ratio", "forward_eps", "forward_pe", "dividend_yield", "dividend_yield_gap", "dividend_yield_trap")


def signal_row(prices: DataFrame, quoted: DataFrame | None = None) -> DataFrame:
    """The latest session's row of every symbol with all keys of all windows; what is missing is NULL, never absent.

    Rows are numbered back from the latest, and each key is a conditional aggregate over the rows that its window holds, so
    no window slides. ``quoted(symbol, ...)`` may bring any of ``FUNDAMENTAL_KEYS``; those it lacks are NULL.
    """
    p = with_volume(with_bollinger(with_recursive(prices, ATR_ROWS))).withColumn("trade_signal", trade_signal())
    back = F.row_number().over(Window.partitionBy("symbol").orderBy(F.col("date").desc()))
    p = p.withColumn("_back", back).withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy("symbol")))
    at = lambda c, n=1: F.max(F.when(F.col("_back") == n, F.col(c)))

    def over(fn, c: str, n: int) -> Column:
        inside = F.when(F.col("_back") <= n, F.col(c))
        return F.when(F.count(inside) == n, fn(inside))

    keys = {"date": at("date"), "last_closing_price": at("close"), "last_opening_price": at("open"), "trade_signal": at("trade_signal")} | {c: at(c) for c in _SERIES_KEYS}
    for name, n in (("last_day_change", 2), *((f"change_{n}d", n) for n in CHANGE_ROWS)):
        keys |= {f"{name}_abs": at("close") - F.nullif(at("close", n), F.lit(0.0)), f"{name}_pct": F.try_divide(at("close") - at("close", n), at("close", n)) * 100}
    for n in HIGH_LOW_ROWS:
        keys |= {f"high_{n}d": over(F.max, "high", n), f"low_{n}d": over(F.min, "low", n)}
    keys |= {f"ma_{n}": over(F.avg, "close", n) for n in SMA_ROWS} | {f"vol_trend_{n}d": over(F.avg, "volume", n) for n in VOLUME_ROWS}
    keys |= {f"atr_{n}d": F.when(F.max("_rows") > n, at(f"atr_{n}d")) for n in ATR_ROWS}
    out = p.filter(F.col("_back") <= max(*CHANGE_ROWS, *HIGH_LOW_ROWS)).groupBy("symbol").agg(*(v.alias(k) for k, v in keys.items()))
    given = [c for c in FUNDAMENTAL_KEYS if quoted is not None and c in quoted.columns]
    out = out.join(quoted.select("symbol", *given), "symbol", "left") if given else out
    return out.withColumns({c: F.lit(None).cast("boolean" if c.endswith("trap") else "double") for c in FUNDAMENTAL_KEYS if c not in given})
