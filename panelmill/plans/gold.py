"""Serving tables made of scored signals: ranking, alerts, comparison, buckets, one wide table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import on_latest
from ..operators.windows import series
from .quality import freshness
from .scoring import component_percentiles, ranked

#: What a snapshot keeps of a recommendation.
SNAPSHOT = (
    "symbol", "as_of_date", "composite_score", "composite_rank", "momentum_pct", "value_pct", "risk_pct", "quality_pct", "last_closing_price", "trade_signal",
)


def watchlist(signals: DataFrame) -> DataFrame:
    """The latest date's symbols, scored and ranked."""
    return ranked(component_percentiles(on_latest(signals, "as_of_date")))


def gate(latest: DataFrame, expected: DataFrame, best: DataFrame, session: Column, depth: int = 20, most: float = 0.02) -> DataFrame:
    """``freshness`` of every ``expected(symbol)`` before anything is recorded: the ``depth`` best of a watchlist are critical.

    ``latest(symbol, last_date)`` has the symbols with rows at all; expected ones that it lacks are stale.
    """
    top = best.filter(F.col("composite_rank") <= depth).select("symbol").distinct().withColumn("_top", F.lit(True))
    asked = expected.select("symbol").distinct().join(top, "symbol", "left")
    return freshness(latest, asked.select("symbol", F.coalesce("_top", F.lit(False)).alias("critical")), session, most)


def snapshot(best: DataFrame, gated: DataFrame, version: str, run_id: str) -> DataFrame:
    """The rows of a watchlist to record (``commits.first_write`` keeps the first of an as_of_date and version).

    Rows of ``gated`` whose status is error make the snapshot fail when it is read, so that no day is recorded on stale data.
    """
    rows = best.select(*SNAPSHOT, F.lit(version).alias("methodology_version"), F.lit(run_id).alias("_run_id"))
    stale = gated.filter("status = 'error'").agg(F.count("*").alias("_stale"))
    failed = F.raise_error(F.concat(F.col("_stale").cast("string"), F.lit(" symbols are stale; nothing is recorded"))).cast("boolean")
    return rows.crossJoin(F.broadcast(stale)).filter(F.when(F.col("_stale") > 0, failed).otherwise(True)).drop("_stale")


def alerts(signals: DataFrame, latest_only: bool = True, squeeze_days: int = 126) -> DataFrame:
    """``symbol, as_of_date, alert_type, alert_value``, all kinds in one pass: each row explodes into the alerts it raises.

    For the latest alerts a symbol's windows end at its own newest date, and of those rows, one a symbol, the newest date's
    stay; only crossovers of all dates need that date beforehand, from a second reading.
    """
    if latest_only:
        s = signals.withColumn("_until", F.max("as_of_date").over(Window.partitionBy("symbol")))
    else:
        s = signals.join(F.broadcast(signals.agg(F.max("as_of_date").alias("_until"))))
    now = F.col("as_of_date") == F.col("_until")
    recent = (F.col("as_of_date") >= F.date_sub("_until", squeeze_days)) & F.col("bollinger_bandwidth").isNotNull()
    narrow = F.percent_rank().over(Window.partitionBy("symbol", recent).orderBy("bollinger_bandwidth"))
    s = s.withColumns(
        {
            "_hist": F.lag("macd_histogram").over(series(order="as_of_date")), "_close": F.lag("last_closing_price").over(series(order="as_of_date")), "_ma": F.lag("ma_200").over(series(order="as_of_date")), "_narrow": F.when(recent, narrow),
        }
    )
    s = on_latest(s.filter(now), "as_of_date") if latest_only else s
    crossed = F.col("_hist").isNotNull() & (F.signum("macd_histogram") != F.signum("_hist"))
    price, ma = F.col("last_closing_price"), F.col("ma_200")
    kinds = [
        (now & (F.col("rsi") < 30), "RSI_OVERSOLD", "rsi"),
        (now & (F.col("rsi") > 70), "RSI_OVERBOUGHT", "rsi"),
        (crossed & now if latest_only else crossed, "MACD_CROSSOVER", "macd_histogram"),
        (now & (F.col("_narrow") <= 0.10), "BOLLINGER_SQUEEZE", "bollinger_bandwidth"),
        (now & (price > ma) & (F.col("_close") <= F.col("_ma")), "MA200_CROSS_ABOVE", "last_closing_price"),
        (now & (price < ma) & (F.col("_close") >= F.col("_ma")), "MA200_CROSS_BELOW", "last_closing_price"),
        (now & F.col("dividend_yield_trap"), "DIVIDEND_YIELD_TRAP", "dividend_yield_gap"),
    ]
    made = F.array(*(F.when(c, F.struct(F.lit(n).alias("alert_type"), F.col(v).alias("alert_value"))) for c, n, v in kinds))
    return s.select("symbol", "as_of_date", F.explode(F.array_compact(made)).alias("a")).select("symbol", "as_of_date", "a.*")


def benchmark_compare(signals: DataFrame, spy: str, qqq: str) -> DataFrame:
    """The latest changes beside the two benchmarks'; one aggregate row is joined, so rows never multiply."""
    latest = on_latest(signals, "as_of_date")
    changes = {"30d": "change_30d_pct", "90d": "change_90d_pct", "365d": "change_365d_pct"}
    one = latest.agg(
        *(F.coalesce(F.max(F.when(F.col("symbol") == s, F.col(c))), F.lit(0.0)).alias(f"{n}_change_{k}") for n, s in (("spy", spy), ("qqq", qqq)) for k, c in changes.items())
    )
    rows = latest.filter(~F.col("symbol").isin(spy, qqq)).select("symbol", "as_of_date", "last_closing_price", *changes.values())
    return rows.crossJoin(F.broadcast(one))


def portfolio_candidates(signals: DataFrame) -> DataFrame:
    """Buckets of the latest date, first match wins; the quarter of narrowest bands is exact."""
    latest = on_latest(signals, "as_of_date")
    quarter = latest.agg(F.percentile("bollinger_bandwidth", F.lit(0.25)).alias("_q"))
    label = (
        F.when(F.col("change_30d_pct") > 5, "top_momentum").when(F.col("rsi") < 30, "oversold")
        .when((F.col("pe_ratio") < 15) & (F.col("dividend_yield") > 0.02), "value_dividend").when(F.col("bollinger_bandwidth") < F.col("_q"), "low_volatility")
        .otherwise("watch")
    )
    tagged = latest.crossJoin(F.broadcast(quarter)).withColumn("candidate_bucket", label)
    return tagged.filter("candidate_bucket <> 'watch'").select(
        "symbol", "as_of_date", "last_closing_price", "rsi", "pe_ratio", "dividend_yield", "change_30d_pct", "candidate_bucket"
    )


def daily_analytics(signals: DataFrame, prices: DataFrame, securities: DataFrame) -> DataFrame:
    """One wide row per symbol and date: signals, prices, profile, percentiles of the date and composite."""
    p = prices.select("symbol", F.col("date").alias("as_of_date"), "open", "high", "low", "close", "volume")
    joined = signals.join(p, ["symbol", "as_of_date"], "left").join(securities.select("symbol", "sector", "industry"), "symbol", "left")
    return ranked(component_percentiles(joined)).drop("composite_rank")
