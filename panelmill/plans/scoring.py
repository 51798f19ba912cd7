"""Cross-sectional scores: component percentiles per date, composites, ranks, universes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import checked_expression
from ..operators.quantiles import global_ranks
from ..operators.windows import latest_per_key, pct_rank
from ..sources.sinks import stored

COMPONENTS = ("momentum_pct", "value_pct", "risk_pct", "quality_pct")


def component_percentiles(df: DataFrame, by: str = "as_of_date") -> DataFrame:
    """Four percentiles per date, the best row 1.0: momentum, price/earnings, RSI and money flow; missing is neutral or worst."""
    w = Window.partitionBy(by)
    pe = F.coalesce(F.when(F.col("pe_ratio") > 0, F.col("pe_ratio")), F.lit(999.0))
    return df.withColumns(
        {
            "momentum_pct": F.percent_rank().over(w.orderBy(F.coalesce("change_30d_pct", F.lit(0.0)).asc())),
            "value_pct": F.percent_rank().over(w.orderBy(pe.desc())),
            "risk_pct": F.percent_rank().over(w.orderBy(F.coalesce("rsi", F.lit(50.0)).desc())),
            "quality_pct": F.percent_rank().over(w.orderBy(F.coalesce("mfi", F.lit(50.0)).asc())),
        }
    )


def composite(df: DataFrame, components: Sequence[str] = COMPONENTS, weights: Sequence[float] | None = None) -> Column:
    """Weighted mean of the percentiles, a missing one 0.5."""
    weights = weights or [1.0] * len(components)
    total = sum(weights)
    out = F.lit(0.0)
    for c, x in zip(components, weights, strict=True):
        out = out + F.coalesce(F.col(c), F.lit(0.5)) * (x / total)
    return out


def ranked(df: DataFrame, by: str = "as_of_date", digits: int = 9) -> DataFrame:
    """With composite score and rank per date. The score is rounded so that equal sums tie in any order of addition."""
    df = df.withColumn("composite_score", F.round(composite(df), digits))
    return df.withColumn("composite_rank", F.rank().over(Window.partitionBy(by).orderBy(F.col("composite_score").desc())))


def variant_scores(signals: DataFrame, variant: dict[str, tuple[str, bool, float]], by: str = "as_of_date") -> DataFrame:
    """``symbol, as_of_date, <component>..., score`` of a scoring defined as data: name to (expression, higher is better, weight).

    Rows are ranked among those that have the component; a missing one counts 0.5.
    """
    df = signals.select("symbol", by, *(checked_expression(n, e) for n, (e, _, _) in variant.items()))
    pct = {f"{n}_pct": pct_rank(F.col(n), [by], up) for n, (_, up, _) in variant.items()}
    df = df.withColumns(pct)
    score = composite(df, list(pct), [x for _, _, x in variant.values()])
    return df.select("symbol", by, *pct, F.round(score, 9).alias("score"))


def month_ends(dates: DataFrame, date: str = "as_of_date") -> DataFrame:
    """The last date of each month."""
    return dates.groupBy(F.date_trunc("month", F.col(date)).alias("_m")).agg(F.max(date).alias(date)).drop("_m")


def dollar_volume_rank(prices: DataFrame, top: int) -> DataFrame:
    """``symbol, dollar_volume, rank`` of the ``top`` symbols by median dollar volume over 63 sessions."""
    w = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    recent = prices.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 63")
    medians = recent.groupBy("symbol").agg(F.median(F.col("close") * F.col("volume")).alias("dollar_volume"))
    placed = global_ranks(stored(medians, "medians"), F.col("dollar_volume"), ascending=False)
    return placed.select("symbol", "dollar_volume", F.col("global_rank").cast("int").alias("rank")).orderBy("rank", "symbol").limit(top)


def members_at(events: DataFrame, at: Column | None = None) -> DataFrame:
    """``tier, symbol`` whose enter and exit events up to ``at`` leave them in."""
    past = events if at is None else events.filter(F.col("event_ts") <= at)
    net = past.groupBy("tier", "symbol").agg(F.sum(F.when(F.col("action") == "enter", 1).otherwise(-1)).alias("net"))
    return net.filter("net > 0").drop("net")


def membership_events(members: DataFrame, top: DataFrame) -> DataFrame:
    """``symbol, action, rank_at_event`` that turn ``members`` into ``top(symbol, rank)``: two anti-joins."""
    enter = top.join(members, "symbol", "left_anti").select("symbol", F.lit("enter").alias("action"), F.col("rank").cast("int").alias("rank_at_event"))
    leave = members.join(top, "symbol", "left_anti").select("symbol", F.lit("exit").alias("action"), F.lit(None).cast("int").alias("rank_at_event"))
    return enter.unionByName(leave)


def line_of_sight(prices: DataFrame, tags: DataFrame, floors: tuple[float, float, float, float, float] = (5.0, 1e6, 0.9, 0.0, 1.0)) -> DataFrame:
    """Every symbol with momentum (12-1), returns, dollar volume and its acceleration, and flags for decline and emergence.

    ``tags(symbol, is_watchlist, is_held, is_top_n)``. ``floors``: price, dollar volume, percentile, momentum, acceleration.
    """
    price, dollars, percentile, momentum, acceleration = floors
    w = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    o = prices.withColumn("dv", F.col("close") * F.col("volume")).withColumn("rn", F.row_number().over(w)).filter("rn <= 252")
    at = lambda k, c="close": F.max(F.when(F.col("rn") == k, F.col(c)))
    over = lambda a, b: F.try_divide(at(a), at(b)) - 1
    med = lambda k: F.median(F.when(F.col("rn") <= k, F.col("dv")))
    s = o.groupBy("symbol").agg(
        at(1, "date").alias("as_of_date"), at(1).alias("close"), over(21, 252).alias("mom_12_1"), over(1, 63).alias("ret_3m"), over(1, 126).alias("ret_6m"),
        over(1, 252).alias("ret_12m"), med(63).alias("dollar_volume_63d"), F.try_divide(med(21), med(252)).alias("dv_acceleration"),
    )
    s = s.join(tags, "symbol", "left")
    s = stored(s, "sight")
    for name, of in (("mom_pct", "mom_12_1"), ("dv_accel_pct", "dv_acceleration")):
        s = global_ranks(s, F.col(of), nulls_first=True).withColumnRenamed("global_percent_rank", name).drop("global_rank")
    flags = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("is_watchlist", "is_held", "is_top_n")}
    s = s.withColumns(flags)
    falling = (F.col("ret_3m") < 0) & (F.col("ret_6m") < 0) & (F.col("ret_12m") < 0)
    s = s.withColumn("deteriorating", F.coalesce(falling, F.lit(False)))
    rising = (F.col("mom_pct") >= percentile) & (F.col("mom_12_1") > momentum) & (F.col("dv_accel_pct") >= percentile) & (F.col("dv_acceleration") > acceleration)
    emerging = ~F.col("is_top_n") & (F.col("close") >= price) & (F.col("dollar_volume_63d") >= dollars) & rising
    return s.withColumn("emerging", F.coalesce(emerging, F.lit(False)))


def round_scores(candidates: DataFrame, benchmarks: Sequence[str], sic: DataFrame, non_operating: Sequence[str]) -> DataFrame:
    """Scores of a round: benchmarks, funds and non-operating companies go before anything is ranked."""
    out = candidates.filter(~F.col("symbol").isin(*benchmarks))
    barred = sic.filter(F.col("sic").isin(*non_operating) | (F.col("quote_type") == "ETF")).select("symbol")
    out = out.join(barred, "symbol", "left_anti")
    parts = ("earnings_yield", "gross_profitability", "roe")
    out = out.withColumns({f"{c}_pct": pct_rank(F.col(c), ["as_of_date"]) for c in parts})
    out = out.withColumn("score", F.round(composite(out, [f"{c}_pct" for c in parts]), 9))
    w = Window.partitionBy("as_of_date")
    return out.select(
        "symbol", "as_of_date", *(f"{c}_pct" for c in parts), "score", F.rank().over(w.orderBy(F.col("score").desc())).alias("rank"),
        F.percent_rank().over(w.orderBy("score")).alias("score_percentile"),
    )


def latest_price(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """``symbol, close``: the newest close of the first source, of the second where the first has none."""
    newest = lambda p, n: latest_per_key(p, ["symbol"], F.col("date").desc()).select("symbol", F.col("close").alias(n))
    both = newest(primary, "a").join(newest(secondary, "b"), "symbol", "full_outer")
    return both.select("symbol", F.coalesce("a", "b").alias("close"))
