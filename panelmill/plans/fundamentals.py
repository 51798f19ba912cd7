"""Point-in-time fundamentals: which tag stands for a concept, what was known when, and ratios of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import div, finite
from ..operators.joins import asof_left
from ..operators.windows import latest_per_key

# Taxonomy and tags of each concept, preferred first.
CONCEPTS = {
    "net_income": ("us-gaap", "NetIncomeLoss"),
    "gross_profit": ("us-gaap", "GrossProfit"),
    "revenues": ("us-gaap", "RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "SalesRevenueNet"),
    "cost_of_revenue": ("us-gaap", "CostOfRevenue", "CostOfGoodsAndServicesSold", "CostOfGoodsSold"),
    "assets": ("us-gaap", "Assets"),
    "equity": ("us-gaap", "StockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"),
    "shares_outstanding": ("dei", "EntityCommonStockSharesOutstanding"),
}
# Industry codes of commodity trusts, investment offices, blank checks and other investors.
NON_OPERATING_SIC = ("6221", "6726", "6770", "6799")
STALE_DAYS = 400
# What a quote service gives directly, where it does.
QUOTED = ("trailing_eps", "trailing_pe", "dividend_yield", "dividend_rate", "five_year_avg_yield")
# What only a quote service gives: expected earnings, and the price by them.
FORWARD = ("forward_eps", "forward_pe")


def concepts(facts: DataFrame) -> DataFrame:
    """Annual facts by concept: one tag per (symbol, concept, period end, filing), the preferred one."""
    spark = facts.sparkSession
    listed = [(c, taxonomy, t, i) for c, (taxonomy, *tags) in CONCEPTS.items() for i, t in enumerate(tags)]
    names = spark.createDataFrame(listed, "concept string, taxonomy string, tag string, priority int")
    form = F.col("form")
    annual = form.startswith("10-K") | form.startswith("20-F") | form.startswith("40-F")
    days = F.datediff("end_date", "start_date")
    rows = facts.filter(annual & (F.col("fiscal_period") == "FY") & (F.col("start_date").isNull() | days.between(300, 400)))
    rows = rows.join(F.broadcast(names), ["taxonomy", "tag"])  # a row per tag of the list above
    out = latest_per_key(rows, ["symbol", "concept", "end_date", "filed"], F.col("priority"))
    return out.select("symbol", "concept", "start_date", "end_date", "value", "filed", "form")


def metrics(silver: DataFrame) -> DataFrame:
    """What was known from each filing date on: per concept the newest period, and of it the latest filing.

    Filings are pivoted, and a running maximum of (period end, filing, value) per concept carries knowledge forward: an
    amendment of an old period never displaces a newer one, and concepts advance independently. No join with itself.
    """
    names = list(CONCEPTS)
    best = silver.groupBy("symbol", "filed").pivot("concept", names).agg(F.max(F.struct("end_date", F.col("filed").alias("seen"), "value")))
    w = Window.partitionBy("symbol").orderBy("filed").rowsBetween(Window.unboundedPreceding, 0)
    known = best.select("symbol", "filed", *(F.max(c).over(w).alias(c) for c in names))
    out = known.select(
        "symbol", "filed", F.col("net_income.end_date").alias("period_end"), F.col("shares_outstanding.end_date").alias("shares_date"),
        *(F.col(f"{c}.value").alias("gross_profit_reported" if c == "gross_profit" else c) for c in names),
    )
    out = out.withColumn("gross_profit", F.coalesce("gross_profit_reported", F.col("revenues") - F.col("cost_of_revenue")))
    return out.withColumn("roe", div(F.col("net_income"), F.col("equity"))).withColumn("gross_profitability", div(F.col("gross_profit"), F.col("assets")))


def with_fundamentals(signals: DataFrame, known: DataFrame) -> DataFrame:
    """Signals with earnings, price/earnings and dividend columns as known on each date.

    ``known`` may have ``QUOTED`` columns. Those are preferred to what is computed: earnings are net income by shares, the
    ratio is the price by earnings, the yield is dividend_rate by price, or 0 without one. A usual yield that is missing or
    0 is dividend_rate by price; without a rate a 0 stays. Where nothing is known yet, the yield is NULL. ``FORWARD`` columns
    that ``known`` has come along as they were known on each date; what isn't a finite number is NULL.
    """
    forward = [c for c in FORWARD if c in known.columns]
    given = [F.col(c).cast("double") if c in known.columns else F.lit(None).cast("double") for c in QUOTED]
    f = known.select(
        "symbol", "filed", "net_income", "shares_outstanding", "roe", "gross_profitability", "revenues", "shares_date",
        *(finite(x).alias(f"_{c}") for x, c in zip(given, QUOTED, strict=True)), *(finite(F.col(c).cast("double")).alias(c) for c in forward),
    )
    out = asof_left(signals, f, ["symbol"], "as_of_date", "filed")
    price = F.col("last_closing_price")
    out = out.withColumn("eps", F.coalesce("_trailing_eps", div(F.col("net_income"), F.col("shares_outstanding"))))
    out = out.withColumn("pe_ratio", F.coalesce("_trailing_pe", div(price, F.col("eps"))))
    paid = F.coalesce("_dividend_yield", div(F.col("_dividend_rate"), price), F.lit(0.0))
    out = out.withColumn("dividend_yield", F.when(F.col("filed").isNotNull(), paid))
    by_rate = F.when(price > 0, F.col("_dividend_rate") / price)
    usual = F.coalesce(F.nullif("_five_year_avg_yield", F.lit(0.0)), by_rate, "_five_year_avg_yield")
    out = out.withColumn("dividend_yield_gap", F.col("dividend_yield") - usual).drop(*(f"_{c}" for c in QUOTED))
    return out.withColumn("dividend_yield_trap", F.coalesce(F.col("dividend_yield_gap") > 0.015, F.lit(False)))


def fundamentals_fact(dates: DataFrame, known: DataFrame | None, snapshot: DataFrame, today: Column) -> DataFrame:
    """``dates(symbol, date)`` with what was known on each; without any history the ``snapshot(symbol, ...)``, for ``today`` alone."""
    if known is None:
        return snapshot.withColumn("date", today)
    return asof_left(dates, known, ["symbol"], "date", "filed")


def candidates(dates: DataFrame, prices: DataFrame, known: DataFrame, sic: DataFrame) -> DataFrame:
    """``dates(symbol, as_of_date)`` with earnings yield on split-adjusted shares, gross profitability and return on equity.

    Guards: funds and trusts by industry code, companies without revenue, share counts older than 400 days.
    """
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    split = F.coalesce(F.nullif("split_ratio", F.lit(0.0)), F.lit(1.0))
    p = prices.select("symbol", "date", "close", F.exp(F.sum(F.log(split)).over(w)).alias("cum_split"))
    base = dates.join(p.withColumnRenamed("date", "as_of_date"), ["symbol", "as_of_date"])
    base = asof_left(base, known.select("symbol", "filed", "net_income", "shares_outstanding", "shares_date", "roe", "gross_profitability", "revenues"), ["symbol"], "as_of_date", "filed")
    base = asof_left(base, p.select("symbol", "date", F.col("cum_split").alias("at_shares")), ["symbol"], "shares_date", "date").drop("date")
    base = base.join(sic.select("symbol", "sic"), "symbol", "left")
    operating = F.col("revenues").isNotNull() & ~F.coalesce("sic", F.lit("")).isin(*NON_OPERATING_SIC)
    fresh = F.col("shares_date") >= F.date_sub("as_of_date", STALE_DAYS)
    ok = operating & fresh & (F.col("shares_outstanding") > 0) & (F.col("close") > 0)
    worth = F.col("close") * F.col("shares_outstanding") * F.col("cum_split") / F.col("at_shares")
    return base.select(
        "symbol", "as_of_date", "filed", "gross_profitability", F.when(operating, F.col("roe")).alias("roe"), F.when(ok, F.col("net_income") / worth).alias("earnings_yield")
    )
