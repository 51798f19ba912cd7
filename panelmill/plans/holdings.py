"""The held book: journal, lots, losses, verdicts. Lots come from running sums; nothing loops over trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import asof_left

KEY = ["account", "symbol"]
_EPS = 1e-9
# Parts of account names whose losses deduct nothing.
TAX_ADVANTAGED = ("roth", "ira", "401", "hsa")


def net_shares(trades: DataFrame) -> DataFrame:
    return trades.groupBy(*KEY).agg(F.sum(F.when(F.col("side") == "buy", F.col("qty")).otherwise(-F.col("qty"))).alias("net"))


def open_lots(trades: DataFrame) -> DataFrame:
    """``account, symbol, date, price, seed, id, open`` of lots that sells, oldest first, haven't used up.

    A lot's rest is what the running sum of buys exceeds all sales by, at most the lot. ``trades`` has an ``id`` that
    orders trades of one day. Selling more than was held so far raises when rows are read.
    """
    w = Window.partitionBy(*KEY).orderBy("date", "id")
    whole = Window.partitionBy(*KEY)
    buy = F.when(F.col("side") == "buy", F.col("qty")).otherwise(0.0)
    sell = F.when(F.col("side") == "sell", F.col("qty")).otherwise(0.0)
    # a day's buys come before its sales
    day = Window.partitionBy(*KEY).orderBy("date").rangeBetween(Window.unboundedPreceding, 0)
    t = trades.withColumn("_bought", F.sum(buy).over(w)).withColumn("_sold", F.sum(sell).over(whole)).withColumn("_net", F.sum(buy - sell).over(day))
    rest = F.greatest(F.lit(0.0), F.least(F.col("qty"), F.col("_bought") - F.col("_sold")))
    over = F.raise_error(F.concat_ws(" ", "account", "symbol", F.lit("sells more than the journal holds"))).cast("boolean")
    keep = F.when(F.col("_net") < -_EPS, over).otherwise((F.col("side") == "buy") & (F.col("open") > _EPS))
    return t.withColumn("open", rest).filter(keep).select(*KEY, "date", "price", "seed", "id", "open")


def reconcile(trades: DataFrame, positions: DataFrame) -> DataFrame:
    """Warnings where the journal's net shares and ``positions(account, symbol, quantity)`` disagree."""
    j = net_shares(trades).join(positions, KEY, "left")
    kind = (
        F.when(F.col("net") < -_EPS, "oversold").when(F.col("quantity").isNotNull() & (F.abs(F.col("quantity") - F.col("net")) > _EPS), "differs")
        .when(F.col("quantity").isNull() & (F.col("net") > _EPS), "missing")
    )
    return j.withColumn("warning", kind).filter("warning is not null").select(*KEY, "net", "quantity", "warning")


def loss_harvest(trades: DataFrame, prices: DataFrame, latest: DataFrame, today: str, wash_days: int = 30, long_days: int = 365) -> DataFrame:
    """Open lots of taxable accounts below their basis: the lot's price, else the close as of its date."""
    now = F.lit(today).cast("date")
    lots = open_lots(trades)
    lower = F.lower("account")
    taxed = F.lit(True)
    for marker in TAX_ADVANTAGED:
        taxed = taxed & ~lower.contains(marker)
    lots = asof_left(lots.filter(taxed), prices.select("symbol", F.col("date").alias("priced"), F.col("close").alias("then")), ["symbol"], "date", "priced")
    recent = trades.filter((F.col("side") == "buy") & ~F.col("seed") & (F.col("date") >= F.date_sub(now, wash_days))).select("symbol").distinct().withColumn("_w", F.lit(True))
    out = lots.withColumn("basis", F.coalesce("price", "then")).join(latest.select("symbol", F.col("close").alias("last")), "symbol").join(recent, "symbol", "left")
    return out.filter("basis is not null and last < basis").select(
        *KEY, F.col("open").alias("qty"), "basis", F.col("last").alias("price"), (F.col("last") / F.col("basis") - 1).alias("loss_pct"), F.col("date").alias("acquired"),
        (F.datediff(now, "date") >= long_days).alias("long_term"), F.coalesce("_w", F.lit(False)).alias("wash_sale"),
    )


def held_table(positions: DataFrame, tracked: DataFrame, ranks: DataFrame, calls: DataFrame | None, sight: DataFrame) -> DataFrame:
    """A row per held symbol: its accounts, quantity, whether it is tracked, rank, call and decline."""
    held = positions.groupBy("symbol").agg(F.array_join(F.array_sort(F.collect_set("account")), ", ").alias("accounts"), F.sum("quantity").alias("total_quantity"))
    out = held.join(tracked.select("symbol").distinct().withColumn("_t", F.lit(True)), "symbol", "left").withColumn("tracked", F.coalesce("_t", F.lit(False))).drop("_t")
    out = out.join(ranks.select("symbol", "composite_rank"), "symbol", "left")
    out = out.join(calls.select("symbol", "call"), "symbol", "left") if calls is not None else out.withColumn("call", F.lit(None).cast("string"))
    return out.join(sight.select("symbol", "deteriorating", "ret_3m", "ret_12m"), "symbol", "left")


def verdicts(held: DataFrame, prior: DataFrame, last_buy: DataFrame, today: str, too_soon_days: int = 60) -> DataFrame:
    """act, too-soon or punt for each held symbol, and whether a reason is new since the last review."""
    bad = F.coalesce("deteriorating", F.lit(False)) | F.coalesce(F.col("call") == "sell", F.lit(False))
    out = held.withColumn("flagged", bad).join(last_buy, "symbol", "left").join(prior.select("symbol", F.col("flagged").alias("_was")), "symbol", "left")
    fresh = F.datediff(F.lit(today).cast("date"), "bought") < too_soon_days
    verdict = F.when(~F.col("tracked"), "punt").when(F.col("flagged") & fresh, "too-soon").when(F.col("flagged"), "act").otherwise("keep")
    return out.withColumn("verdict", verdict).withColumn("newly", F.col("flagged") & ~F.coalesce("_was", F.lit(False))).drop("_was", "bought")
