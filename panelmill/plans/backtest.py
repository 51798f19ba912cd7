"""Walk-forward evaluation: forward returns, evaluation frames, metrics of many signals and horizons in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import correlation, net_return
from ..operators.windows import average_rank, bucket, overlap_turnover

HORIZONS = (21, 63, 126, 252)
DECAY_HORIZONS = tuple(21 * k for k in range(1, 13))


def forward_returns(prices: DataFrame, benchmark: str, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Returns from the next session's open over ``horizon`` sessions, and their excess over the benchmark's.

    ``prices(symbol, date, adj_open, ...)``. A window that isn't closed gives no row, nor does an entry price of 0. All
    horizons come from one window by ``lead``, then a row per horizon; the benchmark is joined by date and horizon.
    """
    w = Window.partitionBy("symbol").orderBy("date")
    ahead = F.array(*(F.struct(F.lit(h).alias("horizon"), F.lead("date", 1 + h).over(w).alias("exit_date"), F.lead("adj_open", 1 + h).over(w).alias("exit")) for h in horizons))
    rows = prices.select("symbol", F.col("date").alias("as_of_date"), F.lead("date").over(w).alias("entry_date"), F.lead("adj_open").over(w).alias("entry"), ahead.alias("ahead"))
    rows = rows.filter("entry > 0").withColumn("x", F.explode("ahead")).filter("x.exit is not null")
    rows = rows.select("symbol", "as_of_date", "x.horizon", "entry_date", "x.exit_date", (F.col("x.exit") / F.col("entry") - 1).alias("fwd_return"))
    bench = rows.filter(F.col("symbol") == benchmark).select("as_of_date", "horizon", F.col("fwd_return").alias("benchmark_return"))
    out = rows.join(bench, ["as_of_date", "horizon"], "left")
    return out.withColumn("excess_return", F.col("fwd_return") - F.col("benchmark_return"))


def evaluation_frame(signals: DataFrame, returns: DataFrame, benchmark: str) -> DataFrame:
    """``variant, horizon, as_of_date, symbol, signal, fwd_return, excess_return`` on the last signal date of each month.

    ``signals(variant, symbol, as_of_date, signal)``; only dates the benchmark has settled, without the benchmark itself.
    """
    settled = returns.filter(F.col("symbol") == benchmark).select("as_of_date", "horizon")
    ends = settled.groupBy("horizon", F.date_trunc("month", "as_of_date").alias("_m")).agg(F.max("as_of_date").alias("as_of_date")).drop("_m")
    rows = returns.join(ends, ["as_of_date", "horizon"]).filter(F.col("symbol") != benchmark)
    return rows.join(signals.filter("signal is not null"), ["symbol", "as_of_date"]).select(
        "variant", "horizon", "as_of_date", "symbol", "signal", "fwd_return", "excess_return"
    )


_RUN = ["variant", "horizon"]


def ic_by_date(frame: DataFrame) -> DataFrame:
    """Spearman correlation of signal and excess return per date; none where either has fewer than two values."""
    by = [*_RUN, "as_of_date"]
    r = frame.filter("excess_return is not null")
    r = r.withColumn("_a", average_rank(F.col("signal"), by)).withColumn("_b", average_rank(F.col("excess_return"), by))
    many = (F.min("signal") < F.max("signal")) & (F.min("excess_return") < F.max("excess_return"))
    return r.groupBy(*by).agg(F.when(many, correlation("_a", "_b")).alias("ic")).filter("ic is not null")


def t_stat(col: str) -> Column:
    """Mean by standard error; infinite with the mean's sign without spread or with a single value, 0 for a mean of 0 then."""
    mean, spread, n = F.avg(col), F.stddev_samp(col), F.count(col)
    flat = F.when(mean > 0, float("inf")).when(mean < 0, float("-inf")).otherwise(F.when(mean.isNotNull(), 0.0))
    return F.when((n > 1) & (spread > 0), mean / spread * F.sqrt(n)).otherwise(flat)


def ic_summary(ics: DataFrame) -> DataFrame:
    """Mean, t of the dates, and t of the years' means, which overlapping windows inflate less. A year counts on its first date."""
    year = Window.partitionBy(*_RUN, F.year("as_of_date"))
    fold = F.when(F.row_number().over(year.orderBy("as_of_date")) == 1, F.avg("ic").over(year))
    return ics.withColumn("_fold", fold).groupBy(*_RUN).agg(F.avg("ic").alias("mean_ic"), t_stat("ic").alias("t_stat"), F.count("*").alias("n_dates"), t_stat("_fold").alias("fold_t"))


def with_deciles(frame: DataFrame) -> DataFrame:
    return frame.withColumn("decile", bucket([F.col("signal"), F.col("symbol")], [*_RUN, "as_of_date"]))


def decile_means(frame: DataFrame) -> DataFrame:
    per_date = with_deciles(frame).groupBy(*_RUN, "as_of_date", "decile").agg(F.avg("excess_return").alias("m"))
    return per_date.groupBy(*_RUN, "decile").agg(F.avg("m").alias("mean_excess"))


def monotonicity(deciles: DataFrame) -> DataFrame:
    """Rank correlation of a decile's number and its mean excess return: 1 is perfectly ordered."""
    r = deciles.withColumn("_a", average_rank(F.col("decile"), _RUN)).withColumn("_b", average_rank(F.col("mean_excess"), _RUN))
    return r.groupBy(*_RUN).agg(correlation("_a", "_b").alias("monotonicity"))


def top_excess(frame: DataFrame, bps: float = 0.0) -> DataFrame:
    """Per date, the top decile's mean return after costs less the mean of all."""
    top = F.avg(F.when(F.col("decile") == 9, F.col("fwd_return")))
    return with_deciles(frame).groupBy(*_RUN, "as_of_date").agg((net_return(top, bps) - F.avg("fwd_return")).alias("excess"))


def distribution(excess: DataFrame) -> DataFrame:
    """Mean, tenth and ninetieth percentile of the per-date excess returns."""
    p = lambda x: F.percentile("excess", F.lit(x))
    return excess.groupBy(*_RUN).agg(F.avg("excess").alias("mean"), p(0.1).alias("p10"), p(0.9).alias("p90"), F.count("*").alias("n_dates"))


def evaluate(frame: DataFrame, bps: float = 10.0) -> DataFrame:
    """All metrics, a row per variant and horizon; ``frame`` is read once.

    One pass ranks a date's rows and aggregates them to a row per date, with the means of its deciles and the names in
    the top one (a tenth of a date's symbols); what is left is a row per date.
    """
    by = [*_RUN, "as_of_date"]
    both = F.col("excess_return").isNotNull()
    r = with_deciles(frame).withColumn("_a", F.when(both, average_rank(F.col("signal"), [*by, both]))).withColumn("_b", F.when(both, average_rank(F.col("excess_return"), [*by, both])))
    own = lambda c: F.when(both, F.col(c))
    many = (F.min(own("signal")) < F.max(own("signal"))) & (F.min("excess_return") < F.max("excess_return"))
    top = F.col("decile") == 9
    fwd = F.avg(F.when(top, F.col("fwd_return")))
    dates = r.groupBy(*by).agg(
        F.when(many, correlation("_a", "_b")).alias("ic"), F.array(*(F.avg(F.when(F.col("decile") == k, F.col("excess_return"))) for k in range(10))).alias("means"),
        F.count_if(top & (F.col("excess_return") > 0)).alias("hits"), F.count_if(top & both).alias("held"), F.collect_set(F.when(top, F.col("symbol"))).alias("names"),
        (fwd - F.avg("fwd_return")).alias("gross"), (net_return(fwd, bps) - F.avg("fwd_return")).alias("net"),
    )
    w, year = Window.partitionBy(*_RUN).orderBy("as_of_date"), Window.partitionBy(*_RUN, F.year("as_of_date"))
    named = F.size("names") > 0
    before = F.last(F.when(named, F.col("names")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    dates = dates.withColumn("turnover", F.when(named, 1 - F.size(F.array_intersect("names", before)) / F.size("names")))
    has = F.col("ic").isNotNull()
    fold = F.when(has & (F.row_number().over(Window.partitionBy(*_RUN, F.year("as_of_date"), has).orderBy("as_of_date")) == 1), F.avg("ic").over(year))
    p = lambda x: F.percentile("net", F.lit(x))
    runs = dates.withColumn("_fold", fold).groupBy(*_RUN).agg(
        F.avg("ic").alias("mean_ic"), t_stat("ic").alias("t_stat"), F.count("ic").alias("n_dates"), t_stat("_fold").alias("fold_t"),
        F.try_divide(F.sum("hits"), F.sum("held")).alias("hit_rate"), F.avg("turnover").alias("turnover"), F.avg("gross").alias("excess_gross"),
        F.avg("net").alias("mean"), p(0.1).alias("p10"), p(0.9).alias("p90"), F.array(*(F.avg(F.col("means")[k]) for k in range(10))).alias("means"),
    ).filter("n_dates > 0")
    deciles = runs.select(*_RUN, F.posexplode("means").alias("decile", "mean_excess")).filter("mean_excess is not null")
    return runs.drop("means").join(monotonicity(deciles), _RUN)
