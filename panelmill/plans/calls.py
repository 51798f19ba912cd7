"""Buy and sell calls with hysteresis, their rounds, and their settlement."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import correlation, net_return
from ..operators.windows import average_rank, overlap_turnover

ENTER, EXIT = 0.90, 0.50


def hysteresis(scores: DataFrame, by: str = "symbol", date: str = "as_of_date", enter: float = ENTER, leave: float = EXIT) -> DataFrame:
    """``scores`` with ``in_position``, ``prior`` and ``call``: in from ``enter`` on, out below ``leave``, else as before.

    Between the thresholds the last crossing counts, which one window carries forward; absent dates keep the state.
    """
    w = Window.partitionBy(by).orderBy(date)
    p = F.col("score_percentile")
    crossing = F.when(p >= enter, True).when(p < leave, False)
    state = F.coalesce(F.last(crossing, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(False))
    out = scores.withColumn("in_position", state).withColumn("prior", F.coalesce(F.lag("in_position").over(w), F.lit(False)))
    call = (
        F.when(~F.col("prior") & F.col("in_position"), "buy").when(F.col("prior") & F.col("in_position"), "hold")
        .when(F.col("prior"), "sell").otherwise("none")
    )
    return out.withColumn("call", call)


def next_round(log: DataFrame, scores: DataFrame, enter: float = ENTER, leave: float = EXIT) -> DataFrame:
    """One round's calls: the state of each symbol is the last of ``log(symbol, as_of_date, call)``, folded, then one step."""
    last = log.groupBy("symbol").agg(F.max_by("call", "as_of_date").alias("last_call"))
    out = scores.join(last, "symbol", "left").withColumn("prior", F.coalesce(F.col("last_call").isin("buy", "hold"), F.lit(False)))
    p = F.col("score_percentile")
    now = F.when(p >= enter, True).when(p < leave, False).otherwise(F.col("prior"))
    call = F.when(~F.col("prior") & now, "buy").when(F.col("prior") & now, "hold").when(F.col("prior"), "sell").otherwise("none")
    return out.withColumn("call", call).drop("last_call")


def rounds(calls: DataFrame, version: str) -> DataFrame:
    """Nested rounds: one row per date with its calls as a sorted array, a date's symbols long."""
    one = F.struct("symbol", "score", "rank", "score_percentile", "call")
    out = calls.groupBy("as_of_date").agg(F.array_sort(F.collect_list(one)).alias("calls"))
    return out.withColumn("methodology_version", F.lit(version))


def flat_calls(rounds_: DataFrame) -> DataFrame:
    """A row per call of nested rounds."""
    return rounds_.select("as_of_date", "methodology_version", F.explode("calls").alias("c")).select("as_of_date", "methodology_version", "c.*")


def due_date(sessions: DataFrame, today: str, first_month: str = "0001-01") -> DataFrame:
    """``due``: the last session of the newest month that is complete, NULL if that is before ``first_month``.

    A month is complete once it is over, and on its last calendar day.
    """
    now = F.lit(today).cast("date")
    complete = (F.date_trunc("month", "date") < F.date_trunc("month", now)) | ((now == F.last_day(now)) & (F.col("date") <= now))
    due = sessions.filter(complete).agg(F.max("date").alias("due"))
    return due.select(F.when(F.date_format("due", "yyyy-MM") >= first_month, F.col("due")).alias("due"))


def off_cycle_date(sessions: DataFrame, events: DataFrame, first_month: str = "0001-01") -> DataFrame:
    """``due``: the latest session, if ``events(action, vintage)`` authorise an off-cycle round of exactly that date; else NULL."""
    allowed = events.filter("action = 'authorize_off_cycle'").select(F.col("vintage").cast("date").alias("due")).distinct()
    last = sessions.agg(F.max("date").alias("due")).filter(F.date_format("due", "yyyy-MM") >= first_month)
    return last.join(allowed, "due", "left_semi").agg(F.max("due").alias("due"))


EXPECTATION_HORIZONS = (21, 63, 126)


def freeze(distribution: DataFrame, ics: DataFrame, definition: str, haircut: float, horizons: Sequence[int] = EXPECTATION_HORIZONS) -> DataFrame:
    """What rounds are graded against, a row per variant and horizon, with where it comes from.

    ``distribution(variant, horizon, mean, p10, p90, n_dates)`` and ``ics(variant, horizon, as_of_date, ic)`` are those of a
    walk-forward evaluation. mean, p10 and p90 are cut by ``haircut``; ic_mean and ic_by_year come along. ``definition_hash``
    names the scores' definition, ``source_sha256`` the variant's distribution itself. A horizon that a variant lacks
    raises when rows are read, as a missing expectation would let every later settlement pass.
    """
    wanted = distribution.select("variant").distinct().withColumn("horizon", F.explode(F.array(*map(F.lit, horizons))))
    years = ics.groupBy("variant", "horizon", F.year("as_of_date").alias("year")).agg(F.avg("ic").alias("ic"), F.sum("ic").alias("s"), F.count("ic").alias("n"))
    text = lambda c: F.round(c, 6).cast("decimal(18,6)").cast("string")
    year = F.concat_ws(":", "year", text("ic"))
    years = years.groupBy("variant", "horizon").agg((F.sum("s") / F.sum("n")).alias("ic_mean"), F.array_join(F.array_sort(F.collect_list(year)), ",").alias("ic_by_year"))
    rows = wanted.join(distribution, ["variant", "horizon"], "left").join(years, ["variant", "horizon"], "left")
    missing = F.raise_error(F.concat_ws(" ", "variant", F.lit("has no distribution at horizon"), F.col("horizon").cast("string"))).cast("boolean")
    rows = rows.filter(F.when(F.col("n_dates").isNull(), missing).otherwise(True))
    own = Window.partitionBy("variant")
    lines = F.array_sort(F.collect_list(F.concat_ws(":", F.lpad(F.col("horizon").cast("string"), 4, "0"), *(text(c) for c in ("mean", "p10", "p90")), "n_dates")).over(own))
    rows = rows.withColumn("source_sha256", F.sha2(F.array_join(lines, ","), 256)).withColumn("definition_hash", F.lit(hashlib.sha256(definition.encode()).hexdigest()))
    cut = [(F.col(c) * haircut).alias(c) for c in ("mean", "p10", "p90")]
    return rows.select("variant", "horizon", *cut, "n_dates", "ic_mean", "ic_by_year", F.lit(haircut).alias("haircut"), "definition_hash", "source_sha256")


def call_excess(calls: DataFrame, returns: DataFrame, horizon: int) -> DataFrame:
    """Per date, mean excess return of names in position and of the others, and the spread."""
    r = returns.filter(F.col("horizon") == horizon).select("symbol", "as_of_date", "excess_return")
    j = calls.join(r, ["symbol", "as_of_date"]).withColumn("_in", F.col("call").isin("buy", "hold"))
    inside, outside = (F.avg(F.when(F.col("_in") == x, F.col("excess_return"))) for x in (True, False))
    return j.groupBy("as_of_date").agg(
        inside.alias("in_position"), outside.alias("out"), (inside - outside).alias("spread"), F.count_if("_in").alias("n_in"), F.count_if(~F.col("_in")).alias("n_out")
    )


def position_turnover(calls: DataFrame) -> DataFrame:
    return overlap_turnover(calls.filter(F.col("call").isin("buy", "hold"))).agg(F.avg("turnover").alias("turnover"))


def settle(calls: DataFrame, expected: DataFrame, returns: DataFrame, benchmark: str, bps: float = 10.0, top: float = 0.9) -> DataFrame:
    """Every closed (round, rung) graded against its frozen expectation ``expected(horizon, mean, p10)``.

    A rung is closed once the benchmark has a return for it. A closed rung that ``expected`` lacks raises when rows are read.
    """
    closed = returns.filter(F.col("symbol") == benchmark).select("as_of_date", "horizon")
    due = calls.select("as_of_date").distinct().join(closed, "as_of_date").join(expected.withColumn("_known", F.lit(True)), "horizon", "left")
    due = due.withColumn("_ok", F.when(F.col("_known").isNull(), F.raise_error(F.lit("a closed rung has no expectation")).cast("boolean")).otherwise(True)).filter("_ok")
    total = calls.groupBy("as_of_date").agg(F.count("*").alias("n_calls"))
    frame = calls.join(returns.select("symbol", "as_of_date", "horizon", "fwd_return", "excess_return"), ["symbol", "as_of_date"]).join(due.select("as_of_date", "horizon"), ["as_of_date", "horizon"])
    by = ["as_of_date", "horizon"]
    frame = frame.withColumn("_a", average_rank(F.col("score"), by)).withColumn("_b", average_rank(F.col("excess_return"), by))
    best = F.avg(F.when(F.col("score_percentile") >= top, F.col("fwd_return")))
    graded = frame.groupBy(*by).agg(
        F.count("*").alias("n_symbols"), (net_return(best, bps) - F.avg("fwd_return")).alias("realized_excess_net"), correlation("_a", "_b").alias("realized_ic")
    )
    out = graded.join(total, "as_of_date").join(due.select("as_of_date", "horizon", "mean", "p10"), by)
    return out.withColumn("n_missing", F.col("n_calls") - F.col("n_symbols")).drop("n_calls").withColumn(
        "below_mean", F.coalesce(F.col("realized_excess_net") < F.col("mean"), F.lit(False))
    ).withColumn("below_p10", F.coalesce(F.col("realized_excess_net") < F.col("p10"), F.lit(False)))


def attribution(calls: DataFrame, returns: DataFrame, components: list[str]) -> DataFrame:
    """Per round, rung and component: rank correlation of the component's percentile with the excess return."""
    long = calls.unpivot(["symbol", "as_of_date"], components, "component", "pct").join(returns.select("symbol", "as_of_date", "horizon", "excess_return"), ["symbol", "as_of_date"])
    by = ["as_of_date", "horizon", "component"]
    long = long.filter("pct is not null and excess_return is not null")
    long = long.withColumn("_a", average_rank(F.col("pct"), by)).withColumn("_b", average_rank(F.col("excess_return"), by))
    return long.groupBy(*by).agg(correlation("_a", "_b").alias("ic"))


def trailing_runs(settled: DataFrame, flags: list[str], by: str = "horizon", date: str = "as_of_date") -> DataFrame:
    """Per ``by``, how many of the newest rows in a row have each flag: rows after the last one without it."""
    w = Window.partitionBy(by)
    last = {f"_last_{f}": F.max(F.when(~F.col(f), F.col(date))).over(w) for f in flags}
    after = {f: F.col(f"_last_{f}").isNull() | (F.col(date) > F.col(f"_last_{f}")) for f in flags}
    return settled.withColumns(last).groupBy(by).agg(*(F.count_if(after[f]).alias(f"trailing_{f}") for f in flags))


def drift(settled: DataFrame, attributed: DataFrame, rung: int = 21, mean_rounds: int = 3, p10_rounds: int = 2, t_bar: float = 1.0) -> DataFrame:
    """``signal, n, t, action`` at one rung: how long the newest settlements are below, and which signals are insignificant.

    Rows ``below_mean`` and ``below_p10`` have the trailing run as n and ask for a ``review`` from their number of rounds on.
    A row per component of ``attributed(as_of_date, horizon, component, ic)`` has its number of ICs and their t, NULL without
    spread, and asks for a ``demotion_review`` if t is within ``t_bar`` after ``mean_rounds`` settlements or more.
    """
    at = settled.filter(F.col("horizon") == rung)
    runs = ["trailing_below_mean", "trailing_below_p10"]
    one = at.sparkSession.range(1).select(F.lit(rung).alias("horizon"))  # without settlements the runs are 0
    run = one.join(trailing_runs(at, ["below_mean", "below_p10"]), "horizon", "left").na.fill(0, runs).unpivot([], runs, "signal", "n")
    run = run.withColumn("signal", F.substring("signal", 10, 100)).withColumn("t", F.lit(None).cast("double"))
    enough = F.when(F.col("signal") == "below_mean", mean_rounds).otherwise(p10_rounds)
    run = run.withColumn("action", F.when(F.col("n") >= enough, "review"))
    ics = attributed.filter((F.col("horizon") == rung) & F.col("ic").isNotNull()).join(at.select("as_of_date").distinct(), "as_of_date")
    spread = F.nullif(F.stddev_samp("ic"), F.lit(0.0))
    own = ics.groupBy(F.col("component").alias("signal")).agg(F.count("*").alias("n"), (F.try_divide(F.avg("ic"), spread) * F.sqrt(F.count("*"))).alias("t"))
    own = own.withColumn("action", F.when((F.col("n") >= mean_rounds) & (F.abs("t") < t_bar), "demotion_review"))
    return run.select("signal", "n", "t", "action").unionByName(own)


def agreement(trades: DataFrame, calls: DataFrame) -> DataFrame:
    """``bucket, n`` of the trades after the round: followed, contradicted or unprompted; seeds don't count."""
    vintage = calls.agg(F.max("as_of_date").alias("vintage"))
    latest = calls.join(F.broadcast(vintage), F.col("as_of_date") == F.col("vintage")).select("symbol", "call", "vintage")
    t = trades.filter("not seed").crossJoin(F.broadcast(vintage)).filter("date > vintage").join(latest.select("symbol", "call"), "symbol", "left")
    long = F.col("call").isin("buy", "hold")
    buy = F.when(long, "followed").when(F.col("call") == "sell", "contradicted").otherwise("unprompted")
    sell = F.when(F.col("call") == "sell", "followed").when(long, "contradicted").otherwise("unprompted")
    return t.groupBy(F.when(F.col("side") == "buy", buy).otherwise(sell).alias("bucket")).agg(F.count("*").alias("n"))
