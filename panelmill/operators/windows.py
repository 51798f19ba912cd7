"""Window operators over a panel keyed by (symbol, date).

Windows are partitioned by symbol or by date, never global; a symbol has a row per session, so a partition is bounded by
the calendar, and all columns of one window spec share one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def series(by: str = "symbol", order: str = "date") -> WindowSpec:
    return Window.partitionBy(by).orderBy(order)


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key: the first in ``order``."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rn = 1").drop("_rn")


def change(col: str | Column, rows: int, w: WindowSpec) -> Column:
    """Relative change against ``rows`` rows before; NULL where that is absent or 0."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_divide(c, F.lag(c, rows).over(w)) - 1


def rolling(fn, col: str | Column, rows: int, w: WindowSpec) -> Column:
    """``fn`` over the last ``rows`` rows; NULL until all of them have a value."""
    c = F.col(col) if isinstance(col, str) else col
    frame = w.rowsBetween(-(rows - 1), 0)
    return F.when(F.count(c).over(frame) == rows, fn(c).over(frame))


def with_extremes(df: DataFrame, specs: dict[str, tuple[str, str, int]], w: WindowSpec) -> DataFrame:
    """``df`` with a column per spec ``name: ("max" or "min", column, rows)``: the extreme of the last ``rows`` rows, NULL until all have a value.

    The extreme of twice as many rows is that of two neighbouring halves, and any number is covered by two of the largest
    power of 2 in it. So every length costs one ``lag``, where a sliding frame would read all its rows again for every row.
    """
    best = {"max": F.greatest, "min": F.least}
    series_ = sorted({(f, c) for f, c, _ in specs.values()})
    most = max(n for *_, n in specs.values())
    at = lambda f, c, k: f"_{f}_{c}_{k}"
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumns({at(f, c, 1): F.col(c) for f, c in series_} | {f"_n_{c}": F.count(c).over(run) for c in {c for _, c in series_}})
    k = 1
    while 2 * k <= most:
        out = out.withColumns({at(f, c, 2 * k): best[f](at(f, c, k), F.lag(at(f, c, k), k).over(w)) for f, c in series_})
        k *= 2
    for name, (f, c, n) in specs.items():
        half = 1 << (n.bit_length() - 1)
        held = F.col(f"_n_{c}") - F.coalesce(F.lag(f"_n_{c}", n).over(w), F.lit(0))
        whole = F.col(at(f, c, half)) if half == n else best[f](at(f, c, half), F.lag(at(f, c, half), n - half).over(w))
        specs = specs | {name: F.when(held == n, whole)}
    return out.withColumns(specs).select(*df.columns, *specs)


def pct_rank(col: Column, by: Sequence[str], higher_is_better: bool = True) -> Column:
    """PERCENT_RANK over the rows that have a value, best row 1.0; NULL for the others."""
    order = col.asc() if higher_is_better else col.desc()
    return F.when(col.isNotNull(), F.percent_rank().over(Window.partitionBy(*by, col.isNull()).orderBy(order)))


def average_rank(col: Column, by: Sequence[str]) -> Column:
    """Rank from 1 where ties share their mean rank."""
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, col))
    return F.rank().over(Window.partitionBy(*by).orderBy(col)) + (ties - 1) / 2.0


def bucket(order: Sequence[Column], by: Sequence[str], n: int = 10) -> Column:
    """0 .. n-1 by position: ceil(position * n / rows) - 1, so the best row is in the top bucket at any size."""
    w = Window.partitionBy(*by)
    return (F.ceil(F.row_number().over(w.orderBy(*order)) * n / F.count(F.lit(1)).over(w)) - 1).cast("int")


def running_product(factor: Column, w: WindowSpec) -> Column:
    """Product of positive factors up to the row."""
    return F.exp(F.sum(F.log(factor)).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def product_after(factor: Column, w: WindowSpec) -> Column:
    """Product of positive factors strictly after the row; 1 for the last."""
    return F.coalesce(F.exp(F.sum(F.log(factor)).over(w.rowsBetween(1, Window.unboundedFollowing))), F.lit(1.0))


def carried(col: Column, w: WindowSpec) -> Column:
    """The last value that isn't NULL, up to the row."""
    return F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def overlap_turnover(members: DataFrame, by: Sequence[str] = (), key: str = "symbol", date: str = "as_of_date") -> DataFrame:
    """Per date, the share of its members that weren't members on the date before; the first date has none.

    ``members`` has (by, date, key) rows. Dates are numbered, and a date's members are joined to the previous date's.
    """
    dates = members.select(*by, date).distinct()
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(date)
    dates = dates.withColumn("_next", F.lead(date).over(w))
    held = members.select(*by, date, key).distinct()
    was = held.join(dates, [*by, date]).filter("_next is not null").select(*by, F.col("_next").alias(date), key, F.lit(1).alias("_was"))
    joined = held.join(was, [*by, date, key], "left")
    first = dates.groupBy(*by).agg(F.min(date).alias("_first"))
    rates = joined.groupBy(*by, date).agg((1 - F.count("_was") / F.count(F.lit(1))).alias("turnover"))
    rates = rates.join(first, list(by)) if by else rates.crossJoin(F.broadcast(first))
    return rates.filter(F.col(date) > F.col("_first")).drop("_first")
