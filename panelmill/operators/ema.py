"""Exponential means by a scan over long blocks: no recursion, no join, no Python, windows by symbol only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A block is as long as the inverse of its smallest weight stays below e ** _SPAN, and what fell below e ** -_GONE is nothing.
_SPAN, _GONE = 600.0, 40.0


def emas(df: DataFrame, specs: dict[str, tuple[str, float]], by: str = "symbol", order: str = "date") -> DataFrame:
    """``df`` with a column per spec ``name: (column, alpha)``: y = (1 - alpha) * y_before + alpha * x, seeded by the first x.

    Leading NULLs give NULL; a NULL later on counts as 0 input. Rows of a symbol are numbered and cut into blocks, some
    thousand rows long. Inside a block the recursion unrolls to one running sum of inputs over powers of (1 - alpha). What
    blocks before hand on is their last value, carried forward by a window; each further round of carrying takes one block
    more into account, until what is left out is beyond a double's precision (one or two rounds for usual alphas).
    """
    decay = {n: -math.log(1 - alpha) for n, (_, alpha) in specs.items()}
    block = max(2, int(_SPAN / max(decay.values())))
    rounds = {n: math.ceil(_GONE / (block * x)) for n, x in decay.items()}
    w = Window.partitionBy(by).orderBy(order)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumns({"_rn": F.row_number().over(w) - 1} | {f"_seen_{n}": F.count(c).over(running) for n, (c, _) in specs.items()})
    out = out.withColumn("_block", F.floor(F.col("_rn") / block).cast("int")).withColumn("_k", (F.col("_rn") % block).cast("int"))
    terms, local = {}, {}
    inside = Window.partitionBy(by, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    for n, (c, alpha) in specs.items():
        weight = F.when((F.col(f"_seen_{n}") == 1) & F.col(c).isNotNull(), 1.0).otherwise(alpha)
        terms[f"_t_{n}"] = F.coalesce(F.col(c) * weight * F.exp(F.col("_k") * decay[n]), F.lit(0.0))
        local[f"_l_{n}"] = F.sum(f"_t_{n}").over(inside) * F.exp(F.col("_k") * -decay[n])
    out = out.withColumns(terms).withColumns(local).drop(*terms)
    before = Window.partitionBy(by).orderBy("_block", order).rowsBetween(Window.unboundedPreceding, -1)
    now = {n: F.col(f"_l_{n}") for n in specs}
    for i in range(max(rounds.values())):
        ends = {f"_e{i}_{n}": F.last(F.when(F.col("_k") == block - 1, now[n]), ignorenulls=True).over(before) for n in specs if i < rounds[n]}
        out = out.withColumns(ends)
        now |= {n: F.col(f"_l_{n}") + F.coalesce(f"_e{i}_{n}", F.lit(0.0)) * F.exp((F.col("_k") + 1) * -decay[n]) for n in specs if i < rounds[n]}
    out = out.withColumns({n: F.when(F.col(f"_seen_{n}") > 0, now[n]) for n in specs})
    return out.drop("_rn", "_block", "_k", *(c for c in out.columns if c.startswith(("_seen_", "_l_", "_e")) and c not in df.columns))
