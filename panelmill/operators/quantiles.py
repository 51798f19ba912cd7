"""Order statistics of groups of any size: exact quantiles by selection, ranks over a whole table, mergeable sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import stored

#: Equal shares that a pass of the selection cuts the rows left into, and the accuracy of where it cuts.
_CUTS, _ACCURACY = 512, 20_000


def exact_quantiles(df: DataFrame, by: Sequence[str], targets: dict[str, tuple[Column, float]], most: int | None = None) -> DataFrame:
    """``by`` and a column per target ``name: (values, p)``: the exact interpolated quantile of the group's values.

    No task holds a group. Groups of up to ``most`` values (10,000, or a ten thousandth of all) are aggregated; larger ones
    are narrowed down: a pass cuts the values between a target's bounds into equal shares with a sketch of bounded size, counts
    exactly what lies below and between, and the shares around the rank become the bounds, until at most ``most`` values
    are between them or the rank is on one. A pass is one aggregation with map-side combine; bounds (a row per large group
    and target) go to every task, as there are fewer than 10,000 large groups. Three passes do for 10^12 values. Null and
    NaN values don't count, a group without values has NULL.
    """
    names = list(targets)
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    values = F.array(*(F.struct(F.lit(i).alias("t"), v.cast("double").alias("x")) for i, (v, _) in enumerate(targets.values())))
    long = df.select(key.alias("key"), F.explode(values).alias("s")).select("key", "s.t", "s.x")
    some = long.filter("x is not null and not isnan(x)")
    p = F.element_at(F.array(*(F.lit(float(q)) for _, q in targets.values())), F.col("t") + 1)
    sizes = long.groupBy("key", "t").agg(F.count_if(F.col("x").isNotNull() & ~F.isnan("x")).alias("n"))
    sizes = stored(sizes.withColumn("place", p * (F.col("n") - 1)), "sizes")
    if most is None:
        most = max(10_000, (sizes.agg(F.sum("n")).first()[0] or 0) // 10_000)
    large = sizes.filter(F.col("n") > most)
    shares = F.percentile("x", F.array(*(F.lit(float(q)) for _, q in targets.values())))
    rest = some.join(F.broadcast(large.select("key", "t")), ["key", "t"], "left_anti")
    found = rest.groupBy("key", "t").agg(shares.alias("q")).select("key", "t", F.element_at("q", F.col("t") + 1).alias("value"))
    if not large.isEmpty():
        ranks = large.select("key", "t", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))).alias("rank"))
        ends = _at_ranks(some, ranks, most).join(F.broadcast(large.select("key", "t", "place")), ["key", "t"])
        a, b, place = F.min("value"), F.max("value"), F.first("place")
        found = found.unionByName(ends.groupBy("key", "t").agg((a + (b - a) * (place - F.floor(place))).alias("value")))
    found = sizes.join(found, ["key", "t"], "left").groupBy("key").agg(*(F.max(F.when(F.col("t") == i, F.col("value"))).alias(n) for i, n in enumerate(names)))
    return found.select(*(F.col(f"key.{c}") for c in by), *names)


def _at_ranks(some: DataFrame, ranks: DataFrame, most: int) -> DataFrame:
    """``key, t, rank, value``: the values at ranks counted from 0, by narrowing down ``low`` and ``high`` around each.

    Both bounds are values that occur. A pass counts what lies below, on and between them: the rank is on a bound, which
    is its value then, or strictly between, so that a pass leaves fewer values, ties or not.
    """
    nothing, x = F.lit(None).cast("double"), F.col("x")
    bounds = ranks.select("key", "t", "rank", nothing.alias("low"), nothing.alias("high"))
    inner = (F.col("low").isNull() | (x > F.col("low"))) & (F.col("high").isNull() | (x < F.col("high")))
    cuts = F.array(*(F.lit(i / _CUTS) for i in range(_CUTS + 1)))
    exact = few = None
    add = lambda old, new: new if old is None else old.unionByName(new)
    while True:
        counted = some.join(F.broadcast(bounds), ["key", "t"]).groupBy("key", "t", "rank").agg(
            F.first("low").alias("low"), F.first("high").alias("high"), F.count_if(x < F.col("low")).alias("below"), F.count_if(x == F.col("low")).alias("on_low"),
            F.count_if(inner).alias("between"), F.count_if(x == F.col("high")).alias("on_high"), F.percentile_approx(F.when(inner, x), cuts, F.lit(_ACCURACY)).alias("cuts"),
        )
        counted = stored(counted.withColumn("past", F.col("rank") - F.col("below") - F.col("on_low")), "bounds")
        if not counted.filter("rank < below or past >= between + on_high").isEmpty():
            raise RuntimeError("a rank lies outside the bounds that its sketch gave")
        exact = add(exact, counted.filter("past < 0").select("key", "t", "rank", F.col("low").alias("value")))
        exact = add(exact, counted.filter("past >= between").select("key", "t", "rank", F.col("high").alias("value")))
        inside = counted.filter("past >= 0 and past < between")
        few = add(few, inside.filter(F.col("between") <= most).select("key", "t", "rank", "low", "high", "past"))
        left = inside.filter(F.col("between") > most)
        if left.isEmpty():
            break
        share = lambda at: at * _CUTS / F.col("between")
        lower = F.greatest(F.lit(1), F.floor(share(F.col("past"))).cast("int"))  # the cut before that share, counted from 1
        upper = F.least(F.lit(_CUTS + 1), F.ceil(share(F.col("past") + 1)).cast("int") + 2)
        bounds = left.select("key", "t", "rank", F.element_at("cuts", lower).alias("low"), F.element_at("cuts", upper).alias("high"))
    near = some.join(F.broadcast(few), ["key", "t"]).filter(inner)
    number = F.row_number().over(Window.partitionBy("key", "t", "rank").orderBy("x")) - 1
    return near.withColumn("number", number).filter("number = past").select("key", "t", "rank", x.alias("value")).unionByName(exact)


def global_ranks(df: DataFrame, value: Column, ascending: bool = True, nulls_first: bool = False) -> DataFrame:
    """``df`` with ``global_rank`` (long, ties equal) and ``global_percent_rank`` of ``value`` over the whole table, without bringing it together.

    Rows are counted by value; the values are dealt out by range, each range adds up its own counts, and a row per range says
    how many rows come before. The ranks go back to the rows by value: values that hold many rows go to every task, and the
    others are shuffled. A null ranks after (or before) all others. ``df`` is read several times and must give the same rows each time.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    null = F.when(value.isNull(), 0 if nulls_first else 1).otherwise(1 if nulls_first else 0)
    own = F.struct(null.alias("null"), value.alias("v"))
    rows = df.withColumn("_v", own)
    order = [F.col("_v.null"), F.col("_v.v").asc() if ascending else F.col("_v.v").desc()]
    counts = rows.groupBy("_v").agg(F.count("*").alias("_n"))
    dealt = stored(counts.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "values")
    ranges = dealt.groupBy("_range").agg(F.sum("_n").alias("_m"))
    # a row per range
    ranges = stored(ranges.select("_range", (F.sum("_m").over(Window.orderBy("_range")) - F.col("_m")).alias("_before"), F.sum("_m").over(Window.partitionBy(F.lit(0))).alias("_all")), "ranges")
    within = F.sum("_n").over(Window.partitionBy("_range").orderBy(*order)) - F.col("_n")
    ranks = dealt.join(F.broadcast(ranges), "_range").select("_v", "_n", (F.col("_before") + within + 1).alias("global_rank"), "_all")
    ranks = stored(ranks.withColumn("global_percent_rank", F.when(F.col("_all") > 1, (F.col("global_rank") - 1) / (F.col("_all") - 1)).otherwise(0.0)), "ranks")
    hot = ranks.filter(F.col("_n") * (4 * n) > F.col("_all"))  # fewer than four a partition
    got = ["global_rank", "global_percent_rank"]
    rest = rows.join(F.broadcast(hot.select("_v")), "_v", "left_anti").join(ranks.filter(F.col("_n") * (4 * n) <= F.col("_all")).select("_v", *got), "_v")
    return rows.join(F.broadcast(hot.select("_v", *got)), "_v").unionByName(rest).drop("_v")


def sketched(df: DataFrame, by: Sequence[str], value: str, k: int = 4000) -> DataFrame:
    """``by, n, sketch``: a quantile sketch of bounded size per group. Sketches of parts add up to those of the whole (``merged``)."""
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k))
    return df.filter(F.col(value).isNotNull()).groupBy(*by).agg(sketch.alias("sketch")).withColumn("n", F.kll_sketch_get_n_double("sketch"))


def merged(sketches: DataFrame, by: Sequence[str], k: int = 4000) -> DataFrame:
    """Sketches of finer groups as those of ``by``, without reading the values again."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch")).withColumn("n", F.kll_sketch_get_n_double("sketch"))


def approximate(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """The sketches' rows with a column per quantile."""
    return sketches.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for name, q in quantiles.items()})
