"""Order statistics without a group in one task, against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmill.operators import quantiles as q


def groups(spark, seed=1):
    r = random.Random(seed)
    rows = [("wide", r.lognormvariate(0, 8)) for _ in range(9000)]  # over many orders of magnitude
    rows += [("ties", float(r.choice([1, 1, 1, 2, 3]))) for _ in range(7000)] + [("one", 5.0)] * 6000
    rows += [("small", r.random()) for _ in range(7)] + [(None, r.random()) for _ in range(5000)] + [("none", None)] * 3
    rows += [("odd", x) for x in (float("nan"), None, 1.0, 2.0)] + [("signs", r.choice([-1, 1]) * r.expovariate(1)) for _ in range(4001)]
    r.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, x double").repartition(6)


@pytest.mark.parametrize("most", [1, 50, 1000, 10**9])
def test_exact_quantiles_equal_numpy(spark, most):
    rows, df = groups(spark)
    x = F.col("x")
    targets = {"p10": (x, 0.1), "mid": (x, 0.5), "top": (x, 1.0), "least": (x, 0.0), "odd": (F.when(x > 1.5, x), 0.25)}
    got = {r.g: r for r in q.exact_quantiles(df, ["g"], targets, most).collect()}
    assert set(got) == {g for g, _ in rows}
    for g, r in got.items():
        v = np.array([y for h, y in rows if h == g and y is not None and not np.isnan(y)])
        if not len(v):
            assert (r.p10, r.mid, r.top, r.odd) == (None,) * 4
            continue
        assert [r.p10, r.mid, r.top, r.least] == pytest.approx(np.quantile(v, [0.1, 0.5, 1, 0]).tolist(), rel=1e-12)
        big = v[v > 1.5]
        assert r.odd == (pytest.approx(float(np.quantile(big, 0.25))) if len(big) else None)


def test_quantiles_of_a_whole_table_and_of_nothing(spark):
    _, df = groups(spark)
    assert q.exact_quantiles(df, [], {"m": (F.col("x"), 0.5)}, 100).count() == 1
    assert q.exact_quantiles(df.limit(0), ["g"], {"m": (F.col("x"), 0.5)}).count() == 0


def test_no_task_holds_a_large_group(spark):
    """What is windowed in the end are the few values between the bounds: every row of a window's task counts."""
    df = spark.range(200_000).select((F.col("id") % 2).alias("g"), F.xxhash64("id").cast("double").alias("x")).repartition(8)
    ranks = spark.createDataFrame([((0,), 0, 49_999), ((1,), 0, 50_000)], "key struct<g: long>, t int, rank long")
    out = q._at_ranks(df.select(F.struct("g").alias("key"), F.lit(0).alias("t"), "x"), ranks, 1000)
    want = {g: sorted(r.x for r in df.filter(f"g = {g}").collect()) for g in (0, 1)}
    assert {r.key.g: r.value for r in out.collect()} == {0: want[0][49_999], 1: want[1][50_000]}
    plan = out._jdf.queryExecution().executedPlan()
    windows = [n for n in nodes(plan) if n.nodeName() == "Window"]
    shuffled = [next(n for n in nodes(w) if n.nodeName() == "Exchange").metrics().apply("shuffleRecordsWritten").value() for w in windows]
    assert len(shuffled) == 1 and 0 < shuffled[0] <= 2000  # of 200,000


def nodes(plan):
    out = [plan]
    if plan.nodeName() == "AdaptiveSparkPlan":
        return out + nodes(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return out + nodes(plan.plan())
    for i in range(plan.children().size()):
        out += nodes(plan.children().apply(i))
    return out


@pytest.mark.parametrize(("ascending", "nulls_first"), [(True, False), (False, True), (False, False)])
def test_global_ranks_equal_a_window(spark, ascending, nulls_first):
    r = random.Random(3)
    rows = [(i, r.choice([None, 1.0, 1.0, 1.0, 2.0, r.random(), -r.random()])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, x double").repartition(5)
    got = q.global_ranks(df, F.col("x"), ascending, nulls_first)
    assert got.columns == ["id", "x", "global_rank", "global_percent_rank"]
    order = {(1, 0): "x asc nulls last", (0, 1): "x desc nulls first", (0, 0): "x desc nulls last"}[ascending, nulls_first]
    want = df.selectExpr("id", f"rank() over (order by {order}) r", f"percent_rank() over (order by {order}) p").collect()
    assert {(x.id, x.global_rank, round(x.global_percent_rank, 12)) for x in got.collect()} == {(x.id, x.r, round(x.p, 12)) for x in want}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert q.global_ranks(df.limit(0), F.col("x")).count() == 0
    assert [x.global_percent_rank for x in q.global_ranks(df.filter("id = 5"), F.col("x")).collect()] == [0.0]


def test_sketches_of_days_are_those_of_the_whole(spark):
    r = random.Random(8)
    rows = [("a" if i % 3 else "b", i % 40, r.lognormvariate(0, 2)) for i in range(60_000)]
    df = spark.createDataFrame(rows, "g string, day int, x double")
    days = q.sketched(df, ["g", "day"], "x")
    both = [q.approximate(s, {"q25": 0.25, "q99": 0.99}) for s in (q.merged(days, ["g"]), q.sketched(df, ["g"], "x"))]
    for s in both:
        for row in s.collect():
            v = np.sort([x for g, _, x in rows if g == row.g])
            assert row.n == len(v)
            for p, x in ((0.25, row.q25), (0.99, row.q99)):
                assert abs(np.searchsorted(v, x) / len(v) - p) < 0.005
    assert max(len(x.sketch) for x in both[0].collect()) < 200_000 < 8 * len(v)
