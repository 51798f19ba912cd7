"""Connected components of an edge table, by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, join_groups, table


def _to_smallest(pairs: DataFrame, larger_only: bool, total: int) -> DataFrame:
    """Link the neighbours ``v`` of each ``u`` to the smallest of them and u; only the neighbours above u if told."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    joined = join_groups(pairs, least, ["u"], total)
    if larger_only:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.filter("u <> m").select("u", F.col("m").alias("v")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``: root is the smallest node that edges lead to.

    Each round is two aggregations with map-side combine and two joins that send the hubs' smallest neighbours to every
    task, so that the leaves of a star stay where they are; no neighbourhood is ever collected. Each round is written to the
    shared folder, and the one before is deleted. Self-loops and repeated edges change nothing; no edges, no rows. ``rounds`` guards against a fault only:
    stars need O(log^2 n) rounds, and not having converged raises.
    """
    spark = edges.sparkSession
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    now, seen = table(now, "edges"), None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        seen, total = state, 2 * state[0]
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_smallest(both, True, total).filter("u <> v").distinct()
        small = _to_smallest(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), False, total)
        was, now = now, table(small.distinct(), "edges")
        discard(was)
    raise RuntimeError(f"components did not converge in {rounds} rounds on {spark.sparkContext.applicationId}")
