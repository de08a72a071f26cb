"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, materialise


def _tally(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum((F.xxhash64("x", "y") % (1 << 40)).cast("decimal(38,0)"))).first())


def components(edges: DataFrame, scratch: list[str] | None = None, most: int = 60) -> DataFrame:
    """(node, root) for every node of edges (x, y), root being the smallest node that links reach.

    Every step only takes minima by node and joins them back, so a node with very many links is
    pre-aggregated and split like any other; the steps' number grows with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    now = edges.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).filter("x < y").distinct()
    now, tally, old = materialise(now, "edges", paths := []), None, []
    for _ in range(most):
        both = now.select(F.col("x").alias("u"), F.col("y").alias("v")).unionByName(now.select(F.col("y").alias("u"), F.col("x").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("x"), F.col("v").alias("y")).filter("x < y").distinct()
        # in large every edge is (smaller, larger): small-star at the larger end
        floor = large.groupBy("y").agg(F.min("x").alias("m"))
        small = large.join(floor, "y").select(F.col("m").alias("a"), F.explode(F.array("x", "y")).alias("b")).filter("a < b").select(F.col("a").alias("x"), F.col("b").alias("y")).distinct()
        old, paths = paths, []
        now = materialise(small, "edges", paths)
        drop_scratch(spark, old)
        after = _tally(now)
        if after == tally:
            break
        tally = after
    else:
        raise RuntimeError("components: more steps than any graph should need")
    if scratch is not None:
        scratch += paths
    return now.select(F.col("y").alias("node"), F.col("x").alias("root")).unionByName(now.select(F.col("x").alias("node"), F.col("x").alias("root")).distinct())
