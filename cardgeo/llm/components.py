"""Connected components of a graph of long node ids, by alternating large-star
and small-star steps; every step is joins and partially aggregated groupings,
and its result is checkpointed in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").where("v > u and v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger node u to the smaller v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(low, "u").where("v != m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def _downward(edges: DataFrame) -> DataFrame:
    return (edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (u, v); root is the smallest
    node of its component. Ends when a round changes nothing, after about
    log(n) ** 2 rounds at most."""
    now = materialize(_downward(edges), "components")
    mark = _mark(now)
    while True:
        now = materialize(_downward(_small_star(_downward(_large_star(now)))), "components")
        seen, mark = mark, _mark(now)
        if seen == mark:
            break
    star = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
