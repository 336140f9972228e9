"""Connected components by alternating large-star and small-star rounds.

Every round replaces a node's links by links to its smallest neighbour.  Each
step is an aggregate (combined before the shuffle) and a join that adaptive
execution can split, so a hub with a third of all links is no single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link other than the component itself."""
    a, b = edges[u], edges[v]
    now = materialize(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = None
    while True:
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == state or not sign[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = sign
        now = materialize(_small_star(materialize(_large_star(now), "large-star")), "small-star")
