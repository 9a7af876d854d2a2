"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.plans.session import cut_lineage


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """node, component (smallest node) for undirected edges u, v of sortable ids.

    Each round is two min-aggregations, combined before the shuffle, each joined back to the edges; a hub's
    edges meet one row, so an adaptive skew join splits them. The rounds grow with the logarithm of the graph,
    not with its diameter. Self loops keep single nodes.
    """
    e = cut_lineage(edges.where("u is not null and v is not null").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u or v = u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = large.distinct()
        low = e.where("v <= u").groupBy("u").agg(F.min("v").alias("m"))
        joined = e.where("v <= u").join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        e = cut_lineage(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
