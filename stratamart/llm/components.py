"""Connected components by alternating large-star and small-star.

Edges are a DataFrame of two ids. A large-star round links every neighbour above a
node to the smallest of its neighbourhood; a small-star round does so for the
neighbours below it and the node itself. Both keep what is connected connected. Rounds
end when every node with an edge to a smaller one has no other edge: it then hangs on the
smallest id of its component. A hub's edges are dealt over salts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import HOT_SHARE, spread_join, stage


def _to_least(pairs: DataFrame) -> DataFrame:
    """Rows (u, v, m): m is the smallest of u and its v's."""
    least = stage(
        pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        .withColumn("m", F.least("u", "m")), "least")
    total, most = least.agg(F.sum("n"), F.max("n")).first()
    bound = max(2, (total or 0) * HOT_SHARE)
    hot = [r[0] for r in least.where(F.col("n") >= bound).select("u").collect()] if (most or 0) >= bound else []
    return spread_join(pairs, least.drop("n"), "u", hot, F.col("v"))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node below another has that one edge only."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    unsettled = ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where(
        "down > 1 OR (down = 1 AND up = 1)")
    return unsettled.count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node with an edge to another node; component: smallest id."""
    edges = stage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v").distinct(), "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "large-star")
        small = _to_least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "small-star")
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
