"""Connected components by alternating large-star and small-star steps, each
a shuffle; the edge table is written after each turn, so a lost executor costs
one turn at most, and nothing but a count reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import materialise

MAX_TURNS = 60


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node of an edge: label is the least node of its
    component. Loops and repeated edges do no harm; no edges, no rows."""
    e = materialise(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(),
        "edges")
    for _ in range(MAX_TURNS):
        # Large star: neighbours above a node go to the least of its
        # neighbourhood; the minimum is aggregated before it is joined back.
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: a node's lower neighbours, and itself, go to the least.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.withColumnRenamed("m", "v")).distinct())
        turned = materialise(small, "edges")
        # Done when all are stars: no node is a source twice, or both a source
        # and a target.
        e = turned
        roles = e.select(F.col("u").alias("node"), F.lit(1).alias("source"), F.lit(0).alias("target")).unionByName(
            e.select(F.col("v").alias("node"), F.lit(0).alias("source"), F.lit(1).alias("target")))
        if roles.groupBy("node").agg(F.sum("source").alias("s"), F.max("target").alias("t")).where(
                "s > 1 OR (s > 0 AND t > 0)").isEmpty():
            break
    else:
        raise RuntimeError(f"components unfinished after {MAX_TURNS} turns")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
