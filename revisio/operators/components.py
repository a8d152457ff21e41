"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum and an equi-join, so that no neighbour list is ever
gathered and a hub's edges can be split by adaptive skew joins. Each round is cut to the
shared folder; the edges of the round before are then deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisio.plans.lineage import Scratch

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's greater neighbours to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its lesser neighbours to the least of these. Edges point from u down to v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): component is the least node that can be reached.

    Nodes without an edge to another node are not returned; self-loops and null ends are
    ignored. Values compare as Spark compares their type (strings by code point).
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "components")
    first = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = scratch.cut(first.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "round-0")
    state = None
    for turn in range(1, MAX_ROUNDS + 1):
        now = scratch.cut(_small_star(_large_star(now)), f"round-{turn}")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(f"round-{turn - 1}")
        if found == state or not found[0]:
            break
        state = found
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
