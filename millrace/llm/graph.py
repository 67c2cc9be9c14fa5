"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import broadcast_if_small
from millrace.workspace import cut_lineage, temporary_copies

# Neighbours from which on a node is a hub, and hubs that may be broadcast (a few MB).
HUB = 100_000
HUBS_BROADCAST = 100_000


def with_least(pairs: DataFrame, least: DataFrame, hub: int) -> DataFrame:
    """``pairs`` with the row (u, n, m) of ``least`` for each ``u``.

    The rows of a node with at least ``hub`` neighbours stay where they are: there are at most
    rows / ``hub`` such nodes, and behind a check of their number these go to the rows. The others meet
    in a shuffle, which brings fewer than ``hub`` rows of one node to a task.
    """
    hubs = least.where(F.col("n") >= hub)
    if hubs.isEmpty():
        return pairs.join(least, "u")
    hubs = broadcast_if_small(hubs, HUBS_BROADCAST)
    at_hubs = pairs.join(hubs, "u")
    return pairs.join(hubs, "u", "left_anti").join(least.where(F.col("n") < hub), "u").unionByName(at_hubs)


def components(edges: DataFrame, a: str = "a", b: str = "b", hub: int = HUB) -> DataFrame:
    """(node, component): each node of an edge with the smallest node of its component.

    Alternating large and small stars: every step hangs a node's neighbours onto the smallest one, so
    chains shorten fast and the table never grows beyond its edges. All steps are joins and aggregations
    whose partial results are one row per node, and no task gets all neighbours of a hub. Each round is
    written to the shared folder, so a lost executor costs one round at most; what a round wrote on its
    way goes with it. Null ends and loops are left out, repeated edges count once.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    now = cut_lineage(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        with temporary_copies(spark) as keep:
            now = keep(one_round(now, hub), "edges")
        reached = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 2**31)).first())
        if reached == state:
            break
        state = reached
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def one_round(now: DataFrame, hub: int) -> DataFrame:
    """A large star, then a small one: edges (u, v) that all lead down, from those of the round before."""
    both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("m"))
    least = cut_lineage(least.withColumn("m", F.least("u", "m")), "least")
    large = with_least(both, least, hub).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = cut_lineage(large.where("u != v").distinct(), "large")
    # Now every edge leads down; hang all lower neighbours of a node, and itself, onto the lowest.
    least = cut_lineage(large.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("m")), "least")
    small = with_least(large, least, hub).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
