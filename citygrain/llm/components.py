"""Connected components of a graph given as a table of edges, with joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.session import staged

#: Nodes with more edges than this are hubs, whose rows no task gathers.
HUB_EDGES = 100

#: Hubs at most. More edges raise the number that makes a hub, so what is broadcast stays this small.
MOST_HUBS = 100_000


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b), which are numbers; a component is named by its least node.

    Alternates two steps that keep connectivity: every node hands its larger neighbours to the
    smallest node of its neighbourhood, then its smaller ones. The graph becomes a set of stars in a
    number of rounds that grows with the logarithm of its size. Each step writes the least neighbour of
    every node, by one aggregation, and the new edges, by one join; so plans stay small and a lost
    executor costs one step at most. Hubs meet their edges by broadcast.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _summary(edges)
    for _ in range(most_rounds if seen[0] else 0):
        # A round's graph has twice as many rows at most, and its larger part three times as many.
        hub = max(HUB_EDGES, 3 * seen[0] // MOST_HUBS)
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both, F.least("a", F.min("b")))
        large = _with_least(both, least, hub).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(least.where("m < a").select("a", F.col("m").alias("b"))).where("a <> b")
        large = staged(large.distinct(), "large")
        lowest = _least(large, F.min("b"))
        small = _with_least(large, lowest, hub).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.union(lowest.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, seen = seen, _summary(edges)
        if before == seen:
            break
    else:
        if seen[0]:
            raise RuntimeError("the components did not settle")
    stars = edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


def _least(edges: DataFrame, least) -> DataFrame:
    """(a, m, n): ``least`` of every node and its number of edges, written once."""
    return staged(edges.groupBy("a").agg(least.alias("m"), F.count(F.lit(1)).alias("n")), "least")


def _with_least(edges: DataFrame, least: DataFrame, hub: int) -> DataFrame:
    """``edges`` (a, b) with m, the least of ``a``; nodes of more than ``hub`` edges are joined without a shuffle."""
    hubs = least.where(F.col("n") > hub).select("a", F.col("m").alias("_m"))
    met = edges.join(F.broadcast(hubs), "a", "left")
    rest = least.where(F.col("n") <= hub).select("a", F.col("m").alias("_rest"))
    # A hub's rows have no partner here; without a key they are dealt out by no key either.
    own = F.when(F.col("_m").isNull(), F.col("a")).otherwise(F.xxhash64("a", "b"))
    met = met.withColumn("_own", own).join(rest.withColumnRenamed("a", "_of"), (F.col("_own") == F.col("_of")) & F.col("_m").isNull(), "left")
    return met.select("a", "b", F.coalesce("_m", "_rest").alias("m"))


def _summary(edges: DataFrame) -> tuple:
    """Number and sum of hashes of the edges, which differ if the edges do."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
