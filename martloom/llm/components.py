"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.llm.runtime import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """Columns node and component (the smallest node reachable) for every node of an edge.

    ``edges`` has columns a and b of one orderable type; direction, loops and repeats do not matter,
    and an edge with a null end is ignored. Edges are rewired round by round: first every larger
    neighbour of a node is tied to the smallest one, then every smaller neighbour. The number of
    edges does not grow, a node with very many neighbours is aggregated map-side and split by Spark in
    the joins (what is joined to it is written first), and after a few rounds (they grow with the logarithm of the longest path) every node is tied to its smallest.
    """
    ordered = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = scratch.keep(ordered.distinct(), name)
    nodes = scratch.keep(edges.select(F.explode(F.array("a", "b")).alias("node")).na.drop().distinct(), f"{name}-nodes")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{name}-least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = scratch.keep(large, f"{name}-large")
        # in every edge a > b: a's smaller neighbours, and a itself, go to the smallest of them
        least = scratch.keep(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-least")
        small = (
            large.join(least, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .filter("a != b")
            .distinct()
        )
        now = scratch.keep(small, name)
        after = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    found = nodes.join(now.groupBy("a").agg(F.min("b").alias("m")), F.col("node") == F.col("a"), "left").select(
        "node", F.coalesce("m", "node").alias("component")
    )
    scratch.drop(f"{name}-large", f"{name}-least")
    return found
