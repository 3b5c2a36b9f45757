"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from creditweave.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every neighbour above a node on the least node of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its lower neighbours on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    lower = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that is not the least of its component.

    ``edges`` has columns ``u, v`` of one orderable type; loops and repeats are
    allowed. Neighbourhoods are folded by map-side minima, so that a node with
    a third of all edges is no group in memory; edges are written after every
    round, in the shared folder. Rounds are logarithmic in the component size.
    """
    edges = cut_lineage(edges.where("u <> v").select("u", "v").distinct())
    state = None
    while True:
        facts = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if facts == state or facts[0] == 0:
            return edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
        state = facts
        edges = cut_lineage(_small_star(_large_star(edges)))
