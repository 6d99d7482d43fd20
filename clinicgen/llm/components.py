"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicgen.llm.common import cut


def _least(pairs: DataFrame) -> DataFrame:
    """Per node ``a`` the least of itself and its neighbours ``b``; aggregated before any join."""
    return pairs.groupBy("a").agg(F.min("b").alias("lo")).select("a", F.least("a", "lo").alias("lo"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_least(both), "a").where("b > a and b <> lo").select(F.col("b").alias("a"), F.col("lo").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    return (down.join(least, "a").where("b <> lo").select(F.col("b").alias("a"), F.col("lo").alias("b"))
            .union(least.where("a <> lo").select("a", F.col("lo").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of ``edges`` (a, b) with the least node of its component.

    Ends when a round changes nothing; the edges never grow in number, and each round is
    written to the shared folder. No edges: no rows.
    """
    current = cut(edges.where("a <> b").select("a", "b").distinct(), "cc-edges")
    mark = None
    while True:
        current = cut(_small_star(_large_star(current)), "cc-edges")
        # order-free mark of the edge set: count and two sums of hashes
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("a", "b").cast("bigint"))).first()
        if now == mark:
            break
        mark = now
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(current.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
