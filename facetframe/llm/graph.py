"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetframe.sources.scratch import stored


def _towards_least(both: DataFrame, only_smaller: bool) -> DataFrame:
    """Links from neighbours to the least node in reach: larger neighbours, or smaller ones."""
    near = both.filter(F.col("b") < F.col("a")) if only_smaller else both
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if not only_smaller:
        moved = both.filter(F.col("b") > F.col("a")).join(least, "a")
        return moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    moved = near.join(least, "a").filter(F.col("b") != F.col("m"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    )


def components(links: DataFrame, name: str, *, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for every node of ``a``-``b`` links.

    Each round turns the links into stars around smaller nodes; the least neighbour is combined
    before the shuffle, and joins on a node with very many links are split by adaptive execution.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stored(links.filter(F.col("a") != F.col("b")).select(a, b).distinct(), name)
    digest = None
    for _ in range(most_rounds):
        mark = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31)), F.sum("b")
        ).first()
        if mark == digest:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        digest = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _towards_least(both, only_smaller=False).distinct()
        edges = stored(_towards_least(large, only_smaller=True).distinct(), name)
    raise RuntimeError(f"no components after {most_rounds} rounds")
