"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    tied = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of them. ``edges`` point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    tied = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b"))
    )
    return tied.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links (a, b)``: the least node of its component.

    Each round is written to the shared folder. The rounds end when they change nothing; their number grows with the
    logarithm of the longest chain. Hot nodes are aggregated on the map side, their joins are left to skew splitting.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(),
        "links",
    )
    while True:
        turned = stored(_small_star(_large_star(edges)), "stars")
        size, total = turned.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (size, total) == edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first():
            break
        edges = turned
    tied = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return tied.unionByName(roots)
