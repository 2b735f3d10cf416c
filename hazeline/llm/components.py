"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that links (``a, b``) reach, for each linked node.

    Rounds of large and small stars: each node's larger neighbours, then its smaller ones, are
    linked to the smallest of its neighbourhood, until nothing changes. The number of links
    never grows, and the rounds grow with the logarithm of the nodes. Each round is stored.
    """
    edges = stored(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        edges = stored(_small(_large(edges)), "links")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
            )
        before = now


def _least(pairs: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, a row per node, by partial minima."""
    return pairs.groupBy("node").agg(F.min("near").alias("low"))


def _large(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
    )
    low = _least(both).select("node", F.least("node", "low").alias("low"))
    return (
        both.filter("near > node")
        .join(low, "node")
        .select(F.col("low").alias("a"), F.col("near").alias("b"))
        .distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them; ``a < b`` throughout."""
    low = edges.groupBy("b").agg(F.min("a").alias("low"))
    moved = edges.join(low, "b").select(F.col("low").alias("a"), F.col("a").alias("b"))
    return (
        moved.unionByName(low.select(F.col("low").alias("a"), "b")).filter("a < b").distinct()
    )
