"""Connected components of a graph of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.llm.arrays import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least of them: the larger ones (large star) or the smaller ones.

    The least neighbour is found by an aggregate that combines before its shuffle; a node with
    very many neighbours meets it in a join that Spark can split.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.where("b > a").join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").where("b <> m").select(F.col("b").alias("x"), F.col("m").alias("y"))
    return hung.union(least.select(F.col("a").alias("x"), F.col("m").alias("y")))


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every node of ``links`` (a, b): the least id it can reach.

    Each round's edges are written to the shared folder, so no lineage grows and an executor
    that is lost costs one round's tasks at most.
    """

    def told(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(links.select("a", "b").where("a <> b").distinct(), "edges")
    before = told(edges)
    while before[0]:
        for large in (True, False):
            stars = _stars(edges, large).where("x <> y")
            edges = stored(stars.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
        now = told(edges)
        if now == before:
            break
        before = now
    # every edge now leads from a node to its component's least
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
