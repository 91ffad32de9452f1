"""Connected components over links, as DataFrame joins (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.sources.staging import stage


def _settled(edges: DataFrame) -> bool:
    """True if every node has one parent and no parent has a parent."""
    twice = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    nested = edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi")
    return twice.isEmpty() and nested.isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    met = edges.join(least, "a")
    return met.select("a", F.col("m").alias("b")).union(
        met.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def connected(links: DataFrame) -> DataFrame:
    """(a, b): every linked node that is not the least of its component, with that least node.

    ``links`` has two columns of one orderable type. Each round is written to shared storage,
    so a lost executor costs a round at most; the number of rounds grows with the logarithm of
    the longest chain. Nodes without links don't appear; links of a node to itself are ignored.
    """
    a, b = links.columns
    edges = stage(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a != b").distinct(),
        "links",
    )
    while not _settled(edges):
        edges = stage(_small_star(_large_star(edges).distinct()).distinct(), "links")
    return edges
