"""Connected components of a graph given by its edges, as distributed rounds of star operations.

A round links every node's larger neighbours to the smallest node of its neighbourhood (large star),
then its smaller ones (small star), until each component is one star around its smallest node. A hub
meets its many edges in a join that Spark can split, and minima are taken per task before a shuffle.
Each step is written to the shared folder, so that a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Workspace


def minima(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """Of each node ``a`` of edges (a, b), the smallest of itself and its ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return workspace.keep(least.select("a", F.least("a", "least").alias("least")), "minima")


def star_round(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """One large and one small star over edges (a, b) with a > b; the same kind of edges."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = both.where("b > a").join(minima(both, workspace), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    large = workspace.keep(large.distinct(), "large")
    least = minima(large, workspace)
    small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    roots = least.select("a", F.col("least").alias("b"))
    return workspace.keep(small.unionByName(roots).where("a <> b").distinct(), "small")


def state(edges: DataFrame) -> tuple:
    """A digest of the set of edges: their number and an order-free sum of hashes."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, workspace: Workspace) -> DataFrame:
    """(node, root) of every node that has a link; root: the smallest node it reaches.

    ``links``: columns a and b in any order, of any type that has an order; loops count for nothing.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = workspace.keep(edges.distinct(), "links")
    before = state(edges)
    while before[0]:
        edges = star_round(edges, workspace)
        after = state(edges)
        if after == before:
            break
        before = after
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
