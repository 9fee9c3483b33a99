"""Connected components of a graph given as a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlake.llm.scratch import Scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _relinked(edges: DataFrame, larger: bool) -> DataFrame:
    """Every node's neighbours (the larger ones, or else itself and the smaller ones) linked to the least of them all.

    The least neighbour is an aggregate that is combined before the shuffle, and the join back is an inner join whose
    large partitions are split at run time, so a node with very many neighbours is no single task's work.
    """
    ways = _both_ways(edges)
    ways = ways if larger else ways.where("b < a")
    least = ways.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
    linked = ways.where("b > a") if larger else ways
    out = linked.join(least, linked["a"] == least["node"]).select(F.col("least").alias("a"), "b")
    if not larger:
        out = out.union(least.select(F.col("least").alias("a"), F.col("node").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of `edges` (a, b), the component named by its least node.

    Each round is written to the scratch folder; rounds end when neither step changes the edges, which then are stars.
    The number of rounds grows with the logarithm of the largest component.
    """
    edges = scratch.table(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        edges = scratch.table(_relinked(_relinked(edges, True), False))
        after = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        edges.select("a", "a").distinct()
    )
