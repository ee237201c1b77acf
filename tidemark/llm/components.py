"""Connected components of a link table, by alternating star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Each round points a node's larger neighbours, then its smaller ones, to the smallest node around it. Minima are
    partial aggregates and the joins carry one row per node on one side, so a node with very many links is
    pre-aggregated and its rows can be split. Rounds grow with the logarithm of the longest chain; they end when one
    aggregate over the nodes finds that all links are stars, which another round would leave as they are.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = cut_lineage(edges)
    while True:
        back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = edges.unionAll(back).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Repeats are no more than the edges; the last step of the round removes them.
        large = back.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        before, edges = edges, cut_lineage(small)
        release(before)
        if _stars(edges):
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """If every ``u`` has one link, to a ``v`` that is nobody's ``u``."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionAll(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    told = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return told.agg(F.count_if((F.col("out") > 1) | (F.col("out") + F.col("in") > 1))).first()[0] == 0
