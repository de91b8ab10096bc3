"""Connected components of links by alternating star contractions, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import attach
from assetlake.session import cut_lineage


def _least(edges: DataFrame) -> DataFrame:
    """(u, n, m): the number of links of ``u`` and the least of its neighbours, stored."""
    return cut_lineage(edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("m")), "cc-least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = cut_lineage(edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "cc-both")
    met = attach(both, _least(both), ["u"], "n", "inner").withColumn("m", F.least("u", "m"))
    return cut_lineage(met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")


def _small_star(edges: DataFrame) -> DataFrame:
    met = attach(edges, _least(edges), ["u"], "n", "inner")
    moved = met.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = met.select("u", F.col("m").alias("v"))
    return cut_lineage(moved.unionAll(own).distinct(), "cc-small")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 24))).first())


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root): for every node of a link (long columns ``u``, ``v``) that is not its component's least node, that
    least node.

    Large-star and small-star steps alternate until the links no longer change; the number of rounds grows with the
    logarithm of the components' size. A node with very many links never meets them in one task: the least neighbour
    is a partial aggregate and hot nodes are joined by broadcast. Each step is a table in the shared folder.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = cut_lineage(edges, "cc-links")
    mark = _mark(edges)
    while mark[0]:
        edges = _small_star(_large_star(edges))
        after = _mark(edges)
        if after == mark:
            break
        mark = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
