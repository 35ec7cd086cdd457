"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one: larger neighbours of each node, or the node and its smaller ones."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("root"))
        near = edges.join(least, "a")
        out = near.where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(
            least.select("a", F.col("root").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in a link (a, b); root is the smallest node reachable.

    Nodes without links have no row. Each round is written, so lineage does not
    grow. Minima are aggregated map-side; the join that hands them to a node's links
    is by node, so the links of a node with very many are joined in one task unless
    the adaptive skew join splits them.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stage(links.where("a <> b").select(a, b).distinct(), "cc")
    mark = None
    while True:
        edges = stage(_star(_star(edges, True), False), "cc")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
