"""Connected components of an undirected link table by alternating stars.

Large-star and small-star steps (Kiveris et al., 2014) are plain joins and
minimum aggregates on the node id: the minimum is pre-aggregated before the
shuffle, a hub's links are only ever joined with one row per node, and every
round is cut with ``checkpoint()`` in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.session import checkpoint_root


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over links (a, b) with a > b."""
    if large:
        sym = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sym.groupBy("a").agg(F.min("b").alias("m")) \
                 .select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        # every neighbour above the node moves to the node's minimum
        moved = edges.select(F.col("b").alias("k"), F.col("a").alias("v")).join(low, "k")
        return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
    low = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
    joined = edges.select(F.col("a").alias("k"), "b").join(low, "k")
    out = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.unionByName(low.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct()


def _digest(edges: DataFrame):
    r = edges.agg(F.count("*").alias("n"),
                  F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node
    id reachable. ``links`` has long columns a and b in either order; loops,
    repeats and nulls are ignored."""
    spark = links.sparkSession
    checkpoint_root(spark)
    edges = (links.where("a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .distinct().checkpoint())
    seen = _digest(edges)
    while seen[0]:
        edges = _star(_star(edges, True), False).checkpoint()
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")))
            .distinct())
