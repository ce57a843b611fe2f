"""Connected components of a table of links, without any of it on the driver.

Rounds of two steps: every node's larger neighbours are linked to the smallest node it sees, then its
smaller ones are. Paths shorten until each node is linked to its component's smallest. Both steps are
an aggregation and a join on the node, so a node with many neighbours is pre-aggregated, and AQE may
split it in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.frames import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m"))
    least = least.select("a", F.least("a", "_m").alias("_m"))
    larger = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # Links of a node to larger neighbours, and of the node itself where it is not the smallest.
    moved = larger.join(least, "a").select(F.col("_m").alias("a"), "b")
    own = least.filter("_m < a").select(F.col("_m").alias("a"), F.col("a").alias("b"))
    return moved.union(own).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``a < b`` in all rows: ``b``'s smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("_m"))
    joined = edges.join(least, "b")
    moved = joined.filter("a <> _m").select(F.col("_m").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("_m").alias("a"), "b")
    return moved.union(own).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (``a``, ``b``; direction and repeats don't matter);
    the root is the component's smallest node. No edges give no rows."""
    edges = stored(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = tuple(
            edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )
        if now == before or not now[0]:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
