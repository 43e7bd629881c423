"""Connected components of an undirected graph by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewise.llm.common import stored


def _trees(edges: DataFrame) -> DataFrame:
    """``key, root``: every node hangs below its smallest neighbour if that is smaller, and finds the root of its tree."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hung = stored(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        above = hung.select(F.col("key").alias("root"), F.col("root").alias("further"))
        moved = stored(hung.join(above, "root").select("key", "root", "further"))
        hung = moved.select("key", F.col("further").alias("root"))
        if moved.filter("root <> further").isEmpty():
            return hung


def components(edges: DataFrame) -> DataFrame:
    """``key, root`` for every end of an edge of ``edges`` (``a``, ``b``): the smallest key it can reach.

    Each round hangs nodes below smaller neighbours and draws each tree together into its root, so that few
    edges are left for the next.  Labels and edges stay distributed, and each round is stored, so that neither
    plan nor lineage grows.
    """
    edges = stored(edges.filter("a <> b").select("a", "b").distinct())
    labels = None
    while labels is None or not edges.isEmpty():
        trees = _trees(edges)
        ends = [trees.select(F.col("key").alias(end), F.col("root").alias(f"r_{end}")) for end in "ab"]
        drawn = edges.join(ends[0], "a").join(ends[1], "b").filter("r_a <> r_b")
        edges = stored(drawn.select(F.col("r_a").alias("a"), F.col("r_b").alias("b")).distinct())
        if labels is None:
            labels = trees
        else:
            above = trees.select(F.col("key").alias("root"), F.col("root").alias("further"))
            labels = stored(labels.join(above, "root", "left").select("key", F.coalesce("further", "root").alias("root")))
    return labels
