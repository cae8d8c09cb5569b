"""Connected components of a graph whose edges lie in a table.

Each round every node takes the smallest node among itself and its neighbours, a pointer jump shortens the chains, and
the edges are drawn anew between what remains. Rounds grow with the logarithm of the longest path. Everything is joins
and partial aggregates, so a node with very many edges is split like any other skewed join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges: a, b (long, not null). Returns id, root for every node that has an edge to another: its smallest reachable node."""
    edges = scratch.table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    whole = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("m"))
        least = scratch.table(least)
        hop = least.select(F.col("id").alias("m"), F.col("m").alias("up"))
        jumped = scratch.table(least.join(hop, "m").select("id", F.col("up").alias("m")))
        ends = [jumped.select(F.col("id").alias(x), F.col("m").alias(f"m{x}")) for x in "ab"]
        left = scratch.table(edges.join(ends[0], "a").join(ends[1], "b").filter("ma <> mb").select(F.greatest("ma", "mb").alias("a"), F.least("ma", "mb").alias("b")).distinct())
        if whole is None:
            after = jumped.select("id", F.col("m").alias("root"))
        else:
            step = jumped.select(F.col("id").alias("root"), F.col("m").alias("next"))
            after = scratch.table(whole.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root")))
            scratch.drop(whole)
        scratch.drop(edges, least)
        whole, edges = after, left
        if not hasattr(whole, "_scratch_path"):
            whole = jumped.withColumnRenamed("m", "root")
            whole._scratch_path = jumped._scratch_path
    scratch.drop(edges)
    return whole if whole is not None else scratch.spark.createDataFrame([], "id long, root long")
