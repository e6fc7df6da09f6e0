"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm.ordered import kept


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs a node's larger neighbours on the least node among it and its neighbours."""
    both = edges.union(edges.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = both.groupBy("node").agg(F.min("low").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return both.join(least, "node").where("low > node").select(F.col("low").alias("node"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the least of these."""
    least = edges.groupBy("node").agg(F.min("low").alias("least"))
    moved = edges.join(least, "node").where("low > least").select(F.col("low").alias("node"), F.col("least").alias("low"))
    return moved.union(least.select("node", F.col("least").alias("low"))).distinct()


def connect(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node of the pairs (a, b) but the roots: the least node of its component.

    Every half round is one table on shared storage, so a lost executor costs no more.
    A node with very many neighbours is pre-aggregated before its minimum is
    taken, and its join is one that adaptive execution can split.
    """
    edges = pairs.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")).distinct()
    edges, before = kept(edges), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "low").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select("node", F.col("low").alias("root"))
        before, edges = state, kept(_small_star(kept(_large_star(edges))))  # two short plans
