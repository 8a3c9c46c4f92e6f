"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebook.llm.shared import stored

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours under the smallest it knows.

    Minima are stored, so that the join reads two stored tables and Spark can split a node
    that many links share; a join on an aggregate is never split.
    """
    both = _both_ways(edges)
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return (
        both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its smaller neighbours, and itself, under the smallest of them."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of a link (a, b), the root being its smallest node.

    ``edges`` must have a > b. Rounds repeat until the links no longer change; each is
    stored, so a lost executor costs one round. Minima are partial sums before they
    shuffle, and hot nodes are split in the joins.
    """
    def state(frame: DataFrame) -> tuple:
        return frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    current = stored(edges.select("a", "b").distinct(), "links")
    before = state(current)
    for _ in range(MAX_ROUNDS):
        current = stored(_small_star(_large_star(current)), "links")
        now = state(current)
        if now == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now
    raise RuntimeError(f"links still change after {MAX_ROUNDS} rounds")
