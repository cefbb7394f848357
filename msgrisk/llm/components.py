"""Connected components by alternating stars, without collecting links or labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from msgrisk.llm.tables import stored

MOST_ROUNDS = 40


def _towards_least(edges: DataFrame, only_larger: bool) -> DataFrame:
    """Link neighbours of every node to the least of them and the node itself.

    Large star (only_larger): neighbours above the node move. Small star: neighbours below it and the node move.
    """
    if only_larger:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = near.join(least, "u")
    if only_larger:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and root (the least node of its component) for every node with an edge to another node."""
    edges = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "component-edges")
    before = None
    for _ in range(MOST_ROUNDS):
        edges = stored(_towards_least(_towards_least(edges, True), False), "component-edges")
        # A star forest no longer changes: compare order-free sums of the edges.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
