"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so a node with very many
neighbours is one key whose minimum is combined before the shuffle. The edges
are written to the shared checkpoint folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import materialize

MAX_ROUNDS = 50


def _toward_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of each node u to the least id among u and them (only the larger ones, or those and u)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if larger_only else both.where(F.col("b") < F.col("a"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    if larger_only:
        near = near.where(F.col("b") > F.col("a"))
    linked = near.join(least, "a").select(F.col("m").alias("a"), "b")
    if not larger_only:
        linked = linked.unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return linked.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of `edges` (a, b): component is the least node reachable."""
    e = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    seen = None
    for _ in range(MAX_ROUNDS):
        e = materialize(_toward_least(_toward_least(e, True), False), name)
        # a star forest no longer changes; its edge count and sum tell
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        seen = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
