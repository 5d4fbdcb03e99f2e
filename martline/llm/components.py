"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import written


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of a link; root is the component's smallest node.

    Each round hangs every neighbour under the smallest one it can see: a
    groupBy with map-side minima and a join of rows of two longs.  Rounds stop
    when the links no longer change, after about the logarithm of the largest
    component's size squared; each round's links are written, so a lost
    executor never replays earlier rounds.  A graph that has not settled
    after ``max_rounds`` raises.  No links give no rows.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .filter("u <> v").distinct(), "links")
    state = _state(edges)
    for _ in range(max_rounds):
        edges = written(_small_star(_large_star(edges)), "links")
        before, state = state, _state(edges)
        if state == before:
            roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    """Number and order-free hash of the links; equal states mean a settled graph."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
