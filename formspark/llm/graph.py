"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formspark.llm.shared import checkpointed

MAX_ROUNDS = 64


def components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``edges`` (columns ``a``, ``b``, both bigint).

    Large-star and small-star steps alternate until the edges are stars. Only grouped minima and equality joins are
    used, so a node with very many neighbours is combined map-side and its join can be split. Self-loops, repeated and
    turned edges are allowed; edges with a null end are ignored; no edges give no rows. Raises if ``max_rounds`` do not
    suffice (rounds grow with the logarithm of the longest path).
    """
    loops = edges.filter(F.col("a") == F.col("b")).select(F.col("a").alias("u"))
    now = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = checkpointed(now)
    before = None
    for _round in range(max_rounds):
        now = checkpointed(_small_star(_large_star(now)))
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
        if state == before:
            stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            nodes = stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")))
            alone = loops.select(F.col("u").alias("node"), F.col("u").alias("root"))
            return nodes.unionByName(alone).groupBy("node").agg(F.min("root").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; every edge leads to a smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
