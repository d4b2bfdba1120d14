"""Connected components of a graph given by its edges, by alternating stars.

A large star links every larger neighbour of a node to the least of its neighbours, a small star every smaller one;
rounds of both end in one star around the least node of each component. Minima are aggregated before
the shuffle and then joined to the edges of their node from a stored table, so that a node with very many edges is split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import Work

MOST_ROUNDS = 99


def _star(edges: DataFrame, work: Work, name: str, large: bool) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    seen = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else down
    least = work.stored(
        seen.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")), f"{name}-least"
    )
    met = seen.join(least, "u")
    if large:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return work.stored(out.where(F.col("a") != F.col("b")).distinct(), name)


def components(edges: DataFrame, work: Work, name: str = "components") -> DataFrame:
    """``node`` and ``component`` (its least node) for all nodes of the edges ``a``, ``b``, but the
    least ones themselves."""
    edges = work.stored(edges.where(F.col("a") != F.col("b")).distinct(), f"{name}-0")
    before = None
    for n in range(1, MOST_ROUNDS + 1):
        edges = _star(edges, work, f"{name}-{n}-large", True)
        edges = _star(edges, work, f"{name}-{n}-small", False)
        # Two numbers that are the same only if the edges are.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
    raise RuntimeError(f"the components {name!r} are unfinished after {MOST_ROUNDS} rounds")
