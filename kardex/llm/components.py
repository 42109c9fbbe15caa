"""Connected components by alternating large-star and small-star steps.

Only edges travel.  Minimums are taken by aggregation (map-side combined), and
leave it inside a struct, so that the join back has an exchange on both sides
and the engine can split the partition of a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.llm.common import cut


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min(F.struct("a", "b")).alias("r")).select(
        F.col("r.a").alias("a"), F.col("r.b").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _smallest(both).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _smallest(down)
    links = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return links.union(low.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``edges(a, b)`` of long ids -> ``(node, component)`` for each node that
    has a link; ``component`` is the smallest node reachable.  Self links are
    ignored; no edges give no rows.  Raises if ``max_rounds`` do not settle it.
    """
    edges = cut(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or tuple(mark) == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = tuple(mark)
        edges = cut(_small_star(_large_star(edges)).distinct())
    raise RuntimeError("components did not settle")
