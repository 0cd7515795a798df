"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

MAX_ROUNDS = 60


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """node, component (the smallest node of it), for every node of an edge that joins two nodes.

    Large star: every larger neighbour of a node is linked to the smallest of its neighbourhood; small
    star: the smaller neighbours are. Both keep components whole and the rounds grow with the
    logarithm of the longest path. Minima are combined before shuffles; each round is cut by a checkpoint.
    """
    e = edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).where("a > b").distinct()
    e = cut(e)
    seen = _fingerprint(e)
    for _ in range(MAX_ROUNDS):
        both = e.select(F.col("a").alias("n"), F.col("b").alias("o")).unionAll(e.select(F.col("b").alias("n"), F.col("a").alias("o")))
        # minima are cut off so that each join has plain shuffles on both sides, which AQE can split at a hot node
        least = cut(both.groupBy("n").agg(F.min("o").alias("m")).select("n", F.least("n", "m").alias("m")))
        large = both.where("o > n").join(least, "n").select(F.col("o").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large)
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b"))))).where("a > b").distinct()
        e = cut(small)
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(e.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component")))
