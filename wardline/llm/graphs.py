"""Connected components of a link table, by rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.session import stable

MAX_ROUNDS = 100


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _least_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a, b``, of one orderable type): the smallest node reachable.

    Alternates two rounds until nothing changes: every node hands its larger neighbours to its smallest one, then its
    smaller neighbours. The number of rounds grows with the logarithm of the longest chain, the number of links never
    grows. Each round is written to the shared folder, so a lost executor costs one round. Minima combine on the map
    side. They are written before the links are joined with them: adaptive execution splits the links of a hot node only
    where both sides are read from a shuffle. No links: an empty result.
    """
    links = stable(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _mark(links)
    for _ in range(MAX_ROUNDS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stable(_least_neighbour(both).select("a", F.least("a", "least").alias("least")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        large = stable(large)
        least = stable(_least_neighbour(large))
        small = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = stable(small.unionByName(least.select("a", F.col("least").alias("b"))).distinct())
        after = _mark(links)
        if after == before:
            roots = links.select(F.col("b").alias("node")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                roots.select("node", F.col("node").alias("root"))
            )
        before = after
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
