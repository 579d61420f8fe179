"""Which zip an area mostly lies in: sample its outline, locate, vote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.text import seeded_order
from wardline.operators.spatial import ZoneIndex, locate

# Outline points drawn per area.
SAMPLE_SIZE = 20


def sample_per_group(
    df: DataFrame,
    group: Sequence[str],
    identity: Sequence[str],
    size: int = SAMPLE_SIZE,
    seed: int = 42,
    ties: Sequence[str] = (),
) -> DataFrame:
    """At most ``size`` rows per group in seeded random order, the same on every run.

    ``identity`` names a row for the draw; rows that share one are ordered by ``ties``.

    The rank filter plans as a group limit before the shuffle, so a large group
    sends ``size`` rows per task.
    """
    order = [seeded_order(seed, *[F.col(c) for c in identity]), *identity, *ties]
    shuffled = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_draw", F.row_number().over(shuffled)).filter(F.col("_draw") <= size).drop("_draw")


def vote_counts(df: DataFrame, group: Sequence[str], candidate: str, votes: str = "votes") -> DataFrame:
    return df.groupBy(*group, candidate).agg(F.count(F.lit(1)).alias(votes))


def majority_vote(df: DataFrame, group: Sequence[str], candidate: str, votes: str = "votes") -> DataFrame:
    """The most frequent candidate per group; a tie goes to the smaller one.

    Counting comes first, so the ranking sees one row per candidate only.
    """
    ranked = Window.partitionBy(*group).orderBy(F.col(votes).desc(), F.col(candidate))
    return (
        vote_counts(df, group, candidate, votes)
        .withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def zip_by_vote(
    vertices: DataFrame, group: Sequence[str], zip_index: ZoneIndex, size: int = SAMPLE_SIZE, seed: int = 42
) -> DataFrame:
    """Sampled outline points of each area, their zips, and the winning zip.

    Points are drawn from the outer rings of all its polygons; the border of a hole is
    the border of something else.
    """
    outer = vertices.filter(F.col("ring") == 0)
    drawn = sample_per_group(outer, group, [*group, "part", "ring", "seq"], size, seed, ("longitude", "latitude"))
    located = locate(drawn, zip_index, {"zipcode": ("longitude", "latitude")}).filter(F.col("zipcode").isNotNull())
    return majority_vote(located, group, "zipcode")
