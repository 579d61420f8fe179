"""Trips per day and zone, and the rolling forecast on top."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def direction_counts(trips: DataFrame, date: str, zone: str, out: str = "trips") -> DataFrame:
    """Trips per date and zone in one direction; trips without a zone are left out."""
    return (
        trips.filter(F.col(zone).isNotNull())
        .groupBy(F.col(date), F.col(zone).alias("zip"))
        .agg(F.count(F.lit(1)).alias(out))
    )


def daily_counts(trips: DataFrame, date: str, pickup: str, dropoff: str) -> DataFrame:
    """Pickups plus dropoffs per date and zone.

    One pass over the trips: each trip becomes its two (date, zone) ends, which
    are counted on the map side before the only shuffle of the step.
    """
    ends = trips.select(F.col(date).alias("tripdate"), F.explode(F.array(F.col(pickup), F.col(dropoff))).alias("zip"))
    return (
        ends.filter(F.col("zip").isNotNull())
        .groupBy("tripdate", "zip")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def summed_counts(pickups: DataFrame, dropoffs: DataFrame) -> DataFrame:
    """The same totals from two counted frames, when those are wanted on their own."""
    return (
        pickups.unionByName(dropoffs)
        .groupBy("tripdate", "zip")
        .agg(F.sum("trips").alias("trips"))
    )


def rolling_forecast(counts: DataFrame, date: str = "tripdate", zone: str = "zip", value: str = "trips") -> DataFrame:
    """Next-day and next-week predictions over the observed dates of each zone.

    Frames count rows, not calendar days: a missing date is not filled in. The
    window holds one row per observed date of a zone, however many trips it had.
    The median of one or two rows is their mean.
    """
    by_date = Window.partitionBy(zone).orderBy(date)
    last_two = by_date.rowsBetween(-1, Window.currentRow)
    last_seven = by_date.rowsBetween(-6, Window.currentRow)
    next_day = F.avg(value).over(last_two)
    seven_days = F.when(F.count(value).over(last_seven) >= 5, F.sum(value).over(last_seven).cast("double"))
    return (
        counts.withColumn("pred_next_day", next_day)
        .withColumn("pred_next_week", seven_days)
        .withColumn(
            "pred_next_week",
            F.coalesce(F.col("pred_next_week"), F.col("pred_next_day") * F.lit(0.90) * F.lit(7)),
        )
    )
