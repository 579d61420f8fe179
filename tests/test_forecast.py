from datetime import date, timedelta

import pandas as pd
from pyspark.sql import functions as F

from wardline.operators.forecast import daily_counts, direction_counts, rolling_forecast, summed_counts
from wardline.operators.mapping import majority_vote, sample_per_group


def test_forecast_matches_pandas(spark):
    """1, 4, 5 and 8 observed dates, with a gap that is not filled."""
    rows = []
    for zone, days in {"a": 1, "b": 4, "c": 5, "d": 8}.items():
        for i in range(days):
            gap = 3 if i > 2 else 0
            rows.append((date(2023, 1, 1) + timedelta(days=i + gap), zone, (i * 37 + len(zone) + ord(zone)) % 20 + 1))
    got = rolling_forecast(spark.createDataFrame(rows, "tripdate date, zip string, trips bigint")).toPandas()
    expected = pd.DataFrame(rows, columns=["tripdate", "zip", "trips"]).sort_values(["tripdate", "zip"])
    by_zip = expected.groupby("zip")["trips"]
    expected["pred_next_day"] = by_zip.transform(lambda x: x.rolling(2, min_periods=1).median())
    week = by_zip.transform(lambda x: x.rolling(7, min_periods=5).sum())
    expected["pred_next_week"] = week.fillna(expected["pred_next_day"] * 0.90 * 7)
    order = ["zip", "tripdate"]
    pd.testing.assert_frame_equal(
        got.sort_values(order).reset_index(drop=True), expected.sort_values(order).reset_index(drop=True), check_dtype=False
    )


def test_both_ways_of_counting_agree(spark):
    trips = spark.range(5000).select(
        (F.col("id") % 11).alias("d"),
        F.when(F.col("id") % 5 != 0, F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string"))).alias("p"),
        F.when(F.col("id") % 13 != 0, (F.col("id") % 4).cast("string")).alias("q"),
    )
    one_pass = daily_counts(trips, "d", "p", "q")
    ends = [direction_counts(trips.withColumnRenamed("d", "tripdate"), "tripdate", c) for c in "pq"]
    two_pass = summed_counts(*ends)
    assert sorted(map(tuple, one_pass.collect())) == sorted(map(tuple, two_pass.select(one_pass.columns).collect()))
    total = one_pass.agg(F.sum("trips")).first()[0]
    assert total == trips.filter("p IS NOT NULL").count() + trips.filter("q IS NOT NULL").count()


def test_sample_is_bounded_and_repeats(spark):
    df = spark.range(3000).select((F.col("id") % 3 * (F.col("id") % 100)).alias("g"), F.col("id"))
    first, again = (sample_per_group(df.repartition(n), ["g"], ["g", "id"]) for n in (3, 11))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    sizes = {r["g"]: (r["have"], r["drawn"]) for r in df.groupBy("g").agg(F.count("*").alias("have")).join(
        first.groupBy("g").agg(F.count("*").alias("drawn")), "g").collect()}
    assert all(drawn == min(have, 20) for have, drawn in sizes.values())
    other = sample_per_group(df, ["g"], ["g", "id"], seed=7)
    assert sorted(map(tuple, first.collect())) != sorted(map(tuple, other.collect()))


def test_vote_tie_goes_to_the_smaller(spark):
    df = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "2"), ("b", "2"), ("b", "1")], "g string, z string")
    assert {r["g"]: (r["z"], r["votes"]) for r in majority_vote(df, ["g"], "z").collect()} == {"a": ("1", 1), "b": ("2", 2)}
