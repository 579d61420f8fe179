"""What is kept from run to run: located coordinates, the forecast, row numbers."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.test_zone_store import grid, outlines, points, square, zones
from wardline.operators.forecast import daily_counts, rolling_forecast
from wardline.operators.indexing import number_ledger, number_load, numbered_rows
from wardline.operators.kept_forecast import add_trips, kept_forecast
from wardline.operators.spatial import build_zone_index
from wardline.operators.zone_memo import locate_kept
from wardline.operators.zone_store import open_zone_index
from wardline.sources.versions import current


def located(spark, df, shapes, store):
    index = open_zone_index(spark, outlines(spark, *shapes), "zip", store, 0)
    found, count = locate_kept(df, index, {"zone": ("lon", "lat")}, store)
    answers = {r["id"]: r["zone"] for r in found.collect()}
    assert answers == zones(df, build_zone_index(outlines(spark, *shapes), "zip"))
    return count


def test_a_run_locates_new_coordinates_only(spark, tmp_path):
    store, spots = str(tmp_path / "store"), points(spark, 1000)
    some = spots.where("id < 600").unionByName(spots.where("id < 50"))
    assert located(spark, some, grid(60), store) == 600
    assert located(spark, spots, grid(60), store) == 400
    assert located(spark, spots, grid(60), store) == 0
    blank = spots.withColumn("lon", F.when(F.col("id") % 2 == 0, F.col("lon")))
    assert located(spark, blank, grid(60), store) == 0


def test_coordinates_near_changed_outlines_are_located_again(spark, tmp_path):
    store, spots = str(tmp_path / "store"), points(spark, 1000)
    shapes = grid(100)
    assert located(spark, spots, shapes, store) == 1000
    moved = [s for s in shapes if s[0][0] != "z055"] + [square("z055", 5.5, 5.5, 0.5)]
    again = located(spark, spots, moved, store)
    assert 0 < again < 200
    # Two changes between runs count together.
    open_zone_index(spark, outlines(spark, *shapes), "zip", store, 0)
    fewer = [s for s in shapes if s[0][0] not in ("z001", "z002")]
    assert 0 < located(spark, spots, fewer, store) < 500
    large = [*fewer, square("a-large", 0, 0, 10.0)]
    assert located(spark, spots, large, store) > 700


def trips(spark, rows):
    return spark.createDataFrame(rows, "tripdate date, pickup string, dropoff string")


def some_trips(count, seed, zones=40, start=0, days=30):
    draw = random.Random(seed)
    day = datetime.date(2024, 1, 1)
    zone = [None, *[f"z{n}" for n in range(zones)]]
    return [(day + datetime.timedelta(start + draw.randrange(days)), draw.choice(zone), draw.choice(zone)) for _ in range(count)]


def forecast(df):
    return sorted(map(tuple, rolling_forecast(daily_counts(df, "tripdate", "pickup", "dropoff")).select("tripdate", "zip", "trips", "pred_next_day", "pred_next_week").collect()))


def test_loads_add_up_to_one_forecast(spark, tmp_path):
    store = str(tmp_path / "forecast")
    loads = [some_trips(800, 1), some_trips(300, 2, 5, 20), some_trips(40, 3, 2, -10), [], some_trips(100, 4, 60)]
    for number, rows in enumerate(loads):
        before = current(spark, store)
        touched = add_trips(spark, trips(spark, rows), f"load-{number}", store)
        so_far = trips(spark, [r for load in loads[: number + 1] for r in load])
        assert sorted(map(tuple, kept_forecast(spark, store).collect())) == forecast(so_far)
        after = current(spark, store)
        assert {n for n in before if before[n] != after[n]} <= {f"{kind}/{b}" for kind in ("counts", "forecast") for b in touched}
        # A load that is repeated counts once.
        assert add_trips(spark, trips(spark, rows), f"load-{number}", store) == [] and current(spark, store) == after
    assert len(touched) > 20


def test_a_load_that_fails_changes_nothing(spark, tmp_path):
    store = str(tmp_path / "forecast")
    add_trips(spark, trips(spark, some_trips(100, 1)), "one", store)
    before = sorted(map(tuple, kept_forecast(spark, store).collect()))
    broken = trips(spark, some_trips(100, 2)).withColumn("pickup", F.when(F.col("dropoff") == "z3", F.raise_error(F.lit("broken"))).otherwise(F.col("pickup")))
    with pytest.raises(Exception, match="broken"):
        add_trips(spark, broken, "two", store)
    assert sorted(map(tuple, kept_forecast(spark, store).collect())) == before


def test_numbers_go_on_and_never_change(spark, tmp_path):
    store = str(tmp_path / "numbers")
    first = number_load(spark, spark.range(50, 0, -1).select(F.col("id").alias("k")), ["k"], "a", store)
    assert sorted(map(tuple, first.collect())) == [(n, n + 1) for n in range(50)]
    number_load(spark, spark.range(0).select(F.col("id").alias("k")), ["k"], "empty", store)
    second = number_load(spark, spark.range(100, 130).select(F.col("id").alias("k")).repartition(5), ["k"], "b", store)
    assert sorted(map(tuple, second.collect())) == [(50 + n, 100 + n) for n in range(30)]
    again = number_load(spark, spark.range(7).select(F.col("id").alias("k")), ["k"], "b", store)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, second.collect()))
    assert sorted(r["index"] for r in numbered_rows(spark, store).collect()) == list(range(80))
    assert sorted(map(tuple, number_ledger(spark, store).collect())) == [("a", 0, 50), ("b", 50, 30), ("empty", 50, 0)]
