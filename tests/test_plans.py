"""What the physical plans must and must not hold, on written lake tables."""

import pytest

from tests.city import land
from wardline.operators.spatial import build_zone_index
from wardline.plans import marts
from wardline.plans.jobs import build_lake
from wardline.sources.tables import lake_table


@pytest.fixture(scope="module")
def read(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    build_lake(spark, land(root / "pages"), str(root / "lake"))
    return lambda name: lake_table(spark, str(root / "lake"), name)


@pytest.fixture(scope="module")
def zips(read):
    return build_zone_index(read("zipcodes"), "zip")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_of(plan, table):
    return next(line for line in plan.splitlines() if "FileScan" in line and f"/{table}/" in line)


def test_trip_marts_are_map_only(read, zips):
    trips = read("taxi_trips")
    for df in (marts.covid_taxi_trips(trips, zips), marts.typed_trips(trips, zips),
               marts.airport_trips(trips, build_zone_index(read("places"), "display_name"), zips)):
        plan = plan_of(df)
        assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SortMergeJoin"):
            assert word not in plan


def test_filters_and_columns_reach_the_scan(spark, read, zips):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    typed = scan_of(plan_of(marts.typed_trips(read("taxi_trips"), zips)), "taxi_trips")
    assert "Not(EqualTo(tripseconds,))" in typed and "pickupcensustract" not in typed
    areas = scan_of(plan_of(marts.trips_by_area(read("taxi_trips"))), "taxi_trips")
    assert "Or(" in areas and "latitude" not in areas
    permits = scan_of(plan_of(marts.new_construction(
        read("building_permits"), read("community_health"),
        marts.comm_zips(read("community_boundaries"), zips), zips)), "building_permits")
    assert "EqualTo(permit_type,PERMIT - NEW CONSTRUCTION)" in permits and "work_description" not in permits
    waiver = scan_of(plan_of(marts.fee_waiver_permits(read("building_permits"))), "building_permits")
    assert "Or(" in waiver and "Not(EqualTo(contact_zip,0))" in waiver


def test_dimension_lookups_are_broadcast(spark, read, zips):
    neighborhoods = spark.createDataFrame([("60601", "A", "S")], "zipcode string, pri_neigh string, sec_neigh string")
    plan = plan_of(marts.ccvi_alerts(read("taxi_trips"), read("covid_vulnerability"), neighborhoods, zips))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 6


def test_forecast_shuffles_counts_only(read, zips):
    plan = plan_of(marts.trip_forecast(marts.typed_trips(read("taxi_trips"), zips)))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and "partial_count" in plan
