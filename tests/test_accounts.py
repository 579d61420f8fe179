"""Loads that account for every row, and whole outlines from the page to the mart."""

import json

import pytest
from pyspark.sql import functions as F

from tests.city import PAGES, land, square, trip
from wardline.operators.checks import REASON, cast_audit, flag_rejects
from wardline.operators.keyed import DuplicateKeyError
from wardline.plans.jobs import build_lake, build_marts, look_back
from wardline.sources.schemas import FEEDS
from wardline.sources.tables import (
    LENIENT,
    lake_audit,
    lake_cast_audit,
    lake_rejects,
    lake_table,
    mart_audit,
    mart_table,
    read_checked,
    refresh_checked,
    refresh_lake_table,
    replay_rejects,
)

HOLE = [[0.4, 0.4], [0.4, 0.6], [0.6, 0.6], [0.6, 0.4], [0.4, 0.4]]
ISLAND = [[[5.0, 5.0], [6.0, 5.0], [6.0, 6.0], [5.0, 6.0], [5.0, 5.0]]]


@pytest.fixture(scope="module")
def city(spark, tmp_path_factory):
    """The hand-made city; zip 60601 has a hole and a second polygon."""
    root = tmp_path_factory.mktemp("accounts")
    pages = json.loads(json.dumps(PAGES))
    first = pages["zipcodes"][0][0]["the_geom"]["coordinates"]
    first[0].append(HOLE)
    first.append(ISLAND)
    pages["taxi_trips"].append([trip("h1", ("0.5", "0.5"), ("5.5", "5.5"))])
    build_lake(spark, land(root / "pages", pages), str(root / "lake"))
    build_marts(spark, str(root / "lake"), str(root / "mart"), row_index=True)
    return str(root / "lake"), str(root / "mart")


def test_second_polygons_and_holes_reach_the_marts(spark, city):
    lake, mart = city
    rings = lake_table(spark, lake, "zipcodes").filter("zip = '60601'").select("part", "ring").distinct().collect()
    assert sorted(map(tuple, rings)) == [(0, 0), (0, 1), (1, 0)]
    covid = mart_table(spark, mart, "requirement_1_taxi_trips").filter("tripid = 'h1'").first()
    assert (covid["pickupzipcode"], covid["dropoffzipcode"]) == ("", "60601")
    alert = mart_table(spark, mart, "requirement_3_ccvi_alerts").filter("tripid = 'h1'").first()
    assert (alert["pickupzipcode"], alert["dropoffzipcode"], alert["dropoffccvicategory"]) == (0, 60601, "HIGH")


def test_first_ring_only_on_request(spark, tmp_path):
    page = tmp_path / "pages" / "page-1.json"
    page.parent.mkdir()
    page.write_text(json.dumps([{"the_geom": square(0.0, 0.0, 1.0, ISLAND), "zip": "1"}]))
    refresh_lake_table(spark, "zipcodes", str(page.parent), str(tmp_path / "lake"), all_rings=False)
    assert {r["part"] for r in lake_table(spark, str(tmp_path / "lake"), "zipcodes").collect()} == {0}


def test_every_landed_row_is_kept_or_rejected(spark, city):
    lake, _ = city
    audits = {r["table_name"]: r for r in lake_audit(spark, lake).collect()}
    assert set(audits) == set(FEEDS)
    for name, r in audits.items():
        assert r["rows_in"] == r["rows_kept"] + r["duplicate_rows"]
        assert r["rows_kept"] == lake_table(spark, lake, name).select("ingest_seq").distinct().count()
    assert audits["taxi_trips"]["duplicate_rows"] == 1 and audits["community_health"]["duplicate_rows"] == 1
    assert [r["tripid"] for r in lake_rejects(spark, lake, "taxi_trips").collect()] == ["t1"]


def test_mart_rows_by_reason(spark, city):
    _, mart = city
    counts = {(r["table_name"], r[REASON]): r["rows"] for r in mart_audit(spark, mart).collect()}
    assert counts["requirement_1_covid_reports", "population does not fit 32 bits"] == 1
    assert counts["requirement_1_taxi_trips", ""] == mart_table(spark, mart, "requirement_1_taxi_trips").count()


def test_defaults_of_lenient_casts_are_counted(spark, city):
    lake, mart = city
    counts = {(r["table_name"], r["column_name"]): (r["rows_in"], r["defaulted"]) for r in spark.read.parquet(f"{mart}/_cast_audit").collect()}
    trips = lake_table(spark, lake, "taxi_trips").count()
    assert counts["taxi_trips", "tripstarttimestamp"] == (trips, 1)
    assert counts["weekly_covid_by_zip", "testsweekly"] == (2, 1)
    assert counts["weekly_covid_by_zip", "pctpositiveweekly"] == (2, 1)
    assert len(counts) == 15


def test_a_look_after_the_load(spark, city):
    seen = look_back(spark, city[0], rows=2)
    assert set(seen) == set(FEEDS) and sorted(seen["weekly_covid_by_zip"]) == ["a", "b"]


def test_forecast_marts_may_carry_an_index(spark, city):
    _, mart = city
    for table, order in (("requirement_4_taxi_trips", "tripid"), ("requirement_4_taxi_trips_forecast", "tripdate")):
        rows = mart_table(spark, mart, table).orderBy("index").collect()
        assert [r["index"] for r in rows] == list(range(len(rows))) and rows
        assert [r[order] for r in rows] == sorted(r[order] for r in rows)


def test_community_forecast_is_written(spark, city):
    rows = mart_table(spark, city[1], "requirement_9_community_forecast").collect()
    assert rows and {r["area"] for r in rows} == {"1", "7"}


def test_no_accepted_row_loses_a_value(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a", None), ("x", "b", None), (None, "c", None), ("y", "d", "broken")], f"n string, t string, {REASON} string")
    path = refresh_checked(rows, "n int, t string", str(tmp_path / "t"))
    assert sorted(tuple(r) for r in read_checked(spark, path).select("t", "n").collect()) == [("a", 1), ("c", None)]
    assert sorted(tuple(r) for r in read_checked(spark, path, rejects=True).select("t", REASON).collect()) == [("b", "n is no int"), ("d", "broken")]


def test_refused_duplicates_leave_the_table_as_it_was(spark, tmp_path):
    pages, lake = tmp_path / "pages", str(tmp_path / "lake")
    pages.mkdir()
    (pages / "page-1.json").write_text(json.dumps([{"row_id": "a"}]))
    refresh_lake_table(spark, "weekly_covid_by_zip", str(pages), lake)
    (pages / "page-2.json").write_text(json.dumps([{"row_id": "a"}, {"row_id": "b"}]))
    with pytest.raises(DuplicateKeyError):
        refresh_lake_table(spark, "weekly_covid_by_zip", str(pages), lake)
    assert lake_table(spark, lake, "weekly_covid_by_zip").select(F.col("rowid")).count() == 1


def test_corrected_rejects_join_the_accepted_rows_by_key(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, n int"
    rules = {"n is negative": F.col("n") >= 0}
    rows = [("a", "1"), ("b", "x"), ("c", "-1"), ("d", "-2"), ("a", "-3"), ("e", "-4"), ("e", "-5"), (None, "-6")]
    flagged = flag_rejects(spark.createDataFrame(rows, "k string, n string"), {"n is negative": ~F.col("n").startswith("-")})
    refresh_checked(flagged, schema, path, version="1")
    corrections = [("b", "7"), ("c", "-9"), ("a", "5"), ("e", "6"), ("z", "8"), ("d", None), (None, "1")]
    replay_rejects(spark, path, schema, spark.createDataFrame(corrections, "k string, n string"), ["k"], rules, "2")
    assert sorted(map(tuple, read_checked(spark, path).collect())) == [("a", 1), ("b", 7), ("e", 6)]
    left = sorted(((r["k"] or "", r["n"], r[REASON], r["rule_version"]) for r in read_checked(spark, path, rejects=True).collect()))
    assert left == [
        ("", -6, "n is negative", "1"), ("a", 5, "key is loaded already", "2"), ("c", -9, "n is negative", "2"), ("d", -2, "n is negative", "2"), ("e", 6, "key comes twice", "2"),
    ]
    # Once more: what was accepted stays, what is refused may be corrected again.
    replay_rejects(spark, path, schema, spark.createDataFrame([("c", 3)], "k string, n int"), ["k"], rules, "3")
    assert sorted(map(tuple, read_checked(spark, path).collect())) == [("a", 1), ("b", 7), ("c", 3), ("e", 6)]


def test_casts_are_counted_while_the_table_is_written(spark, city, tmp_path):
    lake, mart = city
    audit = spark.read.parquet(f"{mart}/_cast_audit")
    counted = {(r["table_name"], r["column_name"]): r["defaulted"] for r in lake_cast_audit(spark, lake).collect()}
    assert counted == {(r["table_name"], r["column_name"]): r["defaulted"] for r in audit.collect()}
    assert all("/_cast_audit/" in file for file in lake_cast_audit(spark, lake).inputFiles())
    for table, parses in LENIENT.items():
        scanned = cast_audit(lake_table(spark, lake, table), {name: parse(F.col(name)) for name, parse in parses.items()}).collect()
        assert {(table, r["column_name"]): r["defaulted"] for r in scanned}.items() <= counted.items()
