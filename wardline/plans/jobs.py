"""Whole runs: landed pages → lake tables → mart tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from wardline.operators.indexing import with_row_index
from wardline.operators.zone_store import open_zone_index
from wardline.plans import marts
from wardline.sources.schemas import FEEDS
from wardline.sources.tables import (
    lake_cast_audit,
    lake_table,
    mart_schema,
    mart_table,
    read_back,
    refresh,
    refresh_checked,
    refresh_lake_table,
)


def audit_casts(spark: SparkSession, lake: str, mart: str) -> None:
    """Write to ``<mart>/_cast_audit`` how many values of each column the marts turn into a default.

    The loads have counted them while they wrote the lake tables; no table is read for it here.
    """
    lake_cast_audit(spark, lake).write.mode("overwrite").parquet(f"{mart}/_cast_audit")


def look_back(spark: SparkSession, lake: str, rows: int = 10) -> dict[str, list]:
    """A few values of the first column of every lake table, for a look after a load."""
    return {table: read_back(lake_table(spark, lake, table), feed.lake_schema.names[0], rows) for table, feed in FEEDS.items()}


def build_lake(
    spark: SparkSession, pages: str, lake: str, multiline: bool = True, all_rings: bool = True
) -> dict[str, list]:
    """Rebuild every lake table from ``pages/<table>``, with rejects and audits beside them; returns a look at each.

    Outline tables hold every polygon and every hole, which the zone lookups of the
    marts need. ``all_rings=False`` cuts them to the outer ring of the first polygon.
    """
    for table in FEEDS:
        refresh_lake_table(spark, table, f"{pages}/{table}", lake, multiline, all_rings)
    return look_back(spark, lake)


def build_marts(spark: SparkSession, lake: str, mart: str, seed: int = 42, row_index: bool = False) -> None:
    """Rebuild every mart table. Marts that feed others are written first and read back.
    The values that lenient casts replace are counted in ``_cast_audit``; the zone indexes are kept in ``_zones`` and cut
    anew only where outlines differ from those of the run before.

    ``row_index`` gives the typed trips and their forecast a leading ``index`` column.
    """

    def read(table: str):
        return lake_table(spark, lake, table)

    def write(table: str, df) -> None:
        refresh(df, mart_schema(table), f"{mart}/{table}")

    def write_indexed(table: str, df, order: list[str]) -> None:
        if row_index:
            schema = T.StructType([T.StructField("index", T.LongType()), *mart_schema(table).fields])
            refresh(with_row_index(df, order), schema, f"{mart}/{table}")
        else:
            write(table, df)

    def write_checked(table: str, df) -> None:
        refresh_checked(df, mart_schema(table), f"{mart}/{table}")

    zips = open_zone_index(spark, read("zipcodes"), "zip", f"{mart}/_zones/zips")
    places = open_zone_index(spark, read("places"), "display_name", f"{mart}/_zones/places")

    write("comm_zips", marts.comm_zips(read("community_boundaries"), zips, seed=seed))
    write("neighborhood_zips", marts.neighborhood_zips(read("neighborhoods"), zips, seed=seed))
    community_zips = mart_table(spark, mart, "comm_zips")
    neighborhood_of_zip = mart_table(spark, mart, "neighborhood_zips")

    trips, permits, health = read("taxi_trips"), read("building_permits"), read("community_health")
    write_checked("requirement_1_taxi_trips", marts.covid_taxi_trips(trips, zips))
    write_checked("requirement_1_covid_reports", marts.covid_reports(read("weekly_covid_by_zip")))
    write("requirement_2_airport_trips", marts.airport_trips(trips, places, zips, neighborhood_of_zip))
    write(
        "requirement_3_ccvi_alerts",
        marts.ccvi_alerts(trips, read("covid_vulnerability"), neighborhood_of_zip, zips),
    )
    write_indexed("requirement_4_taxi_trips", marts.typed_trips(trips, zips), ["tripid"])
    typed = mart_table(spark, mart, "requirement_4_taxi_trips")
    write_indexed("requirement_4_taxi_trips_forecast", marts.trip_forecast(typed), ["tripdate", "zip"])
    write("requirement_5_commhealthstats", marts.community_health_stats(health))
    write("requirement_5_buildingpermitfeewaiver", marts.fee_waiver_permits(permits))
    write_checked("requirement_6_new_construction", marts.new_construction(permits, health, community_zips, zips))
    write("requirement_9_txneighzip", marts.trips_by_area(trips))
    write(
        "requirement_9_area_forecast",
        marts.area_forecast(mart_table(spark, mart, "requirement_4_taxi_trips_forecast"), neighborhood_of_zip),
    )
    write("requirement_9_community_forecast", marts.community_forecast(trips))
    audit_casts(spark, lake, mart)
