"""The warehouse tables reshaped into the layouts of the city feeds.

Trips come from ``lineitem``, permits from ``part``, weekly reports from
``orders``, vulnerability records and daily reports from ``customer``, zip and area
outlines and area statistics from ``supplier``, places from ``region``.
All numbers are whole-number arithmetic on keys, so that any engine gets the same
text. Coordinates are counted in steps of 0.0001° until they become text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.filters import AIRPORT_PLACES, NEW_CONSTRUCTION
from wardline.sources.pages import first_rows, flat_rows, parsed_rows
from wardline.sources.schemas import (
    BUILDING_PERMITS,
    COMMUNITY_BOUNDARIES,
    COMMUNITY_HEALTH,
    COVID_VULNERABILITY,
    DAILY_COVID,
    NEIGHBORHOODS,
    PLACES,
    TAXI_TRIPS,
    WEEKLY_COVID,
    ZIPCODES,
    Feed,
)

STEPS = 10000  # coordinate steps per degree
WEST, SOUTH = -880000, 416000  # lower left corner of the zone grid
ZONE = 500  # side of a zone square
COLUMNS = 10  # zone squares to a row of the grid
AIRPORT_LON, AIRPORT_LAT = -879036, 419796  # where a third of all pickups happen


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def degrees_text(steps: Column) -> Column:
    """-879036 → ``-87.9036``."""
    size = F.abs(steps)
    sign = F.when(steps < 0, F.lit("-")).otherwise(F.lit(""))
    whole = F.floor(size / F.lit(STEPS)).cast("string")
    return F.concat(sign, whole, F.lit("."), F.lpad((size % F.lit(STEPS)).cast("string"), 4, "0"))


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _padded(column: Column, width: int) -> Column:
    return F.lpad(text(column), width, "0")


def _moment_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS")


# ---------------------------------------------------------------- trips

def pickup_steps() -> tuple[Column, Column]:
    """(longitude, latitude) of a pickup in steps; a third of the trips start at the airport."""
    lon = (F.col("l_partkey") * 131 + F.col("l_linenumber") * 17) % 6000 + F.lit(WEST - 500)
    lat = (F.col("l_suppkey") * 173 + F.col("l_partkey") * 7) % 6000 + F.lit(SOUTH - 500)
    at_airport = F.col("l_returnflag") == "A"
    return F.when(at_airport, F.lit(AIRPORT_LON)).otherwise(lon), F.when(at_airport, F.lit(AIRPORT_LAT)).otherwise(lat)


def dropoff_steps() -> tuple[Column, Column]:
    lon = (F.col("l_orderkey") * 59 + F.col("l_partkey")) % 6000 + F.lit(WEST - 500)
    lat = (F.col("l_orderkey") * 97 + F.col("l_suppkey")) % 6000 + F.lit(SOUTH - 500)
    return lon, lat


def trip_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as trip records; one in fourteen has no pickup coordinates."""
    li = table(spark, sf_dir, "lineitem")
    no_pickup = (F.col("l_linenumber") == 7) & (F.col("l_linestatus") == "F")
    pickup_lon, pickup_lat = pickup_steps()
    dropoff_lon, dropoff_lat = dropoff_steps()
    start = F.col("l_shipdate") + F.make_dt_interval(secs=(F.col("l_partkey") * 37 % 86400).cast("decimal(18,6)"))
    quantity = F.col("l_quantity").cast("bigint")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")

    def unless(condition: Column, value: Column) -> Column:
        return F.when(~condition, value)

    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents).alias("trip_id"),
        F.concat(F.lit("taxi"), text("l_suppkey")).alias("taxi_id"),
        _moment_text(start).alias("trip_start_timestamp"),
        _moment_text(start + F.expr("INTERVAL 10 MINUTES")).alias("trip_end_timestamp"),
        unless(quantity == 13, text(quantity * 60)).alias("trip_seconds"),
        unless(quantity == 29, F.concat(text(quantity), F.lit(".5"))).alias("trip_miles"),
        unless(F.col("l_linenumber") == 2, text(F.col("l_suppkey") % 77 + 1)).alias("pickup_community_area"),
        unless(F.col("l_linenumber").isin(2, 3), text(F.col("l_partkey") % 77 + 1)).alias("dropoff_community_area"),
        text(F.col("l_extendedprice").cast("bigint")).alias("trip_total"),
        unless(no_pickup, degrees_text(pickup_lat)).alias("pickup_centroid_latitude"),
        unless(no_pickup, degrees_text(pickup_lon)).alias("pickup_centroid_longitude"),
        degrees_text(dropoff_lat).alias("dropoff_centroid_latitude"),
        degrees_text(dropoff_lon).alias("dropoff_centroid_longitude"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias(
            "ingest_seq"
        ),
    )


# ---------------------------------------------------------------- permits

def permit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    number = (
        F.when(key % 50 == 1, F.concat(F.lit("B"), text(key)))
        .when(key % 50 == 2, F.concat(F.lit("30000"), _padded(key, 6)))
        .otherwise(text(key + 100000))
    )
    return part.select(
        text(key).alias("id"),
        number.alias("permit_"),
        F.when(F.col("p_type") == "ECONOMY", F.lit(NEW_CONSTRUCTION))
        .otherwise(F.concat(F.lit("PERMIT - "), F.col("p_type")))
        .alias("permit_type"),
        F.col("p_brand").alias("review_type"),
        text("p_size").alias("processing_time"),
        F.col("p_name").alias("work_description"),
        text(F.col("p_retailprice").cast("bigint")).alias("total_fee"),
        text(key * 10).alias("reported_cost"),
        F.when(key % 3 != 0, text(key % 77 + 1)).alias("community_area"),
        F.when(key % 3 == 1, F.concat(F.lit("606"), _padded(key % 25, 2), F.lit("-"), _padded(key % 10000, 4)))
        .when(key % 3 == 2, F.lit("0"))
        .alias("contact_1_zipcode"),
        F.when(key % 2 == 0, text(key % 50)).alias("ware"),
        F.when(key % 2 == 1, text(key % 50)).alias("ward"),
        degrees_text(key * 257 % 6000 + F.lit(SOUTH - 500)).alias("latitude"),
        degrees_text(key * 331 % 6000 + F.lit(WEST - 500)).alias("longitude"),
        F.struct(key.alias("k")).alias("ingest_seq"),
    )


# ---------------------------------------------------------------- reports

def weekly_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    tests = F.when(key % 101 == 0, F.lit("abc")).otherwise(text(key * 7 % 500))
    population = F.when(key % 997 == 0, F.lit("99999999999")).otherwise(text(F.col("o_custkey") * 31 % 50000))
    lon = degrees_text(key * 13 % 5000 + F.lit(WEST))
    lat = degrees_text(key * 29 % 5000 + F.lit(SOUTH))
    return orders.select(
        text(key).alias("row_id"),
        F.concat(F.lit("606"), _padded(F.col("o_custkey") % 25, 2)).alias("zip_code"),
        text(key % 52 + 1).alias("week_number"),
        _moment_text(F.col("o_orderdate")).alias("week_start"),
        _moment_text(F.col("o_orderdate") + F.expr("INTERVAL 6 DAYS")).alias("week_end"),
        tests.alias("tests_weekly"),
        F.concat(F.lit("0."), _padded(F.col("o_custkey") % 100, 2)).alias("percent_tested_positive_weekly"),
        population.alias("population"),
        F.when(key % 5 != 0, F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))).alias(
            "zip_code_location"
        ),
        F.struct(key.alias("k")).alias("ingest_seq"),
    )


def daily_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as daily reports: each count field is the key times its position, modulo 97."""
    key = F.col("c_custkey")
    counts = [name for name in DAILY_COVID.fields if name not in ("lab_report_date", "cases_unknown_race_eth")]
    day = F.date_add(F.lit("2020-03-01").cast("date"), (key % 1000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.concat(text(day), F.lit("T00:00:00.000")).alias("lab_report_date"),
        *[text(key * (i + 1) % 97).alias(name) for i, name in enumerate(counts)],
        F.struct(key.alias("k")).alias("ingest_seq"),
    )


def vulnerability_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as vulnerability records: 15 per zip, one in four for a community area."""
    key = F.col("c_custkey")
    category = F.element_at(F.array(F.lit("LOW"), F.lit("MEDIUM"), F.lit("HIGH")), (key % 3 + 1).cast("int"))
    lon = degrees_text(key * 13 % 5000 + F.lit(WEST))
    lat = degrees_text(key * 29 % 5000 + F.lit(SOUTH))
    return table(spark, sf_dir, "customer").select(
        F.when(key % 4 == 3, F.lit("CA")).otherwise(F.lit("ZIP")).alias("geography_type"),
        five_digits(F.floor(key / F.lit(15))).alias("community_area_or_zip"),
        F.col("c_name").alias("community_area_name"),
        F.concat(text(key % 100), F.lit("."), text(key % 10)).alias("ccvi_score"),
        category.alias("ccvi_category"),
        text(key % 77).alias("rank_age_65_plus"),
        F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("location"),
        F.struct(key.alias("k")).alias("ingest_seq"),
    )


def health_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        text(key + 1).alias("community_area"),
        F.col("s_name").alias("community_area_name"),
        F.concat(text(key % 100), F.lit(".5")).alias("below_poverty_level"),
        text(key * 1000 % 20000 + 20000).alias("per_capita_income"),
        F.concat(text(key % 20), F.lit(".25")).alias("unemployment"),
        F.struct(key.alias("k")).alias("ingest_seq"),
    )


# ---------------------------------------------------------------- outlines

def _point(lon: Column, lat: Column) -> Column:
    return F.array(lon.cast("double") / F.lit(float(STEPS)), lat.cast("double") / F.lit(float(STEPS)))


def square_ring(west: Column, south: Column, side: int, steps: int) -> Column:
    """Closed square ring with ``steps`` vertices per side, counter-clockwise from the lower left."""
    stride = side // steps

    def vertex(i: Column) -> Column:
        edge, along = F.floor(i / F.lit(steps)), (i % F.lit(steps)) * F.lit(stride)
        dx = F.when(edge == 0, along).when(edge == 1, F.lit(side)).when(edge == 2, F.lit(side) - along).otherwise(F.lit(0))
        dy = F.when(edge == 1, along).when(edge == 2, F.lit(side)).when(edge == 3, F.lit(side) - along).otherwise(F.lit(0))
        return _point(west + dx, south + dy)

    return F.transform(F.sequence(F.lit(0), F.lit(4 * steps)), vertex)


def multipolygon(*polygons: list[Column]) -> Column:
    """GeoJSON multipolygon from polygons given as lists of rings."""
    return F.struct(
        F.lit("MultiPolygon").alias("type"),
        F.array(*[F.array(*rings) for rings in polygons]).alias("coordinates"),
    ).alias("the_geom")


def grid_corner(key: Column) -> tuple[Column, Column]:
    """Lower left corner of the zone square of a key."""
    return F.lit(WEST) + key % COLUMNS * ZONE, F.lit(SOUTH) + F.floor(key / F.lit(COLUMNS)) * ZONE


def five_digits(key: Column) -> Column:
    """Zip text of a zone key: ``6`` and four digits."""
    return F.concat(F.lit("6"), _padded(key % 10000, 4))


def zip_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone square per supplier; one in 25 carries a nine-digit zip."""
    key = F.col("s_suppkey")
    west, south = grid_corner(key)
    suffix = F.when(key % 25 == 7, F.lit("-1234")).otherwise(F.lit(""))
    return table(spark, sf_dir, "supplier").select(
        text(key).alias("objectid"),
        F.concat(five_digits(key), suffix).alias("zip"),
        F.lit(str(ZONE * ZONE)).alias("shape_area"),
        F.lit(str(4 * ZONE)).alias("shape_len"),
        multipolygon([square_ring(west, south, ZONE, 1)]),
        F.struct(key.alias("k")).alias("ingest_seq"),
    )


def boundary_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community areas: zone squares moved off the zone grid, with 40 vertices each."""
    key = F.col("s_suppkey")
    west, south = grid_corner(key)
    return table(spark, sf_dir, "supplier").select(
        text(key + 1).alias("area_numbe"),
        F.col("s_name").alias("community"),
        F.lit(str(ZONE * ZONE)).alias("shape_area"),
        F.lit(str(4 * ZONE)).alias("shape_len"),
        multipolygon([square_ring(west + 150, south + 200, ZONE, 10)]),
        F.struct(key.alias("k")).alias("ingest_seq"),
    )


def neighborhood_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighborhoods: smaller squares with 12 vertices, fewer than a full sample."""
    key = F.col("s_suppkey")
    west, south = grid_corner(key)
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("pri_neigh"),
        F.concat(F.lit("SIDE "), text("s_nationkey")).alias("sec_neigh"),
        F.lit("90000").alias("shape_area"),
        F.lit("1200").alias("shape_len"),
        multipolygon([square_ring(west + 300, south + 100, 300, 3)]),
        F.struct(key.alias("k")).alias("ingest_seq"),
    )


def place_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places: overlapping squares around the airport, the first three with airport names."""
    key = F.col("r_regionkey")
    name = F.element_at(
        F.array(*[F.lit(n) for n in AIRPORT_PLACES]), F.when(key < 3, key + 1).otherwise(F.lit(1)).cast("int")
    )
    west, south = F.lit(AIRPORT_LON - 300) + key * 500, F.lit(AIRPORT_LAT - 300) - key * 500
    return table(spark, sf_dir, "region").select(
        text(key).alias("place_id"),
        F.when(key < 3, name).otherwise(F.col("r_name")).alias("display_name"),
        multipolygon([square_ring(west, south, 600, 1)]),
        F.struct(key.alias("k")).alias("ingest_seq"),
    )


# ---------------------------------------------------------------- as lake rows

PAGES = {
    "taxi_trips": (TAXI_TRIPS, trip_pages),
    "building_permits": (BUILDING_PERMITS, permit_pages),
    "weekly_covid_by_zip": (WEEKLY_COVID, weekly_pages),
    "daily_covid_cases": (DAILY_COVID, daily_pages),
    "covid_vulnerability": (COVID_VULNERABILITY, vulnerability_pages),
    "community_health": (COMMUNITY_HEALTH, health_pages),
    "zipcodes": (ZIPCODES, zip_pages),
    "community_boundaries": (COMMUNITY_BOUNDARIES, boundary_pages),
    "neighborhoods": (NEIGHBORHOODS, neighborhood_pages),
    "places": (PLACES, place_pages),
}


def _with_missing_fields(pages: DataFrame, feed: Feed) -> DataFrame:
    """Fields of the feed that the reshaped table does not have, as NULL."""
    missing = [f for f in feed.page_schema.fields if f.name not in pages.columns]
    return pages.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else pages


def lake_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as it would stand in the lake. Keys of tables without outlines are unique by construction."""
    feed, pages = PAGES[name]
    rows = parsed_rows(_with_missing_fields(pages(spark, sf_dir), feed), feed)
    return flat_rows(first_rows(rows, feed) if feed.geometry else rows, feed)
