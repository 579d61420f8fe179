"""Declared layouts of the nine feeds, of their lake tables and of the marts.

The names below are fixed values: field names as the feeds deliver them, column
names as the tables carry them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------- feed pieces

POINT = T.StructType(
    [T.StructField("type", T.StringType()), T.StructField("coordinates", T.ArrayType(T.StringType()))]
)
MULTIPOLYGON = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))),
    ]
)

# Where a row came from: when its file was landed, the number and name of the file,
# split of the file, position in the split. Ordering by it is the order the pages were
# landed in, however the read was partitioned; the number parts files landed at once.
INGEST_SEQ = T.StructType(
    [
        T.StructField("landed", T.TimestampType()),
        T.StructField("page", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("split", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Feed:
    """One feed and its lake table.

    ``columns`` maps lake column to feed field; a tuple of fields means the first
    one that is filled. ``on_duplicate`` is ``first`` (keep the first row of a key),
    ``fail`` (refuse the load) or ``keep`` (no key).
    """

    table: str
    columns: dict[str, str | tuple[str, ...]]
    key: tuple[str, ...] = ()
    on_duplicate: str = "keep"
    point: str | None = None
    point_default: str | None = None
    geometry: str | None = None
    extra: tuple[str, ...] = field(default=())

    @property
    def fields(self) -> list[str]:
        names: list[str] = []
        for source in self.columns.values():
            names.extend([source] if isinstance(source, str) else source)
        return names

    @property
    def page_schema(self) -> T.StructType:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in self.fields])
        if self.point:
            schema = schema.add(self.point, POINT)
        if self.geometry:
            schema = schema.add(self.geometry, MULTIPOLYGON)
        return schema

    @property
    def lake_schema(self) -> T.StructType:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in self.columns])
        if self.point:
            for name in (*self.extra, "latitude", "longitude"):
                schema = schema.add(name, T.StringType())
        if self.geometry:
            for name in self.extra:
                schema = schema.add(name, T.StringType())
            for name in ("part", "ring", "seq"):
                schema = schema.add(name, T.IntegerType())
            schema = schema.add("longitude", T.DoubleType()).add("latitude", T.DoubleType())
        return schema.add("ingest_seq", INGEST_SEQ)


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


# ---------------------------------------------------------------- feeds

BUILDING_PERMITS = Feed(
    table="building_permits",
    key=("id",),
    on_duplicate="first",
    columns={
        "id": "id",
        "permit_num": "permit_",
        "permit_type": "permit_type",
        "review_type": "review_type",
        "application_start_date": "application_start_date",
        "issue_date": "issue_date",
        "processing_time": "processing_time",
        "street_num": "street_number",
        "street_direction": "street_direction",
        "street_name": "street_name",
        "street_suffix": "suffix",
        "work_description": "work_description",
        "total_fee": "total_fee",
        "contact_type": "contact_1_type",
        "contact_name": "contact_1_name",
        "contact_city": "contact_1_city",
        "contact_state": "contact_1_state",
        "contact_zip": "contact_1_zipcode",
        "reported_cost": "reported_cost",
        "community_area": "community_area",
        "census_tract": "census_tract",
        "ward": ("ward", "ware"),
        "x_coordinate": "xcoordinate",
        "y_coordinate": "ycoordinate",
        "latitude": "latitude",
        "longitude": "longitude",
    },
)

TAXI_TRIPS = Feed(
    table="taxi_trips",
    key=("tripid",),
    on_duplicate="first",
    # Feed field = lake column with the underscores put back.
    columns={
        name.replace("_", ""): name
        for name in (
            "trip_id",
            "taxi_id",
            "trip_start_timestamp",
            "trip_end_timestamp",
            "trip_seconds",
            "trip_miles",
            "pickup_census_tract",
            "dropoff_census_tract",
            "pickup_community_area",
            "dropoff_community_area",
            "fare",
            "tips",
            "tolls",
            "extras",
            "trip_total",
            "payment_type",
            "company",
            "pickup_centroid_latitude",
            "pickup_centroid_longitude",
            "dropoff_centroid_latitude",
            "dropoff_centroid_longitude",
        )
    },
)

_AGE_BANDS = ("0_17", "18_29", "30_39", "40_49", "50_59", "60_69", "70_79")
_GROUPS = {
    "male": "male",
    "female": "female",
    "genderunk": "unknown_gender",
    "latinx": "latinx",
    "asiannonlatinx": "asian_non_latinx",
    "blacknonlatinx": "black_non_latinx",
    "othernonlatinx": "other_non_latinx",
}

DAILY_COVID = Feed(
    table="daily_covid_cases",
    columns={
        "labreportdate": "lab_report_date",
        "casestotal": "cases_total",
        "deathstotal": "deaths_total",
        **{f"casesage_{band}": f"cases_age_{band}" for band in (*_AGE_BANDS, "80_")},
        "casesageunk": "cases_age_unknown",
        **{f"cases{column}": f"cases_{name}" for column, name in _GROUPS.items()},
        "casesethunk": ("cases_unknown_race_eth", "cases_unkown_race_eth"),
        **{f"deathsage_{band}_yrs": f"deaths_{band}_yrs" for band in (*_AGE_BANDS, "80")},
        "deathsageunk": "deaths_unknown_age",
        **{f"deaths{column}": f"deaths_{name}" for column, name in _GROUPS.items()},
        "deathsethunk": "deaths_unknown_race_eth",
    },
)

WEEKLY_COVID = Feed(
    table="weekly_covid_by_zip",
    key=("rowid",),
    on_duplicate="fail",
    point="zip_code_location",
    point_default="0",
    columns={
        "rowid": "row_id",
        "zipcode": "zip_code",
        "weeknum": "week_number",
        "weekstart": "week_start",
        "weekend": "week_end",
        "testsweekly": "tests_weekly",
        "testscumulative": "tests_cumulative",
        "testrateweekly": "test_rate_weekly",
        "testratecumulative": "test_rate_cumulative",
        "pctpositiveweekly": "percent_tested_positive_weekly",
        "pctpositivecumulative": "percent_tested_positive_cumulative",
        "deathsweekly": "deaths_weekly",
        "deathscumulative": "deaths_cumulative",
        "deathrateweekly": "death_rate_weekly",
        "deathratecumulative": "death_rate_cumulative",
        "population": "population",
    },
)

COVID_VULNERABILITY = Feed(
    table="covid_vulnerability",
    point="location",
    extra=("location_type",),
    columns={
        "geo_type": "geography_type",
        **_same("community_area_or_zip", "community_area_name", "ccvi_score", "ccvi_category"),
        **_same(
            "rank_socioeconomic_status",
            "rank_household_composition",
            "rank_adults_no_pcp",
            "rank_cumulative_mobility_ratio",
            "rank_frontline_essential_workers",
            "rank_age_65_plus",
            "rank_comorbid_conditions",
        ),
        "rank_covid_incidence_rate": "rank_covid_19_incidence_rate",
        "rank_covid_hospital_admission_rate": "rank_covid_19_hospital_admission_rate",
        "rank_covid_crude_mortality_rate": "rank_covid_19_crude_mortality_rate",
    },
)

COMMUNITY_HEALTH = Feed(
    table="community_health",
    key=("communityarea",),
    on_duplicate="first",
    columns={
        "communityarea": "community_area",
        "communityareaname": "community_area_name",
        "belowpoverty": "below_poverty_level",
        "percapitaincome": "per_capita_income",
        "unemployment": "unemployment",
    },
)

COMMUNITY_BOUNDARIES = Feed(
    table="community_boundaries",
    key=("areanum",),
    on_duplicate="first",
    geometry="the_geom",
    columns={
        "areanum": "area_numbe",
        "community": "community",
        "shapearea": "shape_area",
        "shapelen": "shape_len",
    },
)

NEIGHBORHOODS = Feed(
    table="neighborhoods",
    geometry="the_geom",
    extra=("geotype",),
    columns=_same("pri_neigh", "sec_neigh", "shape_area", "shape_len"),
)

ZIPCODES = Feed(
    table="zipcodes",
    geometry="the_geom",
    extra=("geotype",),
    columns=_same("objectid", "zip", "shape_area", "shape_len"),
)

# Outlines of named places, used where the name of a pickup spot is wanted.
PLACES = Feed(
    table="places",
    geometry="the_geom",
    extra=("geotype",),
    columns=_same("place_id", "display_name"),
)

FEEDS = {
    feed.table: feed
    for feed in (
        BUILDING_PERMITS,
        TAXI_TRIPS,
        DAILY_COVID,
        WEEKLY_COVID,
        COVID_VULNERABILITY,
        COMMUNITY_HEALTH,
        COMMUNITY_BOUNDARIES,
        NEIGHBORHOODS,
        ZIPCODES,
        PLACES,
    )
}

# ---------------------------------------------------------------- marts

MART_SCHEMAS = {
    "comm_zips": "zipcode string, areanum int, community string",
    "neighborhood_zips": "zipcode string, pri_neigh string, sec_neigh string",
    "requirement_1_taxi_trips": (
        "tripid string, taxiid string, tripstarttimestamp timestamp, pickuplatitude double, pickuplongitude double, "
        "dropofflatitude double, dropofflongitude double, pickupzipcode string, dropoffzipcode string"
    ),
    "requirement_1_covid_reports": (
        "zipcode string, weekstart timestamp, weekend timestamp, testsweekly int, pctpos double, population int, cases int"
    ),
    "requirement_2_airport_trips": (
        "tripid string, taxiid string, tripstarttimestamp timestamp, pickuplatitude double, pickuplongitude double, "
        "pickuplocationname string, dropofflatitude double, dropofflongitude double, dropoffzipcode int, "
        "dropoffneighborhood string"
    ),
    "requirement_3_ccvi_alerts": (
        "tripid string, taxiid string, tripstarttimestamp timestamp, pickuplatitude double, pickuplongitude double, "
        "dropofflatitude double, dropofflongitude double, pickupzipcode int, dropoffzipcode int, "
        "pickupneighborhood string, dropoffneighborhood string, pickupccviscore double, pickupccvicategory string, "
        "dropoffccviscore double, dropoffccvicategory string"
    ),
    "requirement_4_taxi_trips": (
        "tripid string, taxiid string, tripstarttimestamp timestamp_ntz, tripendtimestamp timestamp_ntz, "
        "tripseconds double, tripmiles double, dropoffzip string, pickupzip string, pickupcoords string, "
        "dropoffcoords string, tripdate date, tripweekday int"
    ),
    "requirement_4_taxi_trips_forecast": (
        "tripdate date, zip string, trips bigint, pred_next_day double, pred_next_week double"
    ),
    "requirement_5_commhealthstats": (
        "communityarea int, communityareaname string, belowpoverty double, percapitaincome int, unemployment double"
    ),
    "requirement_5_buildingpermitfeewaiver": (
        "id string, permit_type string, review_type string, processing_time string, work_description string, "
        "total_fee string, reported_cost string, community_area string, contact_zip string"
    ),
    "requirement_6_new_construction": (
        "id string, permitnum int, permittype string, latitude double, longitude double, permitzipcode int"
    ),
    "requirement_9_txneighzip": (
        "tripid string, tripmiles string, triptotal string, pickupcommunityarea string, dropoffcommunityarea string, "
        "tripstarttimestamp timestamp"
    ),
    "requirement_9_area_forecast": (
        "tripdate date, area string, trips bigint, pred_next_day double, pred_next_week double"
    ),
    "requirement_9_community_forecast": (
        "tripdate date, area string, trips bigint, pred_next_day double, pred_next_week double"
    ),
}
