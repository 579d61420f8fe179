"""The mart tables, each as one plan over lake rows.

Lake tables are unique on their key, so a mart that keeps the key as it is does
not shuffle for it again. Only where the key changes on the way (an id cast from
text to integer) is the first-row rule applied once more.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.casts import (
    double_or_null,
    five_digit_zip,
    in_int_range,
    lenient_double,
    lenient_long,
    lenient_timestamp,
    strict,
    strict_timestamp,
    timestamp_or_null,
)
from wardline.functions.dates import monday_based_weekday, trip_date
from wardline.functions.numbers import coordinate_key, estimated_cases, snap_half_away, snap_half_even
from wardline.functions.text import blank_to_null, null_to_blank, without_dashes
from wardline.operators.checks import flag_rejects
from wardline.operators.filters import (
    AIRPORT_PLACES,
    NEW_CONSTRUCTION,
    ZIP_GEOGRAPHY,
    below,
    contact_or_area,
    drop_blank,
    either_present,
    equals,
    one_of,
)
from wardline.operators.forecast import daily_counts, rolling_forecast
from wardline.operators.keyed import keyed_first
from wardline.operators.lookups import broadcast_if_small, in_any, last_match, lookup_join
from wardline.operators.mapping import SAMPLE_SIZE, zip_by_vote
from wardline.operators.spatial import ZoneIndex, locate

# Fixed value: a community counts as low-income below this per-capita income.
LOW_INCOME = 30000

ENDS = ("pickup", "dropoff")


def _take(df: DataFrame, limit: int | None, key: str) -> DataFrame:
    """Optional row limit; off by default, and in key order so that it repeats."""
    return df if limit is None else df.orderBy(key).limit(limit)


def trip_points(trips: DataFrame, snap=None) -> DataFrame:
    """Trip identity, lenient start time and the four coordinates, NULL where not a number."""

    def point(name: str) -> Column:
        parsed = double_or_null(F.col(name))
        return snap(parsed) if snap else parsed

    return trips.select(
        "tripid",
        "taxiid",
        lenient_timestamp(F.col("tripstarttimestamp")).alias("tripstarttimestamp"),
        *[
            point(f"{end}centroid{axis}").alias(f"{end}{axis}")
            for end in ENDS
            for axis in ("latitude", "longitude")
        ],
    )


def _zero_coordinates(df: DataFrame) -> DataFrame:
    """Unparsed coordinates show as 0.0. Done after the lookup: they have no zone."""
    names = [f"{end}{axis}" for end in ENDS for axis in ("latitude", "longitude")]
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(0.0)) for name in names})


def point_columns(suffix: str = "zip") -> Mapping[str, tuple[str, str]]:
    return {f"{end}{suffix}": (f"{end}longitude", f"{end}latitude") for end in ENDS}


def zip_number(zone: Column) -> Column:
    """Zip text as integer, 0 for "no zip"."""
    return lenient_long(five_digit_zip(null_to_blank(zone)))


# ---------------------------------------------------------------- area → zip

def comm_zips(boundaries: DataFrame, zips: ZoneIndex, size: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """Community area → the zip most of its sampled outline lies in."""
    voted = zip_by_vote(boundaries, ["areanum", "community"], zips, size, seed)
    return voted.select("zipcode", strict(F.col("areanum"), "int").alias("areanum"), "community")


def neighborhood_zips(neighborhoods: DataFrame, zips: ZoneIndex, size: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """Neighborhood → the zip most of its sampled outline lies in; sampled on the keys it votes on."""
    return zip_by_vote(neighborhoods, ["pri_neigh", "sec_neigh"], zips, size, seed).select(
        "zipcode", "pri_neigh", "sec_neigh"
    )


# ---------------------------------------------------------------- health alerts

def covid_taxi_trips(
    trips: DataFrame, zips: ZoneIndex, strict_zip: bool = False, limit: int | None = None
) -> DataFrame:
    """Trips with both zips, coordinates snapped to 0.001°; ``reject_reason`` for zips over six characters.

    ``strict_zip`` keeps long zips as they are, which then are rejected; by default they are cut to five digits.
    """
    points = trip_points(_take(trips, limit, "tripid"), snap_half_away)
    located = _zero_coordinates(locate(points, zips, point_columns("zipcode")))
    for end in ENDS:
        zone = null_to_blank(F.col(f"{end}zipcode"))
        located = located.withColumn(f"{end}zipcode", zone if strict_zip else five_digit_zip(zone))
    return flag_rejects(
        located,
        {f"{end}zipcode longer than 6": F.length(f"{end}zipcode") <= 6 for end in ENDS},
    )


def covid_reports(weekly: DataFrame, limit: int | None = None) -> DataFrame:
    """Weekly reports per zip with the estimated case count; numbers beyond 32 bits are rejected."""
    typed = _take(weekly, limit, "rowid").select(
        "zipcode",
        lenient_timestamp(F.col("weekstart")).alias("weekstart"),
        lenient_timestamp(F.col("weekend")).alias("weekend"),
        lenient_long(F.col("testsweekly")).alias("testsweekly"),
        lenient_double(F.col("pctpositiveweekly")).alias("pctpos"),
        lenient_long(F.col("population")).alias("population"),
    )
    counted = typed.withColumn("cases", estimated_cases(F.col("pctpos"), F.col("testsweekly")))
    return flag_rejects(
        counted,
        {
            f"{name} does not fit 32 bits": F.coalesce(in_int_range(F.col(name)), F.lit(False))
            for name in ("testsweekly", "population", "cases")
        },
    )


# ---------------------------------------------------------------- airport trips

def airport_trips(
    trips: DataFrame,
    places: ZoneIndex,
    zips: ZoneIndex,
    neighborhood_of_zip: DataFrame | None = None,
    airports: tuple[str, ...] = AIRPORT_PLACES,
    limit: int | None = None,
) -> DataFrame:
    """Trips picked up at an airport, with dropoff zip and neighborhood.

    The cheap place lookup and its filter come first; only airport trips get a zip.
    """
    points = trip_points(_take(trips, limit, "tripid"))
    named = locate(points, places, {"pickuplocationname": ("pickuplongitude", "pickuplatitude")})
    picked = one_of(named, "pickuplocationname", airports)
    located = locate(picked, zips, {"dropoffzip": ("dropofflongitude", "dropofflatitude")})
    typed = _zero_coordinates(located.withColumn("dropoffzipcode", zip_number(F.col("dropoffzip")))).drop("dropoffzip")
    if neighborhood_of_zip is None:
        return typed.withColumn("dropoffneighborhood", F.lit(None).cast("string"))
    return lookup_join(
        typed,
        _neighborhood_per_zip(neighborhood_of_zip),
        "dropoffzipcode",
        "zip",
        {"dropoffneighborhood": ("pri_neigh", None)},
        unknown=0,
    )


# ---------------------------------------------------------------- vulnerability

def _neighborhood_per_zip(mapping: DataFrame) -> DataFrame:
    """One neighborhood per zip; of several the last name in the alphabet."""
    typed = mapping.select(zip_number(F.col("zipcode")).alias("zip"), "pri_neigh")
    return broadcast_if_small(last_match(typed, "zip", F.col("pri_neigh")))


def vulnerability_per_zip(ccvi: DataFrame) -> DataFrame:
    """Score and category per zip, the last record of a zip wins."""
    typed = equals(ccvi, "geo_type", ZIP_GEOGRAPHY).select(
        lenient_long(F.col("community_area_or_zip")).alias("zip"),
        lenient_double(F.col("ccvi_score")).alias("score"),
        F.col("ccvi_category").alias("category"),
        "ingest_seq",
    )
    return broadcast_if_small(last_match(typed, "zip", F.col("ingest_seq")).drop("ingest_seq"))


def ccvi_alerts(
    trips: DataFrame, ccvi: DataFrame, neighborhood_of_zip: DataFrame, zips: ZoneIndex, limit: int | None = None
) -> DataFrame:
    """Trips with vulnerability score, category and neighborhood of both ends."""
    located = locate(trip_points(_take(trips, limit, "tripid")), zips, point_columns("zone"))
    df = _zero_coordinates(located)
    scores, names = vulnerability_per_zip(ccvi), _neighborhood_per_zip(neighborhood_of_zip)
    for end in ENDS:
        df = df.withColumn(f"{end}zipcode", zip_number(F.col(f"{end}zone"))).drop(f"{end}zone")
        df = lookup_join(
            df,
            scores,
            f"{end}zipcode",
            "zip",
            {f"{end}ccviscore": ("score", 0.0), f"{end}ccvicategory": ("category", "")},
            unknown=0,
        )
        df = lookup_join(df, names, f"{end}zipcode", "zip", {f"{end}neighborhood": ("pri_neigh", "")}, unknown=0)
    return df


# ---------------------------------------------------------------- traffic forecast

def typed_trips(trips: DataFrame, zips: ZoneIndex) -> DataFrame:
    """Trips with all coordinates, duration and distance filled, strictly typed, with both zips."""
    coordinates = {f"{end}{axis}": f"{end}centroid{axis}" for end in ENDS for axis in ("latitude", "longitude")}
    filled = drop_blank(drop_blank(trips, *coordinates.values()), "tripseconds", "tripmiles")
    typed = filled.select(
        "tripid",
        "taxiid",
        strict_timestamp(F.col("tripstarttimestamp")).alias("tripstarttimestamp"),
        strict_timestamp(F.col("tripendtimestamp")).alias("tripendtimestamp"),
        strict(F.col("tripseconds"), "double").alias("tripseconds"),
        strict(F.col("tripmiles"), "double").alias("tripmiles"),
        *[snap_half_even(strict(F.col(source), "double")).alias(name) for name, source in coordinates.items()],
    )
    located = locate(typed, zips, point_columns("zip"))
    return located.select(
        "tripid",
        "taxiid",
        "tripstarttimestamp",
        "tripendtimestamp",
        "tripseconds",
        "tripmiles",
        "dropoffzip",
        "pickupzip",
        *[coordinate_key(F.col(f"{end}latitude"), F.col(f"{end}longitude")).alias(f"{end}coords") for end in ENDS],
        trip_date(F.col("tripstarttimestamp")).alias("tripdate"),
        monday_based_weekday(F.col("tripstarttimestamp")).alias("tripweekday"),
    )


def trip_forecast(typed: DataFrame) -> DataFrame:
    """Daily trips per zip with next-day and next-week predictions."""
    return rolling_forecast(daily_counts(typed, "tripdate", "pickupzip", "dropoffzip"))


def area_forecast(zip_counts: DataFrame, neighborhood_of_zip: DataFrame) -> DataFrame:
    """The forecast per neighborhood.

    A neighborhood follows from the zip, so it starts from the daily counts per zip
    and never goes back to the trips.
    """
    counts = zip_counts.select("tripdate", "trips", zip_number(F.col("zip")).alias("zipcode"))
    named = lookup_join(
        counts, _neighborhood_per_zip(neighborhood_of_zip), "zipcode", "zip", {"area": ("pri_neigh", None)}, unknown=0
    )
    daily = (
        named.filter(F.col("area").isNotNull()).groupBy("tripdate", "area").agg(F.sum("trips").alias("trips"))
    )
    return rolling_forecast(daily, zone="area")


def community_forecast(trips: DataFrame) -> DataFrame:
    """The forecast per community area, straight from the areas the trips carry.

    A trip whose start cannot be read has no date and is not counted.
    """
    dated = trips.select(
        trip_date(timestamp_or_null(F.col("tripstarttimestamp"))).alias("tripdate"),
        *[blank_to_null(F.col(f"{end}communityarea")).alias(end) for end in ENDS],
    ).filter(F.col("tripdate").isNotNull())
    return rolling_forecast(daily_counts(dated, "tripdate", *ENDS)).withColumnRenamed("zip", "area")


# ---------------------------------------------------------------- community and permits

def community_health_stats(health: DataFrame) -> DataFrame:
    """Community statistics, strictly typed: one bad number fails the load."""
    typed = health.select(
        strict(F.col("communityarea"), "int").alias("communityarea"),
        "communityareaname",
        strict(F.col("belowpoverty"), "double").alias("belowpoverty"),
        strict(F.col("percapitaincome"), "int").alias("percapitaincome"),
        strict(F.col("unemployment"), "double").alias("unemployment"),
        "ingest_seq",
    )
    return keyed_first(typed, ["communityarea"], ["ingest_seq"]).drop("ingest_seq")


def fee_waiver_permits(permits: DataFrame, blank_as_null: bool = True, limit: int | None = None) -> DataFrame:
    """Permits with a contact zip or a community area.

    Blank text counts as missing; ``blank_as_null=False`` takes the condition literally.
    The id is cast strictly, so ``7`` and ``007`` meet and the first one stays.
    """
    wanted = permits.filter(contact_or_area("contact_zip", "community_area", blank_as_null))
    rows = _take(wanted, limit, "id").select(
        strict(F.col("id"), "bigint").cast("string").alias("id"),
        "permit_type",
        "review_type",
        "processing_time",
        "work_description",
        "total_fee",
        "reported_cost",
        "community_area",
        without_dashes(F.col("contact_zip")).alias("contact_zip"),
        "ingest_seq",
    )
    return keyed_first(rows, ["id"], ["ingest_seq"]).drop("ingest_seq")


def low_income_zips(health: DataFrame, community_zips: DataFrame, income: int = LOW_INCOME) -> DataFrame:
    """Zips of the communities below the income limit."""
    poor = below(health, "percapitaincome", income).select(lenient_long(F.col("communityarea")).alias("area"))
    mapping = community_zips.select(F.col("areanum").cast("bigint").alias("areanum"), "zipcode")
    per_area = broadcast_if_small(last_match(mapping, "areanum", F.col("zipcode")))
    mapped = lookup_join(poor, per_area, "area", "areanum", {"zone": ("zipcode", "")})
    return mapped.select(zip_number(F.col("zone")).alias("zip")).filter(F.col("zip") != 0)


def new_construction(
    permits: DataFrame, health: DataFrame, community_zips: DataFrame, zips: ZoneIndex, limit: int | None = None
) -> DataFrame:
    """New-construction permits in the zips of low-income communities."""
    new = _take(equals(permits, "permit_type", NEW_CONSTRUCTION), limit, "id").select(
        "id",
        lenient_long(F.col("permit_num")).alias("permitnum"),
        F.col("permit_type").alias("permittype"),
        double_or_null(F.col("latitude")).alias("latitude"),
        double_or_null(F.col("longitude")).alias("longitude"),
    )
    located = locate(new, zips, {"zone": ("longitude", "latitude")})
    typed = located.withColumn("permitzipcode", zip_number(F.col("zone"))).drop("zone")
    qualified = in_any(typed, "permitzipcode", low_income_zips(health, community_zips), "zip").withColumns(
        {name: F.coalesce(F.col(name), F.lit(0.0)) for name in ("latitude", "longitude")}
    )
    return flag_rejects(
        qualified,
        {f"{name} does not fit 32 bits": in_int_range(F.col(name)) for name in ("permitnum", "permitzipcode")},
    )


def trips_by_area(trips: DataFrame, blank_as_null: bool = True, limit: int | None = None) -> DataFrame:
    """Trips that carry at least one community area."""
    areas = [f"{end}communityarea" for end in ENDS]
    kept = either_present(trips, *areas, blank_as_null=blank_as_null)
    return _take(kept, limit, "tripid").select(
        "tripid",
        "tripmiles",
        "triptotal",
        *[null_to_blank(F.col(name)).alias(name) for name in areas],
        lenient_timestamp(F.col("tripstarttimestamp")).alias("tripstarttimestamp"),
    )
