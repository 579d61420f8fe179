"""The marts and the area operators over the warehouse tables reshaped as city feeds."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.checks import REASON
from wardline.operators.filters import AIRPORT_PLACES
from wardline.operators.spatial import (
    ZoneIndex,
    assemble_rings,
    attach_zones,
    build_zone_index,
    distinct_points,
    locate,
    probed_index,
    ring_vertices,
    zone_of_points,
)
from wardline.operators.zone_memo import locate_kept
from wardline.operators.zone_store import open_zone_index
from wardline.plans import marts
from wardline.plans.basic_queries import ROLLING_SQL, TRIP_STEPS_SQL, trip_coordinates
from wardline.plans.city_tables import (
    COLUMNS,
    SOUTH,
    STEPS,
    WEST,
    ZONE,
    lake_rows,
    multipolygon,
    square_ring,
    table,
)
from wardline.plans.registry import query
from wardline.session import kept_path, scratch_path, stable


def _store(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where the index of an outline table is kept; queries over other tables keep another."""
    return kept_path(spark, f"{name}-{zlib.crc32(sf_dir.rstrip('/').encode()):08x}")


def zip_index(spark: SparkSession, sf_dir: str) -> ZoneIndex:
    return open_zone_index(spark, lake_rows(spark, sf_dir, "zipcodes"), "zip", _store(spark, sf_dir, "zips"))


def place_index(spark: SparkSession, sf_dir: str) -> ZoneIndex:
    return open_zone_index(spark, lake_rows(spark, sf_dir, "places"), "display_name", _store(spark, sf_dir, "places"))


def _moments_as_text(df: DataFrame) -> DataFrame:
    """Dates and moments as text, the form both engines write alike."""
    shown = {}
    for name, kind in df.dtypes:
        if kind == "date":
            shown[name] = F.date_format(name, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            shown[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(shown) if shown else df


# ---------------------------------------------------------------- shared SQL

ZIPS_SQL = f"""
    zips AS (
        SELECT s_suppkey AS n, '6' || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0')
                   || CASE WHEN s_suppkey % 25 = 7 THEN '-1234' ELSE '' END AS zip,
               CAST({WEST} + s_suppkey % {COLUMNS} * {ZONE} AS DOUBLE) / {STEPS} AS x0,
               CAST({WEST} + s_suppkey % {COLUMNS} * {ZONE} + {ZONE} AS DOUBLE) / {STEPS} AS x1,
               CAST({SOUTH} + s_suppkey // {COLUMNS} * {ZONE} AS DOUBLE) / {STEPS} AS y0,
               CAST({SOUTH} + s_suppkey // {COLUMNS} * {ZONE} + {ZONE} AS DOUBLE) / {STEPS} AS y1
        FROM supplier)
"""

TRIPS_SQL = f"""
    raw_steps AS (SELECT *, {TRIP_STEPS_SQL} FROM lineitem),
    trips AS (
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         CAST(round(l_extendedprice * 100) AS BIGINT)) AS tripid, 'taxi' || l_suppkey AS taxiid,
               l_shipdate + to_seconds(CAST(l_partkey * 37 % 86400 AS INTEGER)) AS started,
               CASE WHEN NOT (l_linenumber = 7 AND l_linestatus = 'F') THEN CAST(plon4 AS DOUBLE) / {STEPS} END AS plon,
               CASE WHEN NOT (l_linenumber = 7 AND l_linestatus = 'F') THEN CAST(plat4 AS DOUBLE) / {STEPS} END AS plat,
               CAST(dlon4 AS DOUBLE) / {STEPS} AS dlon, CAST(dlat4 AS DOUBLE) / {STEPS} AS dlat,
               CAST(l_quantity AS BIGINT) AS quantity, CAST(trunc(l_extendedprice) AS BIGINT) AS total,
               CASE WHEN l_linenumber <> 2 THEN CAST(l_suppkey % 77 + 1 AS VARCHAR) END AS parea,
               CASE WHEN l_linenumber NOT IN (2, 3) THEN CAST(l_partkey % 77 + 1 AS VARCHAR) END AS darea
        FROM raw_steps)
"""


def _zone_join(lon: str, lat: str, name: str) -> str:
    return (
        f"LEFT JOIN zips {name} ON {lon} >= {name}.x0 AND {lon} < {name}.x1 "
        f"AND {lat} >= {name}.y0 AND {lat} < {name}.y1"
    )


_SHORT_ZIP = "coalesce(CASE WHEN {0}.zip LIKE '%-%' THEN left({0}.zip, 5) ELSE {0}.zip END, '')"
_ZIP_NUMBER = "coalesce(CAST(left({0}.zip, 5) AS INTEGER), 0)"
_STARTED = "strftime(started, '%Y-%m-%d %H:%M:%S')"


def _outline_sql(west: int, south: int, side: int, steps: int) -> str:
    """Vertices of the moved squares: area number n, position seq, corner-to-corner walk in steps."""
    stride = side // steps
    return f"""
        outline AS (
            SELECT s_suppkey AS n, s_name, s_nationkey, seq,
                   {WEST} + s_suppkey % {COLUMNS} * {ZONE} + {west} + CASE seq // {steps}
                       WHEN 0 THEN seq % {steps} * {stride} WHEN 1 THEN {side}
                       WHEN 2 THEN {side} - seq % {steps} * {stride} ELSE 0 END AS lon4,
                   {SOUTH} + s_suppkey // {COLUMNS} * {ZONE} + {south} + CASE seq // {steps}
                       WHEN 1 THEN seq % {steps} * {stride} WHEN 2 THEN {side}
                       WHEN 3 THEN {side} - seq % {steps} * {stride} ELSE 0 END AS lat4
            FROM supplier, range({4 * steps + 1}) t(seq))
    """


def _vote_sql(west: int, south: int, side: int, steps: int, group: str) -> str:
    """Sampled outline points, their zones, and the winner per area."""
    return f"""{_outline_sql(west, south, side, steps)},
        corners AS (SELECT *, CAST(n + 1 AS VARCHAR) AS areanum, 'SIDE ' || s_nationkey AS side_name,
                         CAST(lon4 AS DOUBLE) / {STEPS} AS lon, CAST(lat4 AS DOUBLE) / {STEPS} AS lat FROM outline),
        drawn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {group}
            ORDER BY md5(concat_ws('|', {group}, 0, 0, seq, '42'))) AS draw FROM corners) WHERE draw <= 20),
        votes AS (SELECT {group}, z.zip, count(*) AS n FROM drawn JOIN zips z ON lon >= z.x0 AND lon < z.x1
            AND lat >= z.y0 AND lat < z.y1 GROUP BY ALL),
        voted AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY n DESC, zip) AS place
            FROM votes) WHERE place = 1)"""


COMM_VOTE_SQL = _vote_sql(150, 200, ZONE, 10, "areanum, s_name")
NEIGH_VOTE_SQL = _vote_sql(300, 100, 300, 3, "s_name, side_name")
NEIGH_PER_ZIP_SQL = """
    neigh AS (SELECT CAST(left(zip, 5) AS INTEGER) AS zipnum, max(s_name) AS pri_neigh FROM voted GROUP BY ALL)
"""


# ---------------------------------------------------------------- outlines and zones

@query(
    "ring_vertices",
    sql=f"""WITH {_outline_sql(150, 200, ZONE, 10)}
        SELECT CAST(n + 1 AS VARCHAR) AS areanum, s_name AS community, 0 AS part, 0 AS ring, CAST(seq AS INTEGER) AS seq,
               CAST(lon4 AS DOUBLE) / {STEPS} AS longitude, CAST(lat4 AS DOUBLE) / {STEPS} AS latitude FROM outline""",
)
def ring_vertices_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outer ring of every community area, one row per vertex, axes named as they are."""
    return lake_rows(spark, sf_dir, "community_boundaries").drop("shapearea", "shapelen", "ingest_seq")


@query(
    "ring_assembly",
    sql=f"""WITH {_outline_sql(150, 200, ZONE, 10)}
        SELECT CAST(n + 1 AS VARCHAR) AS areanum, count(*) AS vertices,
               CAST(list_extract(list(lon4 ORDER BY seq), 12) AS DOUBLE) / {STEPS} AS twelfth_x,
               CAST(list_extract(list(lat4 ORDER BY seq), 12) AS DOUBLE) / {STEPS} AS twelfth_y
        FROM outline GROUP BY ALL""",
)
def ring_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices back to rings, in order."""
    rings = assemble_rings(lake_rows(spark, sf_dir, "community_boundaries"), "areanum")
    twelfth = F.get("points", F.lit(11))
    return rings.select(
        "areanum",
        F.size("points").cast("bigint").alias("vertices"),
        twelfth["x"].alias("twelfth_x"),
        twelfth["y"].alias("twelfth_y"),
    )


_BOTH_ZONES_SQL = f"""WITH {ZIPS_SQL}, {TRIPS_SQL}
    SELECT tripid, coalesce(p.zip, '') AS pickupzip, coalesce(q.zip, '') AS dropoffzip
    FROM trips {_zone_join("plon", "plat", "p")} {_zone_join("dlon", "dlat", "q")}"""


@query("point_in_polygon", sql=_BOTH_ZONES_SQL)
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip of both ends of every trip."""
    located = locate(marts.trip_points(lake_rows(spark, sf_dir, "taxi_trips")), zip_index(spark, sf_dir), marts.point_columns("zip"))
    return located.select("tripid", *[F.coalesce(f"{end}zip", F.lit("")).alias(f"{end}zip") for end in marts.ENDS])


@query("coord_lookup", sql=_BOTH_ZONES_SQL)
def coord_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through distinct coordinates: look each up once, then join the answers back."""
    points = marts.trip_points(lake_rows(spark, sf_dir, "taxi_trips"))
    ends = marts.point_columns("zip")
    asked, index = stable(distinct_points(points, *ends.values())), zip_index(spark, sf_dir)
    found = stable(zone_of_points(asked, index if index.directory is not None else probed_index(asked, index)))
    located = attach_zones(points, found, ends)
    return located.select("tripid", *[F.coalesce(f"{end}zip", F.lit("")).alias(f"{end}zip") for end in marts.ENDS])


@query("coord_lookup_kept", sql=_BOTH_ZONES_SQL)
def coord_lookup_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in two runs that share a table of coordinates: the second locates only those that the first did not meet."""
    store = scratch_path(spark, "zone-store")
    index = open_zone_index(spark, lake_rows(spark, sf_dir, "zipcodes"), "zip", store)
    points, ends = marts.trip_points(lake_rows(spark, sf_dir, "taxi_trips")), marts.point_columns("zip")
    locate_kept(points.where(F.col("tripid") < "5"), index, ends, store)
    located, _ = locate_kept(points, index, ends, store)
    return located.select("tripid", *[F.coalesce(f"{end}zip", F.lit("")).alias(f"{end}zip") for end in marts.ENDS])


@query(
    "coord_union",
    sql=f"""WITH steps AS (SELECT {TRIP_STEPS_SQL} FROM lineitem)
        SELECT CAST(plon4 AS DOUBLE) / {STEPS} AS lon, CAST(plat4 AS DOUBLE) / {STEPS} AS lat FROM steps
        UNION SELECT CAST(dlon4 AS DOUBLE) / {STEPS}, CAST(dlat4 AS DOUBLE) / {STEPS} FROM steps""",
)
def coord_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct coordinates over both ends of all trips."""
    return distinct_points(trip_coordinates(spark, sf_dir), ("plon", "plat"), ("dlon", "dlat"))


@query(
    "polygon_with_holes",
    sql=f"""WITH points AS (SELECT l_orderkey, l_linenumber, l_suppkey, {TRIP_STEPS_SQL} FROM lineitem),
        spots AS (SELECT *, dlon4 - ({WEST}) AS x, dlat4 - ({SOUTH}) AS y FROM points),
        cells AS (SELECT *, CAST(floor(x / 1000.0) AS INTEGER) AS cx, CAST(floor(y / 1000.0) AS INTEGER) AS cy FROM spots),
        inside AS (SELECT *, x - cx * 1000 AS dx, y - cy * 1000 AS dy FROM cells)
        SELECT l_orderkey, l_linenumber, l_suppkey,
               CASE WHEN cx BETWEEN 0 AND 4 AND cy BETWEEN 0 AND 4
                     AND (NOT (dx >= 200 AND dx < 800 AND dy >= 200 AND dy < 800)
                          OR (dx >= 400 AND dx < 600 AND dy >= 400 AND dy < 600))
                    THEN (SELECT n_name FROM nation WHERE n_nationkey = cx + 5 * cy) ELSE '' END AS area
        FROM inside""",
)
def polygon_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones with a hole and, inside the hole, a second polygon."""
    key = F.col("n_nationkey")
    west, south = F.lit(WEST) + key % 5 * 1000, F.lit(SOUTH) + F.floor(key / F.lit(5)) * 1000
    frame = [square_ring(west, south, 1000, 1), square_ring(west + 200, south + 200, 600, 1)]
    island = [square_ring(west + 400, south + 400, 200, 1)]
    shapes = table(spark, sf_dir, "nation").select("n_name", multipolygon(frame, island))
    index = build_zone_index(ring_vertices(shapes, all_rings=True), "n_name")
    located = locate(trip_coordinates(spark, sf_dir), index, {"area": ("dlon", "dlat")})
    return located.select("l_orderkey", "l_linenumber", "l_suppkey", F.coalesce("area", F.lit("")).alias("area"))


# ---------------------------------------------------------------- area to zip

@query(
    "comm_zips",
    sql=f"WITH {ZIPS_SQL}, {COMM_VOTE_SQL} SELECT zip AS zipcode, CAST(areanum AS INTEGER) AS areanum, s_name AS community FROM voted",
)
def comm_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.comm_zips(lake_rows(spark, sf_dir, "community_boundaries"), zip_index(spark, sf_dir))


@query(
    "neighborhood_zips",
    sql=f"WITH {ZIPS_SQL}, {NEIGH_VOTE_SQL} SELECT zip AS zipcode, s_name AS pri_neigh, side_name AS sec_neigh FROM voted",
)
def neighborhood_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.neighborhood_zips(lake_rows(spark, sf_dir, "neighborhoods"), zip_index(spark, sf_dir))


def _neighborhoods(spark: SparkSession, sf_dir: str, zips: ZoneIndex) -> DataFrame:
    """The neighborhood map as other marts find it: written, then read."""
    return stable(marts.neighborhood_zips(lake_rows(spark, sf_dir, "neighborhoods"), zips))


# ---------------------------------------------------------------- marts on trips

@query(
    "covid_taxi_trips",
    sql=f"""WITH {ZIPS_SQL}, {TRIPS_SQL},
        snapped AS (SELECT tripid, taxiid, started, round(plon * 1000) / 1000 AS plon, round(plat * 1000) / 1000 AS plat,
                           round(dlon * 1000) / 1000 AS dlon, round(dlat * 1000) / 1000 AS dlat FROM trips)
        SELECT tripid, taxiid, {_STARTED} AS tripstarttimestamp, coalesce(plat, 0) AS pickuplatitude,
               coalesce(plon, 0) AS pickuplongitude, dlat AS dropofflatitude, dlon AS dropofflongitude,
               {_SHORT_ZIP.format('p')} AS pickupzipcode, {_SHORT_ZIP.format('q')} AS dropoffzipcode, '' AS reject_reason
        FROM snapped {_zone_join("plon", "plat", "p")} {_zone_join("dlon", "dlat", "q")}""",
)
def covid_taxi_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = marts.covid_taxi_trips(lake_rows(spark, sf_dir, "taxi_trips"), zip_index(spark, sf_dir))
    return _moments_as_text(trips).withColumn(REASON, F.coalesce(REASON, F.lit("")))


@query(
    "strict_zip_rejects",
    sql=f"""WITH {ZIPS_SQL}, {TRIPS_SQL},
        snapped AS (SELECT tripid, round(plon * 1000) / 1000 AS plon, round(plat * 1000) / 1000 AS plat,
                           round(dlon * 1000) / 1000 AS dlon, round(dlat * 1000) / 1000 AS dlat FROM trips)
        SELECT tripid, coalesce(p.zip, '') AS pickupzipcode, coalesce(q.zip, '') AS dropoffzipcode,
               CASE WHEN length(p.zip) > 6 THEN 'pickupzipcode longer than 6' ELSE 'dropoffzipcode longer than 6' END
                   AS reject_reason
        FROM snapped {_zone_join("plon", "plat", "p")} {_zone_join("dlon", "dlat", "q")}
        WHERE length(p.zip) > 6 OR length(q.zip) > 6""",
)
def strict_zip_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips turned away when zips are taken as they come."""
    trips = marts.covid_taxi_trips(lake_rows(spark, sf_dir, "taxi_trips"), zip_index(spark, sf_dir), strict_zip=True)
    return trips.filter(F.col(REASON).isNotNull()).select("tripid", "pickupzipcode", "dropoffzipcode", REASON)


@query(
    "covid_reports",
    sql="""WITH typed AS (
        SELECT '606' || lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0') AS zipcode,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS weekstart,
               strftime(o_orderdate + INTERVAL 6 DAYS, '%Y-%m-%d %H:%M:%S') AS weekend,
               CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE o_orderkey * 7 % 500 END AS testsweekly,
               CAST('0.' || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS pctpos,
               CASE WHEN o_orderkey % 997 = 0 THEN 99999999999 ELSE o_custkey * 31 % 50000 END AS population FROM orders)
        SELECT *, CAST(round(pctpos * testsweekly) AS BIGINT) AS cases,
               CASE WHEN population > 2147483647 THEN 'population does not fit 32 bits' ELSE '' END AS reject_reason
        FROM typed""",
)
def covid_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = marts.covid_reports(lake_rows(spark, sf_dir, "weekly_covid_by_zip"))
    return _moments_as_text(reports).withColumn(REASON, F.coalesce(REASON, F.lit("")))


PLACES_SQL = f"""
    places AS (
        SELECT CASE r_regionkey WHEN 0 THEN $0 WHEN 1 THEN $1 WHEN 2 THEN $2 ELSE r_name END AS place,
               CAST(-879036 - 300 + r_regionkey * 500 AS DOUBLE) / {STEPS} AS x0,
               CAST(-879036 + 300 + r_regionkey * 500 AS DOUBLE) / {STEPS} AS x1,
               CAST(419796 - 300 - r_regionkey * 500 AS DOUBLE) / {STEPS} AS y0,
               CAST(419796 + 300 - r_regionkey * 500 AS DOUBLE) / {STEPS} AS y1
        FROM region)
"""
for _i, _name in enumerate(AIRPORT_PLACES):
    _quoted = _name.replace("'", "''")
    PLACES_SQL = PLACES_SQL.replace(f"${_i}", f"'{_quoted}'")


@query(
    "airport_trips",
    sql=f"""WITH {PLACES_SQL}, {ZIPS_SQL}, {NEIGH_VOTE_SQL}, {NEIGH_PER_ZIP_SQL}, {TRIPS_SQL},
        named AS (SELECT t.*, (SELECT min(place) FROM places p WHERE plon >= p.x0 AND plon < p.x1
                               AND plat >= p.y0 AND plat < p.y1) AS place FROM trips t),
        picked AS (SELECT * FROM named WHERE place LIKE '%Airport,%' OR place LIKE 'Lot A%'),
        zoned AS (SELECT picked.*, {_ZIP_NUMBER.format('q')} AS dropoffzipcode FROM picked {_zone_join("dlon", "dlat", "q")})
        SELECT tripid, taxiid, {_STARTED} AS tripstarttimestamp, coalesce(plat, 0) AS pickuplatitude,
               coalesce(plon, 0) AS pickuplongitude, place AS pickuplocationname, dlat AS dropofflatitude,
               dlon AS dropofflongitude, dropoffzipcode, coalesce(pri_neigh, '') AS dropoffneighborhood
        FROM zoned LEFT JOIN neigh ON zipnum = dropoffzipcode""",
)
def airport_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    zips = zip_index(spark, sf_dir)
    trips = marts.airport_trips(
        lake_rows(spark, sf_dir, "taxi_trips"), place_index(spark, sf_dir), zips, _neighborhoods(spark, sf_dir, zips)
    )
    shown = _moments_as_text(trips).withColumn("dropoffzipcode", F.col("dropoffzipcode").cast("int"))
    return shown.withColumn("dropoffneighborhood", F.coalesce("dropoffneighborhood", F.lit("")))


SCORES_SQL = """
    scores AS (SELECT CAST('6' || lpad(CAST(c_custkey // 15 % 10000 AS VARCHAR), 4, '0') AS INTEGER) AS zipnum,
        max_by(CAST(c_custkey % 100 || '.' || c_custkey % 10 AS DOUBLE), c_custkey) AS score,
        max_by(['LOW', 'MEDIUM', 'HIGH'][c_custkey % 3 + 1], c_custkey) AS category
        FROM customer WHERE c_custkey % 4 <> 3 GROUP BY ALL)
"""


@query(
    "ccvi_alerts",
    sql=f"""WITH {ZIPS_SQL}, {NEIGH_VOTE_SQL}, {NEIGH_PER_ZIP_SQL}, {SCORES_SQL}, {TRIPS_SQL},
        zoned AS (SELECT trips.*, {_ZIP_NUMBER.format('p')} AS pz, {_ZIP_NUMBER.format('q')} AS qz
                  FROM trips {_zone_join("plon", "plat", "p")} {_zone_join("dlon", "dlat", "q")})
        SELECT tripid, taxiid, {_STARTED} AS tripstarttimestamp, coalesce(plat, 0) AS pickuplatitude,
               coalesce(plon, 0) AS pickuplongitude, dlat AS dropofflatitude, dlon AS dropofflongitude,
               pz AS pickupzipcode, qz AS dropoffzipcode,
               coalesce(ps.score, 0) AS pickupccviscore, coalesce(ps.category, '') AS pickupccvicategory,
               coalesce(qs.score, 0) AS dropoffccviscore, coalesce(qs.category, '') AS dropoffccvicategory,
               coalesce(pn.pri_neigh, '') AS pickupneighborhood, coalesce(qn.pri_neigh, '') AS dropoffneighborhood
        FROM zoned LEFT JOIN scores ps ON ps.zipnum = pz LEFT JOIN scores qs ON qs.zipnum = qz
             LEFT JOIN neigh pn ON pn.zipnum = pz LEFT JOIN neigh qn ON qn.zipnum = qz""",
)
def ccvi_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    zips = zip_index(spark, sf_dir)
    alerts = marts.ccvi_alerts(
        lake_rows(spark, sf_dir, "taxi_trips"),
        lake_rows(spark, sf_dir, "covid_vulnerability"),
        _neighborhoods(spark, sf_dir, zips),
        zips,
    )
    numbers = {f"{end}zipcode": F.col(f"{end}zipcode").cast("int") for end in marts.ENDS}
    return _moments_as_text(alerts).withColumns(numbers)


TYPED_SQL = f"""{ZIPS_SQL}, {TRIPS_SQL},
    filled AS (SELECT *, round_even(plon * 1000, 0) / 1000 AS px, round_even(plat * 1000, 0) / 1000 AS py,
                      round_even(dlon * 1000, 0) / 1000 AS qx, round_even(dlat * 1000, 0) / 1000 AS qy
               FROM trips WHERE plon IS NOT NULL AND quantity NOT IN (13, 29)),
    typed AS (SELECT filled.*, p.zip AS pickupzip, q.zip AS dropoffzip
              FROM filled {_zone_join("px", "py", "p")} {_zone_join("qx", "qy", "q")})
"""
ZIP_COUNTS_SQL = """
    zip_counts AS (SELECT CAST(started AS DATE) AS d, zip, count(*) AS trips FROM (
        SELECT started, pickupzip AS zip FROM typed UNION ALL SELECT started, dropoffzip FROM typed)
        WHERE zip IS NOT NULL GROUP BY ALL)
"""


@query(
    "typed_trips",
    sql=f"""WITH {TYPED_SQL} SELECT tripid, taxiid, {_STARTED} AS tripstarttimestamp,
        strftime(started + INTERVAL 10 MINUTES, '%Y-%m-%d %H:%M:%S') AS tripendtimestamp,
        CAST(quantity * 60 AS DOUBLE) AS tripseconds, quantity + CAST(0.5 AS DOUBLE) AS tripmiles,
        coalesce(pickupzip, '') AS pickupzip, coalesce(dropoffzip, '') AS dropoffzip,
        py || ',' || px AS pickupcoords, qy || ',' || qx AS dropoffcoords,
        strftime(started, '%Y-%m-%d') AS tripdate, CAST(isodow(started) - 1 AS INTEGER) AS tripweekday FROM typed""",
)
def typed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = marts.typed_trips(lake_rows(spark, sf_dir, "taxi_trips"), zip_index(spark, sf_dir))
    zips = {f"{end}zip": F.coalesce(f"{end}zip", F.lit("")) for end in marts.ENDS}
    return _moments_as_text(typed).withColumns(zips)


@query(
    "trip_forecast",
    sql=f"WITH {TYPED_SQL}, {ZIP_COUNTS_SQL}, counts AS (SELECT * FROM zip_counts) {ROLLING_SQL.format(zone='zip')}",
)
def trip_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = marts.typed_trips(lake_rows(spark, sf_dir, "taxi_trips"), zip_index(spark, sf_dir))
    return _moments_as_text(marts.trip_forecast(typed))


@query(
    "area_forecast",
    sql=f"""WITH {TYPED_SQL}, {ZIP_COUNTS_SQL}, {NEIGH_VOTE_SQL}, {NEIGH_PER_ZIP_SQL},
        counts AS (SELECT d, pri_neigh AS area, CAST(sum(trips) AS BIGINT) AS trips
                   FROM zip_counts JOIN neigh ON zipnum = CAST(left(zip, 5) AS INTEGER) GROUP BY ALL)
        {ROLLING_SQL.format(zone='area')}""",
)
def area_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    zips = zip_index(spark, sf_dir)
    forecast = marts.trip_forecast(marts.typed_trips(lake_rows(spark, sf_dir, "taxi_trips"), zips))
    return _moments_as_text(marts.area_forecast(forecast, _neighborhoods(spark, sf_dir, zips)))


@query(
    "community_forecast",
    sql=f"""WITH {TRIPS_SQL}, counts AS (SELECT CAST(started AS DATE) AS d, area, count(*) AS trips FROM (
            SELECT started, parea AS area FROM trips UNION ALL SELECT started, darea FROM trips)
            WHERE area IS NOT NULL GROUP BY ALL)
        {ROLLING_SQL.format(zone='area')}""",
)
def community_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moments_as_text(marts.community_forecast(lake_rows(spark, sf_dir, "taxi_trips")))


@query(
    "trips_by_area",
    sql=f"""WITH {TRIPS_SQL} SELECT tripid, CASE WHEN quantity = 29 THEN '' ELSE quantity || '.5' END AS tripmiles,
        CAST(total AS VARCHAR) AS triptotal, coalesce(parea, '') AS pickupcommunityarea,
        coalesce(darea, '') AS dropoffcommunityarea, {_STARTED} AS tripstarttimestamp
        FROM trips WHERE parea IS NOT NULL OR darea IS NOT NULL""",
)
def trips_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moments_as_text(marts.trips_by_area(lake_rows(spark, sf_dir, "taxi_trips")))


# ---------------------------------------------------------------- communities and permits

HEALTH_SQL = """SELECT CAST(s_suppkey + 1 AS INTEGER) AS communityarea, s_name AS communityareaname,
    s_suppkey % 100 + CAST(0.5 AS DOUBLE) AS belowpoverty,
    CAST(s_suppkey * 1000 % 20000 + 20000 AS INTEGER) AS percapitaincome,
    s_suppkey % 20 + CAST(0.25 AS DOUBLE) AS unemployment FROM supplier"""


@query("community_health_stats", sql=HEALTH_SQL)
def community_health_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.community_health_stats(lake_rows(spark, sf_dir, "community_health"))


@query(
    "fee_waiver_permits",
    sql="""SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_type = 'ECONOMY' THEN 'PERMIT - NEW CONSTRUCTION'
            ELSE 'PERMIT - ' || p_type END AS permit_type, p_brand AS review_type, CAST(p_size AS VARCHAR) AS processing_time,
        p_name AS work_description, CAST(CAST(trunc(p_retailprice) AS BIGINT) AS VARCHAR) AS total_fee,
        CAST(p_partkey * 10 AS VARCHAR) AS reported_cost,
        CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey % 77 + 1 AS VARCHAR) ELSE '' END AS community_area,
        CASE p_partkey % 3 WHEN 1 THEN '606' || lpad(CAST(p_partkey % 25 AS VARCHAR), 2, '0')
            || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') WHEN 2 THEN '0' ELSE '' END AS contact_zip
        FROM part WHERE p_partkey % 3 <> 0""",
)
def fee_waiver_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fee_waiver_permits(lake_rows(spark, sf_dir, "building_permits"))


@query(
    "new_construction",
    sql=f"""WITH {ZIPS_SQL}, {COMM_VOTE_SQL},
        poor AS (SELECT DISTINCT CAST(left(zip, 5) AS INTEGER) AS zipnum FROM voted
                 WHERE (CAST(areanum AS INTEGER) - 1) * 1000 % 20000 + 20000 < 30000),
        permits AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_partkey AS k,
                           CAST({WEST} - 500 + p_partkey * 331 % 6000 AS DOUBLE) / {STEPS} AS lon,
                           CAST({SOUTH} - 500 + p_partkey * 257 % 6000 AS DOUBLE) / {STEPS} AS lat
                    FROM part WHERE p_type = 'ECONOMY'),
        numbered AS (SELECT *, CASE WHEN k % 50 = 1 THEN 0
            WHEN k % 50 = 2 THEN CAST('30000' || lpad(CAST(k AS VARCHAR), 6, '0') AS BIGINT) ELSE k + 100000 END AS permitnum
            FROM permits)
        SELECT id, permitnum, 'PERMIT - NEW CONSTRUCTION' AS permittype, lat AS latitude, lon AS longitude,
               CAST({_ZIP_NUMBER.format('q')} AS BIGINT) AS permitzipcode,
               CASE WHEN permitnum > 2147483647 THEN 'permitnum does not fit 32 bits' ELSE '' END AS reject_reason
        FROM numbered {_zone_join("lon", "lat", "q")}
        WHERE {_ZIP_NUMBER.format('q')} IN (SELECT zipnum FROM poor)""",
)
def new_construction(spark: SparkSession, sf_dir: str) -> DataFrame:
    zips = zip_index(spark, sf_dir)
    community_zips = stable(marts.comm_zips(lake_rows(spark, sf_dir, "community_boundaries"), zips))
    permits = marts.new_construction(
        lake_rows(spark, sf_dir, "building_permits"), lake_rows(spark, sf_dir, "community_health"), community_zips, zips
    )
    return permits.withColumn(REASON, F.coalesce(REASON, F.lit("")))
