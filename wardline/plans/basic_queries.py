"""Single operators on the warehouse tables as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.casts import (
    double_or_null,
    lenient_double,
    lenient_long,
    lenient_timestamp,
    long_or_null,
    strict,
    timestamp_or_null,
)
from wardline.functions.dates import monday_based_weekday, trip_date
from wardline.functions.numbers import (
    coordinate_key,
    estimated_cases,
    six_decimals,
    snap_half_away,
    snap_half_even,
)
from wardline.functions.text import without_dashes
from wardline.operators.checks import REASON, cast_audit, flag_rejects, load_audit
from wardline.operators.filters import below, drop_blank, either_present, equals
from wardline.operators.forecast import daily_counts, direction_counts, rolling_forecast, summed_counts
from wardline.operators.indexing import number_load, numbered_rows, with_row_index
from wardline.operators.kept_forecast import add_trips, kept_forecast
from wardline.operators.keyed import duplicate_keys, keyed_first, keyed_rejects
from wardline.operators.lookups import broadcast_if_small, in_any, last_match, lookup_join
from wardline.operators.mapping import majority_vote, sample_per_group
from wardline.plans.city_tables import STEPS, dropoff_steps, pickup_steps, table
from wardline.plans.registry import query
from wardline.session import scratch_path


def _day(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


# ---------------------------------------------------------------- forecast

def zoned_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trips from the supplier's nation to the customer's."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("pickup"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("dropoff"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    order_zones = orders.join(customer, orders.o_custkey == customer.c_custkey).select("o_orderkey", "dropoff")
    return (
        li.join(supplier, li.l_suppkey == supplier.s_suppkey, "left")
        .join(order_zones, li.l_orderkey == order_zones.o_orderkey, "left")
        .select(trip_date(F.col("l_shipdate")).alias("tripdate"), "pickup", "dropoff")
    )


_ZONED = """
    trips AS (
        SELECT CAST(l_shipdate AS DATE) AS d, CAST(s_nationkey AS VARCHAR) AS p, CAST(c_nationkey AS VARCHAR) AS q
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN (SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey) o
          ON l_orderkey = o_orderkey),
    counts AS (
        SELECT d, zip, CAST(sum(n) AS BIGINT) AS trips FROM (
            SELECT d, p AS zip, count(*) AS n FROM trips WHERE p IS NOT NULL GROUP BY d, p
            UNION ALL
            SELECT d, q, count(*) FROM trips WHERE q IS NOT NULL GROUP BY d, q)
        GROUP BY d, zip)
"""

ROLLING_SQL = """
    SELECT strftime(d, '%Y-%m-%d') AS tripdate, {zone} AS {zone}, trips,
           avg(trips) OVER two AS pred_next_day,
           coalesce(CASE WHEN count(trips) OVER seven >= 5 THEN CAST(sum(trips) OVER seven AS DOUBLE) END,
                    avg(trips) OVER two * CAST(0.9 AS DOUBLE) * 7) AS pred_next_week
    FROM counts
    WINDOW two AS (PARTITION BY {zone} ORDER BY d ROWS BETWEEN 1 PRECEDING AND CURRENT ROW),
           seven AS (PARTITION BY {zone} ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
"""


@query("forecast_daily", sql=f"WITH {_ZONED} {ROLLING_SQL.format(zone='zip')}")
def forecast_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily trips per zone, both directions, with the rolling forecast."""
    counts = daily_counts(zoned_trips(spark, sf_dir), "tripdate", "pickup", "dropoff")
    return rolling_forecast(counts).withColumn("tripdate", _day("tripdate"))


@query("forecast_two_loads", sql=f"WITH {_ZONED} {ROLLING_SQL.format(zone='zip')}")
def forecast_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kept up to date over two loads, the second of which brings trips of days that the first has had too."""
    store, trips = scratch_path(spark, "forecast"), zoned_trips(spark, sf_dir)
    second = (F.col("tripdate") >= F.lit("1996-01-01")) | (F.dayofmonth("tripdate") == 13)
    for load, part in (("first", trips.where(~second)), ("second", trips.where(second)), ("second", trips.where(second))):
        add_trips(spark, part, load, store)
    return kept_forecast(spark, store).withColumn("tripdate", _day("tripdate"))


@query(
    "counts_by_direction",
    sql=f"""WITH {_ZONED}
        SELECT strftime(d, '%Y-%m-%d') AS tripdate, p AS zip, 'pickup' AS direction, count(*) AS trips
        FROM trips WHERE p IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT strftime(d, '%Y-%m-%d'), q, 'dropoff', count(*) FROM trips WHERE q IS NOT NULL GROUP BY ALL""",
)
def counts_by_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = zoned_trips(spark, sf_dir)
    frames = [direction_counts(trips, "tripdate", end).withColumn("direction", F.lit(end)) for end in ("pickup", "dropoff")]
    return frames[0].unionByName(frames[1]).withColumn("tripdate", _day("tripdate"))


@query("counts_by_union", sql=f"WITH {_ZONED} SELECT strftime(d, '%Y-%m-%d') AS tripdate, zip, trips FROM counts")
def counts_by_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = zoned_trips(spark, sf_dir)
    total = summed_counts(direction_counts(trips, "tripdate", "pickup"), direction_counts(trips, "tripdate", "dropoff"))
    return total.withColumn("tripdate", _day("tripdate"))


# ---------------------------------------------------------------- numbers

TRIP_STEPS_SQL = """
    CASE WHEN l_returnflag = 'A' THEN -879036 ELSE (l_partkey * 131 + l_linenumber * 17) % 6000 - 880500 END AS plon4,
    CASE WHEN l_returnflag = 'A' THEN 419796 ELSE (l_suppkey * 173 + l_partkey * 7) % 6000 + 415500 END AS plat4,
    (l_orderkey * 59 + l_partkey) % 6000 - 880500 AS dlon4,
    (l_orderkey * 97 + l_suppkey) % 6000 + 415500 AS dlat4
"""


def _degrees(steps: Column) -> Column:
    return steps.cast("double") / F.lit(float(STEPS))


def trip_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    (plon, plat), (dlon, dlat) = pickup_steps(), dropoff_steps()
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        _degrees(plon).alias("plon"),
        _degrees(plat).alias("plat"),
        _degrees(dlon).alias("dlon"),
        _degrees(dlat).alias("dlat"),
    )


_DEGREES = f"""
    steps AS (SELECT l_orderkey, l_linenumber, {TRIP_STEPS_SQL} FROM lineitem),
    degrees AS (
        SELECT l_orderkey, l_linenumber, CAST(plon4 AS DOUBLE) / 10000 AS plon, CAST(plat4 AS DOUBLE) / 10000 AS plat,
               CAST(dlon4 AS DOUBLE) / 10000 AS dlon, CAST(dlat4 AS DOUBLE) / 10000 AS dlat FROM steps)
"""


@query(
    "coord_snap",
    sql=f"""WITH {_DEGREES} SELECT l_orderkey, l_linenumber, round(plon * 1000) / 1000 AS lon,
        round(plat * 1000) / 1000 AS lat FROM degrees""",
)
def coord_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates to the 0.001° grid, ties away from zero."""
    return trip_coordinates(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        snap_half_away(F.col("plon")).alias("lon"),
        snap_half_away(F.col("plat")).alias("lat"),
    )


@query(
    "coord_snap_even",
    sql=f"""WITH {_DEGREES} SELECT l_orderkey, l_linenumber, round_even(plon * 1000, 0) / 1000 AS lon,
        round_even(plat * 1000, 0) / 1000 AS lat FROM degrees""",
)
def coord_snap_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates to the 0.001° grid, ties to the even neighbour."""
    return trip_coordinates(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        snap_half_even(F.col("plon")).alias("lon"),
        snap_half_even(F.col("plat")).alias("lat"),
    )


@query(
    "coord_text",
    sql=f"""WITH {_DEGREES} SELECT l_orderkey, l_linenumber,
        concat(CAST(round_even(dlat * 1000, 0) / 1000 AS VARCHAR), ',',
               CAST(round_even(dlon * 1000, 0) / 1000 AS VARCHAR)) AS coord_key,
        printf('%.6f', dlat) AS lat_text FROM degrees""",
)
def coord_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinate as join key text and with six decimals."""
    return trip_coordinates(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        coordinate_key(snap_half_even(F.col("dlat")), snap_half_even(F.col("dlon"))).alias("coord_key"),
        six_decimals(F.col("dlat")).alias("lat_text"),
    )


@query(
    "case_estimate",
    sql="""SELECT l_orderkey, l_linenumber, l_suppkey, CAST(round(l_discount * l_quantity) AS BIGINT) AS cases
        FROM lineitem""",
)
def case_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        estimated_cases(F.col("l_discount"), F.col("l_quantity")).alias("cases"),
    )


# ---------------------------------------------------------------- casts

_DIRTY = ["", "12.0", " 5 ", "+7", "abc", "99999999999999999999", "-.5e3", "1.0d", "6e", "NaN-"]


def _dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text per event: its JSON value, or one of the malformed ones in every second row."""
    variant = F.element_at(F.array(*[F.lit(t) for t in _DIRTY]), (F.col("event_id") / 2 % len(_DIRTY) + 1).cast("int"))
    events = table(spark, sf_dir, "events")
    value = F.get_json_object("props", "$.k")
    return events.select("event_id", "ts", F.when(F.col("event_id") % 2 == 0, variant).otherwise(value).alias("t"))


_DIRTY_SQL = f"""
    dirty AS (
        SELECT event_id, ts, CASE WHEN event_id % 2 = 0
            THEN list_extract([{", ".join(f"'{t}'" for t in _DIRTY)}], CAST(event_id // 2 % {len(_DIRTY)} + 1 AS INTEGER))
            ELSE json_extract_string(props, '$.k') END AS t FROM events),
    parsed AS (
        SELECT *, regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') AS is_double,
               regexp_full_match(t, '[+-]?[0-9]+') AS is_long FROM dirty)
"""


@query(
    "lenient_casts",
    sql=f"""WITH {_DIRTY_SQL}
        SELECT event_id, CASE WHEN is_double THEN CAST(t AS DOUBLE) ELSE 0 END AS as_double,
        CASE WHEN is_long THEN coalesce(try_cast(t AS BIGINT), 9223372036854775807) ELSE 0 END AS as_long FROM parsed""",
)
def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty_events(spark, sf_dir).select(
        "event_id", lenient_double(F.col("t")).alias("as_double"), lenient_long(F.col("t")).alias("as_long")
    )


@query(
    "cast_audit",
    sql=f"""WITH {_DIRTY_SQL}
        SELECT 'as_double' AS column_name, count(*) AS rows_in, count(*) FILTER (NOT is_double) AS defaulted FROM parsed
        UNION ALL SELECT 'as_long', count(*), count(*) FILTER (NOT is_long) FROM parsed""",
)
def cast_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_audit(
        _dirty_events(spark, sf_dir), {"as_double": double_or_null(F.col("t")), "as_long": long_or_null(F.col("t"))}
    )


@query(
    "lenient_timestamps",
    sql="""SELECT event_id, CASE WHEN event_id % 5 >= 3
            THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') || '.' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0')
            ELSE '0001-01-01 00:00:00.000' END AS moment FROM events""",
)
def lenient_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank, cut off and misspelt moments fall back to year 1."""
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_id") % 5
    written = (
        F.when(kind == 0, F.lit(""))
        .when(kind == 1, second)
        .when(kind == 2, F.concat(second, F.lit(".5")))
        .otherwise(F.concat(second, F.lit("."), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0")))
    )
    moments = table(spark, sf_dir, "events").select("event_id", lenient_timestamp(written).alias("m"))
    return moments.select("event_id", F.date_format("m", "yyyy-MM-dd HH:mm:ss.SSS").alias("moment"))


@query(
    "timestamp_audit",
    sql="""SELECT 'moment' AS column_name, count(*) AS rows_in, count(*) FILTER (event_id % 4 = 0) AS defaulted FROM events""",
)
def timestamp_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.when(F.col("event_id") % 4 == 0, F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    return cast_audit(table(spark, sf_dir, "events"), {"moment": timestamp_or_null(written)})


@query(
    "strict_stats",
    sql="""SELECT CAST(s_suppkey AS INTEGER) AS area, s_name AS area_name, CAST(s_suppkey AS DOUBLE) + 0.5 AS poverty,
        CAST(s_nationkey AS INTEGER) AS income FROM supplier""",
)
def strict_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns under strict casts: any malformed value would fail the query."""
    texts = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("a"),
        "s_name",
        F.concat(F.col("s_suppkey").cast("string"), F.lit(".5")).alias("p"),
        F.col("s_nationkey").cast("string").alias("i"),
    )
    return texts.select(
        strict(F.col("a"), "int").alias("area"),
        F.col("s_name").alias("area_name"),
        strict(F.col("p"), "double").alias("poverty"),
        strict(F.col("i"), "int").alias("income"),
    )


@query(
    "weekday_date",
    sql="""SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, CAST(isodow(ts) - 1 AS INTEGER) AS weekday
        FROM events""",
)
def weekday_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", _day(trip_date(F.col("ts"))).alias("day"), monday_based_weekday(F.col("ts")).alias("weekday")
    )


@query("json_props", sql="SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text into a declared struct, tolerant of records that do not fit."""
    decoded = F.from_json("props", "k STRING", {"mode": "PERMISSIVE"})
    return table(spark, sf_dir, "events").select("event_id", "event_type", decoded["k"].alias("k"))


@query(
    "json_encode",
    sql="""SELECT p_partkey, '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || '}' AS record
        FROM part""",
)
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.to_json(F.struct("p_partkey", "p_name", "p_size")).alias("record")
    )


# ---------------------------------------------------------------- keys and checks

LINE_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


@query(
    "keyed_first",
    sql="""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate,
            l_linenumber) AS rn FROM lineitem) WHERE rn = 1""",
)
def keyed_first_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line item of every order."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    return keyed_first(li, ["l_orderkey"], [*LINE_ORDER, "l_linenumber"]).drop("l_shipdate")


@query(
    "keyed_rejects",
    sql="""SELECT event_id, user_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn > 1""",
)
def keyed_rejects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events a keyed load on (user, type) would turn away."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return keyed_rejects(events, ["user_id", "event_type"], "event_id")


@query(
    "duplicate_keys",
    sql="SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "constraint_split",
    sql="""SELECT o_orderkey, o_orderpriority,
        CASE WHEN length(o_orderpriority) > 8 THEN 'priority longer than 8'
             WHEN o_totalprice * 10000 > 2147483647 THEN 'price does not fit 32 bits' ELSE '' END AS reject_reason FROM orders""",
)
def constraint_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    flagged = flag_rejects(
        orders,
        {
            "priority longer than 8": F.length("o_orderpriority") <= 8,
            "price does not fit 32 bits": F.col("o_totalprice") * 10000 <= 2147483647,
        },
    )
    return flagged.drop("o_totalprice").withColumn(REASON, F.coalesce(REASON, F.lit("")))


_AUDITED = {
    "lineitem": (["l_orderkey", "l_linenumber"], ["l_returnflag"]),
    "orders": (["o_orderkey"], ["o_orderpriority"]),
    "customer": (["c_nationkey"], ["c_name"]),
    "part": (["p_brand"], ["p_name"]),
    "supplier": (["s_suppkey"], ["s_name"]),
    "events": (["user_id"], ["props"]),
    "documents": (["source"], ["text"]),
}


def _audit_sql(name: str, key: list[str], required: list[str]) -> str:
    keys = ", ".join(key)
    blanks = " + ".join(f"count(*) FILTER (coalesce(CAST({c} AS VARCHAR), '') = '')" for c in required)
    return f"""SELECT '{name}' AS table_name, count(*) AS rows_in, (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {name}))
        AS distinct_keys, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {name})) AS duplicate_rows,
        {blanks} AS blank_values FROM {name}"""


@query("load_audit", sql=" UNION ALL ".join(_audit_sql(n, k, r) for n, (k, r) in _AUDITED.items()))
def load_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    audits = [load_audit(table(spark, sf_dir, n), n, k, r) for n, (k, r) in _AUDITED.items()]
    total = audits[0]
    for audit in audits[1:]:
        total = total.unionByName(audit)
    return total


@query(
    "row_index",
    sql="""SELECT row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS row_index, o_orderkey, o_orderpriority
        FROM orders""",
)
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return with_row_index(orders, ["o_orderpriority", "o_orderkey"], "row_index")


@query(
    "row_index_loads",
    sql="""SELECT row_number() OVER (ORDER BY o_orderstatus <> 'F', o_orderpriority, o_orderkey) - 1 AS row_index, o_orderkey, o_orderpriority
        FROM orders""",
)
def row_index_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers over two loads, the second of them taken in twice: those of the first stay as they are."""
    orders, store = table(spark, sf_dir, "orders"), scratch_path(spark, "numbers")
    early = F.col("o_orderstatus") == "F"
    for load, rows in (("first", orders.where(early)), ("second", orders.where(~early)), ("second", orders.where(~early))):
        number_load(spark, rows.select("o_orderkey", "o_orderpriority"), ["o_orderpriority", "o_orderkey"], load, store, "row_index")
    return numbered_rows(spark, store)


# ---------------------------------------------------------------- filters

@query("category_filter", sql="SELECT p_partkey, p_type FROM part WHERE p_type = 'ECONOMY'")
def category_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equals(table(spark, sf_dir, "part"), "p_type", "ECONOMY").select("p_partkey", "p_type")


@query(
    "income_filter",
    sql="SELECT c_custkey, CAST(c_custkey * 7 % 60000 AS INTEGER) AS income FROM customer WHERE c_custkey * 7 % 60000 < 30000",
)
def income_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    income = (F.col("c_custkey") * 7 % 60000).cast("string")
    texts = table(spark, sf_dir, "customer").select("c_custkey", income.alias("income"))
    return below(texts, "income", 30000).select("c_custkey", strict(F.col("income"), "int").alias("income"))


_BLANKED_SQL = """
    blanked AS (SELECT doc_id, CASE WHEN n_chars % 7 = 0 THEN '' ELSE lang END AS lang,
                       CASE WHEN n_chars % 11 = 0 THEN NULL ELSE source END AS source FROM documents)
"""


def _blanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("n_chars") % 7 == 0, F.lit("")).otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("n_chars") % 11 != 0, F.col("source")).alias("source"),
    )


@query(
    "blank_filter",
    sql=f"""WITH {_BLANKED_SQL} SELECT doc_id, lang, source FROM blanked
        WHERE NOT (coalesce(lang, '') = '' OR coalesce(source, '') = '')""",
)
def blank_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_blank(_blanked(spark, sf_dir), "lang", "source")


@query(
    "either_side",
    sql="""SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), '') AS priority, coalesce(c_mktsegment, '') AS segment
        FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o_custkey = c_custkey
        WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL OR c_mktsegment IS NOT NULL""",
)
def either_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    )
    customer = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") != "BUILDING")
        .select("c_custkey", F.col("c_mktsegment").alias("segment"))
    )
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    return either_present(joined, "priority", "segment").select(
        "o_orderkey",
        F.coalesce("priority", F.lit("")).alias("priority"),
        F.coalesce("segment", F.lit("")).alias("segment"),
    )


@query("dashless", sql="SELECT o_orderkey, replace(o_orderpriority, '-', '') AS priority FROM orders")
def dashless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", without_dashes(F.col("o_orderpriority")).alias("priority"))


# ---------------------------------------------------------------- top-k, samples, votes

@query(
    "topk",
    sql="""SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
)
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 most expensive orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100).drop("o_totalprice")


@query(
    "sample_vertices",
    sql="""SELECT event_type, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5(concat_ws('|', event_id, '42')), event_id) AS rn
        FROM events) WHERE rn <= 20""",
)
def sample_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty seeded random events per type."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    return sample_per_group(events, ["event_type"], ["event_id"])


@query(
    "majority_vote",
    sql="""SELECT user_id, event_type, votes FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, event_type) AS rn FROM (
            SELECT user_id, event_type, count(*) AS votes FROM events GROUP BY ALL)) WHERE rn = 1""",
)
def majority_vote_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent event type of each user."""
    return majority_vote(table(spark, sf_dir, "events"), ["user_id"], "event_type")


# ---------------------------------------------------------------- lookups

@query(
    "ccvi_enrich",
    sql="""WITH zoned AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
            WHERE r_name IN ('ASIA', 'EUROPE', 'AFRICA')),
        scores AS (SELECT s_nationkey, max_by(s_acctbal, s_suppkey) AS score, max_by(s_name, s_suppkey) AS category
            FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM zoned) GROUP BY ALL)
        SELECT c_custkey, coalesce(score, 0) AS score, coalesce(category, '') AS category, coalesce(n_name, '') AS area
        FROM customer LEFT JOIN scores ON c_nationkey = s_nationkey LEFT JOIN zoned ON c_nationkey = n_nationkey""",
)
def ccvi_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dimension lookups with defaults; the last record of a zone wins."""
    region = equals_any(table(spark, sf_dir, "region"), "r_name", ["ASIA", "EUROPE", "AFRICA"])
    nation = table(spark, sf_dir, "nation")
    zoned = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name")
    records = in_any(table(spark, sf_dir, "supplier"), "s_nationkey", zoned, "n_nationkey").select(
        "s_nationkey", "s_suppkey", "s_acctbal", "s_name"
    )
    scores = broadcast_if_small(last_match(records, "s_nationkey", F.col("s_suppkey")))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    scored = lookup_join(
        customer, scores, "c_nationkey", "s_nationkey", {"score": ("s_acctbal", 0.0), "category": ("s_name", "")}
    )
    named = lookup_join(scored, broadcast_if_small(zoned), "c_nationkey", "n_nationkey", {"area": ("n_name", "")})
    return named.drop("c_nationkey")


def equals_any(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.filter(F.col(column).isin(values))


@query(
    "qualified_permits",
    sql="""SELECT p_partkey, p_type FROM part WHERE p_type = 'ECONOMY' AND p_partkey % 25 IN (
        SELECT s_nationkey FROM supplier WHERE s_suppkey * 7 % 100 < 30)""",
)
def qualified_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permits of one category whose zone occurs among the qualifying ones, each once."""
    qualifying = table(spark, sf_dir, "supplier").filter(F.col("s_suppkey") * 7 % 100 < 30)
    permits = equals(table(spark, sf_dir, "part"), "p_type", "ECONOMY").select(
        "p_partkey", "p_type", (F.col("p_partkey") % 25).cast("int").alias("zone")
    )
    return in_any(permits, "zone", qualifying, "s_nationkey").drop("zone")
