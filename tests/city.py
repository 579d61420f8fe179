"""Hand-made pages of every feed, small enough to work out the marts by hand.

Zips are squares of one degree side by side: 60601 from longitude 0 to 1, 60602 from
1 to 2, the zip+4 60666-1234 from 2 to 3; 60500 covers the lower right quarter of 60602 again.
"""

import json

from wardline.operators.filters import AIRPORT_PLACES

AIRPORT = AIRPORT_PLACES[0]


def square(west, south, side=1.0, *more):
    ring = [[west, south], [west + side, south], [west + side, south + side], [west, south + side], [west, south]]
    return {"type": "MultiPolygon", "coordinates": [[ring], *more]}


def trip(trip_id, pickup, dropoff, start="2023-01-02T10:00:00.000", **more):
    record = {
        "trip_id": trip_id,
        "taxi_id": "x" + trip_id,
        "trip_start_timestamp": start,
        "trip_end_timestamp": "2023-01-02T11:00:00.000",
        "trip_seconds": "600",
        "trip_miles": "2.5",
        "trip_total": "11.25",
        "pickup_community_area": "1",
        # A point object the schema leaves out.
        "pickup_centroid_location": {"type": "Point", "coordinates": [1, 2]},
    }
    for end, point in (("pickup", pickup), ("dropoff", dropoff)):
        if point is not None:
            record[f"{end}_centroid_longitude"], record[f"{end}_centroid_latitude"] = point
    return {**record, **more}


PAGES = {
    "taxi_trips": [
        [
            trip("t1", ("0.5", "0.5"), ("1.25", "0.5")),
            trip("t2", ("1.75", "0.25"), ("2.5", "0.5"), start="bad", trip_miles=""),
            trip("t3", ("9.0", "9.0"), ("0.0", "0.0"), pickup_community_area=""),
            trip("t4", None, ("0.25", "0.25"), dropoff_community_area="7"),
            trip("t5", ("0.5", "0.5"), ("0.5", "0.5"), trip_seconds=""),
        ],
        [trip("t1", ("2.5", "0.5"), ("2.5", "0.5")), trip("t6", ("0.9995", "0.5"), ("0.5", "0.5"))],
    ],
    "building_permits": [
        [
            {"id": "007", "permit_": "100", "permit_type": "PERMIT - NEW CONSTRUCTION", "contact_1_zipcode": "60601-0001",
             "latitude": "0.5", "longitude": "0.5", "ware": "12"},
            {"id": "7", "permit_": "101", "permit_type": "PERMIT - SIGNS", "community_area": "2", "ward": "13"},
            {"id": "8", "permit_": "12.0", "permit_type": "PERMIT - NEW CONSTRUCTION", "latitude": "0.5", "longitude": "1.25"},
            {"id": "9", "permit_": "99999999999", "permit_type": "PERMIT - NEW CONSTRUCTION", "contact_1_zipcode": "0",
             "latitude": "0.5", "longitude": "0.25"},
            {"id": "10", "permit_": " 5 ", "permit_type": "PERMIT - NEW CONSTRUCTION", "latitude": "50", "longitude": "50"},
        ]
    ],
    "daily_covid_cases": [
        [
            {"lab_report_date": "2020-03-01T00:00:00.000", "cases_total": "5", "cases_unkown_race_eth": "2"},
            {"lab_report_date": "2020-03-01T00:00:00.000", "cases_total": 6, "cases_unknown_race_eth": "3",
             "deaths_80_yrs": "1"},
        ]
    ],
    "weekly_covid_by_zip": [
        [
            {"row_id": "a", "zip_code": "60601", "week_start": "2020-03-01T00:00:00.000", "week_end": "2020-03-07",
             "tests_weekly": "25", "percent_tested_positive_weekly": "0.1", "population": "1000",
             "zip_code_location": {"type": "Point", "coordinates": [-87.5, 41.5]}},
            {"row_id": "b", "zip_code": "60602", "tests_weekly": "12.0", "percent_tested_positive_weekly": "abc",
             "population": "99999999999"},
        ]
    ],
    "covid_vulnerability": [
        [
            {"geography_type": "ZIP", "community_area_or_zip": "60601", "ccvi_score": "10.5", "ccvi_category": "LOW",
             "location": {"type": "Point", "coordinates": ["-87.5", "41.5"]}},
            {"geography_type": "CA", "community_area_or_zip": "60602", "ccvi_score": "99", "ccvi_category": "HIGH"},
        ],
        [{"geography_type": "ZIP", "community_area_or_zip": "60601", "ccvi_score": "55.5", "ccvi_category": "HIGH",
          "location": {"type": "Point", "coordinates": []}}],
    ],
    "community_health": [
        [
            {"community_area": "1", "community_area_name": "Low", "below_poverty_level": "10.5",
             "per_capita_income": "20000", "unemployment": "3.5"},
            {"community_area": "2", "community_area_name": "Limit", "below_poverty_level": "9",
             "per_capita_income": "30000", "unemployment": "2"},
            {"community_area": "1", "community_area_name": "Low again", "below_poverty_level": "1",
             "per_capita_income": "1", "unemployment": "1"},
        ]
    ],
    "community_boundaries": [
        [
            {"the_geom": square(0.25, 0.25, 0.5), "area_numbe": "1", "community": "LOW", "shape_area": "4"},
            {"the_geom": square(1.1, 0.1, 0.3), "area_numbe": "2", "community": "LIMIT"},
            # One corner in each of two zips, the first and closing one outside.
            {"the_geom": {"type": "MultiPolygon", "coordinates": [[[[-1, 0.5], [0.5, 0.25], [1.25, 0.25], [-1, 0.5]]]]},
             "area_numbe": "3", "community": "TIE"},
        ]
    ],
    "neighborhoods": [
        [
            {"the_geom": square(0.1, 0.1, 0.2), "pri_neigh": "Alpha", "sec_neigh": "S"},
            {"the_geom": square(0.6, 0.6, 0.2), "pri_neigh": "Beta", "sec_neigh": "S"},
            {"the_geom": square(2.1, 0.1, 0.2), "pri_neigh": "Gamma", "sec_neigh": "T"},
        ]
    ],
    "zipcodes": [
        [
            {"the_geom": square(0.0, 0.0), "objectid": "1", "zip": "60601"},
            {"the_geom": square(1.0, 0.0), "objectid": "2", "zip": "60602"},
            {"the_geom": square(2.0, 0.0), "objectid": "3", "zip": "60666-1234"},
            {"the_geom": square(1.5, 0.0, 0.5), "objectid": "4", "zip": "60500"},
        ]
    ],
    "places": [
        [
            {"the_geom": square(0.25, 0.25, 0.5), "place_id": "1", "display_name": AIRPORT},
            {"the_geom": square(1.0, 0.0), "place_id": "2", "display_name": "Union Station"},
        ]
    ],
}


def land(folder, pages=PAGES):
    """Write the pages as JSON arrays, one file per page, numbered in landing order."""
    for table, files in pages.items():
        (folder / table).mkdir(parents=True)
        for number, records in enumerate(files):
            (folder / table / f"page-{number:03d}.json").write_text(json.dumps(records, indent=1))
    return str(folder)
