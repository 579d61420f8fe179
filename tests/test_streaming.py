import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.city import PAGES
from wardline.sources.schemas import FEEDS, TAXI_TRIPS, WEEKLY_COVID
from wardline.sources.tables import lake_table, refresh_lake_table
from wardline.sources.key_index import depth_for, filter_bits, index_rows, parts_that_may_hold
from wardline.streaming.refresh import compact_refreshed, files_that_may_hold, known_keys, read_bad_pages, read_refreshed, refresh_stream


def refresh(spark, root, **options):
    refresh_stream(spark, TAXI_TRIPS, str(root / "pages"), str(root / "table"), str(root / "state"), **options).awaitTermination()
    return sorted((r["tripid"], r["dropoffcentroidlongitude"]) for r in read_refreshed(spark, TAXI_TRIPS, str(root / "table")).collect())


def land(root, number):
    folder = root / "pages"
    folder.mkdir(exist_ok=True)
    (folder / f"page-{number}.json").write_text(json.dumps(PAGES["taxi_trips"][number]))


FIRST = [("t1", "1.25"), ("t2", "2.5"), ("t3", "0.0"), ("t4", "0.25"), ("t5", "0.5")]


def test_later_pages_add_new_keys_only(spark, tmp_path):
    land(tmp_path, 0)
    assert refresh(spark, tmp_path) == FIRST
    assert refresh(spark, tmp_path) == FIRST
    land(tmp_path, 1)
    assert refresh(spark, tmp_path) == [*FIRST, ("t6", "0.5")]


def test_one_page_per_batch(spark, tmp_path):
    land(tmp_path, 0)
    land(tmp_path, 1)
    assert len(refresh(spark, tmp_path, files_per_batch=1)) == 6


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """As after a failure between writing a batch and recording it."""
    land(tmp_path, 0)
    refresh(spark, tmp_path)
    land(tmp_path, 1)
    before = refresh(spark, tmp_path)
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    assert refresh(spark, tmp_path) == before


@pytest.mark.parametrize("name", sorted(FEEDS))
def test_every_feed_streams_to_what_a_full_load_gives(spark, tmp_path, name):
    """The pages arrive one by one, the first of them twice under another name where the rule allows it."""
    feed, pages = FEEDS[name], tmp_path / "pages"
    pages.mkdir()
    landed = list(PAGES[name])
    if feed.on_duplicate != "fail":
        landed.append(landed[0])
    for number, records in enumerate(landed):
        (pages / f"page-{number + 1}.json").write_text(json.dumps(records))
        os.utime(pages / f"page-{number + 1}.json", (1000 + number, 1000 + number))
        refresh_stream(spark, feed, str(pages), str(tmp_path / "table"), str(tmp_path / "state")).awaitTermination()
    refresh_lake_table(spark, name, str(pages), str(tmp_path / "lake"))
    rows = [
        sorted((tuple(r) for r in df.drop("ingest_seq").collect()), key=repr)
        for df in (read_refreshed(spark, feed, str(tmp_path / "table")), lake_table(spark, str(tmp_path / "lake"), name))
    ]
    assert rows[0] == rows[1] and rows[0]


def test_a_key_loaded_before_fails_where_duplicates_are_refused(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()

    def land_weekly(number, row_id):
        (pages / f"page-{number}.json").write_text(json.dumps([{"row_id": row_id, "zip_code": "60601"}]))
        refresh_stream(spark, WEEKLY_COVID, str(pages), str(tmp_path / "table"), str(tmp_path / "state")).awaitTermination()

    land_weekly(1, "a")
    land_weekly(2, "b")
    with pytest.raises(StreamingQueryException, match="loaded before"):
        land_weekly(3, "a")
    assert read_refreshed(spark, WEEKLY_COVID, str(tmp_path / "table")).count() == 2


def land_ids(spark, root, number, ids):
    rows = ids.select(F.col("trip").alias("trip_id"), F.concat(F.lit("taxi "), F.col("trip")).alias("taxi_id"), F.lit(str(number)).alias("company"))
    rows.write.json(str(root / "pages" / f"page-{number}"))
    refresh_stream(spark, TAXI_TRIPS, str(root / "pages"), str(root / "table"), str(root / "state"), multiline=False, part_keys=4096).awaitTermination()


def opened(spark, root, ids, number):
    return files_that_may_hold(spark, str(root / "table"), ids.select(F.col("trip").alias("tripid")), ["tripid"], number)


def test_a_batch_of_new_keys_opens_no_old_file(spark, tmp_path):
    """Ids in no order at all, so that only the filters can tell; then ids in order, which their ranges tell."""

    def ids(start, count):
        return spark.range(start, start + count).select(F.sha2(F.col("id").cast("string"), 256).alias("trip"))

    land_ids(spark, tmp_path, 1, ids(0, 60_000))
    land_ids(spark, tmp_path, 2, ids(60_000, 50_000))
    new = ids(200_000, 50_000)
    assert opened(spark, tmp_path, new, 2) == []
    assert known_keys(spark, TAXI_TRIPS, str(tmp_path / "table"), new.select(F.col("trip").alias("tripid")), 2) is None
    some = opened(spark, tmp_path, ids(59_999, 2), 2)
    assert len(some) == 2 and {f.split("ingest_batch=")[1][0] for f in some} == {"0", "1"}
    found = known_keys(spark, TAXI_TRIPS, str(tmp_path / "table"), ids(109_990, 50_000).select(F.col("trip").alias("tripid")), 2)
    assert found.count() == 10 and "ReadSchema: struct<tripid:string>" in found._jdf.queryExecution().toString()
    assert len(os.listdir(tmp_path / "table" / "ingest_batch=0")) - 2 == 16  # and _SUCCESS with its checksum
    land_ids(spark, tmp_path, 3, ids(109_000, 2000))
    companies = read_refreshed(spark, TAXI_TRIPS, str(tmp_path / "table")).groupBy("company").count().collect()
    assert {r["company"]: r["count"] for r in companies} == {"1": 60_000, "2": 50_000, "3": 1000}


def test_ranges_of_keys_spare_the_filters(spark):
    def keys(start, count):
        return spark.range(start, start + count).select(F.format_string("trip-%08d", "id").alias("k"))

    old = index_rows(keys(0, 5000), ["k"], 2, filter_bits(5000, 2)).withColumn("ingest_batch", F.lit(0)).drop("words")
    assert parts_that_may_hold(old.withColumn("words", F.raise_error(F.lit("opened")).cast("array<bigint>")), keys(9000, 5000), ["k"]) == []


def test_parts_grow_with_the_keys():
    assert [depth_for(n, 1 << 16) for n in (0, 1, 1 << 16, (1 << 16) + 1, 1 << 17, (1 << 20) + 1)] == [0, 0, 0, 1, 1, 5]
    assert filter_bits(1 << 16, 0) == 1 << 21 and filter_bits(0, 0) == 1024


def test_pages_that_are_no_json_are_kept_apart(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "page-1.json").write_text(json.dumps([{"trip_id": "a"}, {}]))
    (pages / "page-2.json").write_text(json.dumps([{"trip_id": "b"}, {"trip_id": "c"}])[:-5])
    assert [t for t, _ in refresh(spark, tmp_path)] == ["", "a"]
    (pages / "page-3.json").write_text("oops")
    (pages / "page-4.json").write_text(json.dumps([{"trip_id": "c"}]))
    assert [t for t, _ in refresh(spark, tmp_path)] == ["", "a", "c"]
    bad = read_bad_pages(spark, str(tmp_path / "table")).collect()
    assert sorted((os.path.basename(r["path"]), r["reason"], r["ingest_batch"]) for r in bad) == [
        ("page-2.json", "page is cut off", 0), ("page-3.json", "page is cut off", 1),
    ]


def test_compaction_keeps_rows_and_later_batches_see_them(spark, tmp_path):
    for number in (0, 1):
        land(tmp_path, number)
        before = refresh(spark, tmp_path)
    target = compact_refreshed(spark, TAXI_TRIPS, str(tmp_path / "table"), str(tmp_path / "compact"))
    assert sorted((r["tripid"], r["dropoffcentroidlongitude"]) for r in read_refreshed(spark, TAXI_TRIPS, target).collect()) == before
    (tmp_path / "pages" / "page-9.json").write_text(json.dumps(PAGES["taxi_trips"][1]))
    refresh_stream(spark, TAXI_TRIPS, str(tmp_path / "pages"), target, str(tmp_path / "state")).awaitTermination()
    assert read_refreshed(spark, TAXI_TRIPS, target).count() == len(before)


def test_pages_count_in_landing_order(spark, tmp_path):
    """Ten pages and more: neither names nor their alphabet decide, but the time of landing, then the number."""
    pages = tmp_path / "pages"
    pages.mkdir()
    for number in range(1, 13):
        path = pages / f"page-{number}.json"
        path.write_text(json.dumps([{"trip_id": "t", "company": str(number)}, {"trip_id": f"t{number}", "company": str(number)}]))
        os.utime(path, (5000, 5000))
    os.utime(pages / "page-7.json", (4000, 4000))
    refresh_lake_table(spark, "taxi_trips", str(pages), str(tmp_path / "lake"))
    kept = {r["tripid"]: r["company"] for r in lake_table(spark, str(tmp_path / "lake"), "taxi_trips").collect()}
    assert kept["t"] == "7" and len(kept) == 13
    os.utime(pages / "page-7.json", (5000, 5000))
    refresh_lake_table(spark, "taxi_trips", str(pages), str(tmp_path / "lake"))
    again = {r["tripid"]: r["company"] for r in lake_table(spark, str(tmp_path / "lake"), "taxi_trips").collect()}
    assert again["t"] == "1"
