import json
import os

import pytest
from pyspark.sql import functions as F

from wardline.operators.keyed import DuplicateKeyError
from wardline.sources.tables import lake_audit, lake_bad_pages, lake_pages, lake_rejects, lake_table, refresh_lake_table
from wardline.sources.versions import current, drop_versions, pointer


def trips(*ids):
    return [{"trip_id": i, "taxi_id": f"taxi {i}"} for i in ids]


def land(folder, **pages):
    os.makedirs(folder, exist_ok=True)
    for name, text in pages.items():
        with open(f"{folder}/{name}", "w") as file:
            file.write(text if isinstance(text, str) else json.dumps(text))
    return str(folder)


def loaded(spark, lake):
    return sorted(r["tripid"] for r in lake_table(spark, lake, "taxi_trips").collect())


def account(spark, lake):
    return lake_audit(spark, lake, ["taxi_trips"]).first().asDict()


def test_pages_that_are_no_json(spark, tmp_path):
    cut = json.dumps(trips(*[f"x{n}" for n in range(50)]))
    pages = land(
        tmp_path / "in", **{
            "good.json": trips("a", "b"), "cut off [1].json": cut[:-30], "text %20.json": "<html>gone</html>", "empty.json": "", "blank.json": "  ",
            "none.json": [], "blank row.json": [{}], "unknown.json": [{"other": 1}], "object.json": trips("c")[0], "again.json": trips("a"),
            "mixed.json": [{}, *trips("d")], "typed.json": [{"trip_id": 7, "taxi_id": {"deep": 1}}],
        },
    )
    lake = str(tmp_path / "lake")
    refresh_lake_table(spark, "taxi_trips", pages, lake)
    assert loaded(spark, lake) == ["", "7", "a", "b", "c", "d"]
    bad = {os.path.basename(r["path"]): r for r in lake_bad_pages(spark, lake, ["taxi_trips"]).collect()}
    reasons = sorted((r["record"][:10], r["reason"], r["bytes"]) for r in bad.values())
    assert reasons == [
        ("  ", "page is empty", 2), ("<html>gone", "page is cut off", 17), (cut[:10], "page is cut off", len(cut) - 30),
    ]
    got = account(spark, lake)
    # Rows: a b, c, a again, d, 7 and three without a field; of these and of a one each stays.
    assert got == {"table_name": "taxi_trips", "rows_in": 12, "rows_kept": 6, "duplicate_rows": 3, "bad_records": 3, "blank_values": 3}
    listed = lake_pages(spark, lake, ["taxi_trips"]).collect()
    # All but the file of no bytes.
    assert len(listed) == 11 and sum(r["rows"] for r in listed) == 9 and sum(r["bad_records"] for r in listed) == 3


def test_lines_that_are_no_json(spark, tmp_path):
    lines = [json.dumps(t) for t in trips("a", "b", "c", "a")]
    pages = land(tmp_path / "in", **{"one.json": "\n".join([lines[0], lines[1][:-4], "", "{}", lines[2]]), "two.json": "\n".join(["garbage", lines[3]])})
    lake = str(tmp_path / "lake")
    refresh_lake_table(spark, "taxi_trips", pages, lake, multiline=False)
    assert loaded(spark, lake) == ["", "a", "c"]
    bad = lake_bad_pages(spark, lake, ["taxi_trips"]).collect()
    assert sorted((r["record"], r["reason"], r["bytes"]) for r in bad) == sorted(
        (t, "line is no JSON", len(t)) for t in (lines[1][:-4], "garbage")
    )
    assert account(spark, lake) == {"table_name": "taxi_trips", "rows_in": 6, "rows_kept": 3, "duplicate_rows": 1, "bad_records": 2, "blank_values": 1}


def test_only_bad_pages_and_none(spark, tmp_path):
    lake = str(tmp_path / "lake")
    refresh_lake_table(spark, "taxi_trips", land(tmp_path / "bad", **{"p.json": "[{"}), lake)
    assert loaded(spark, lake) == [] and account(spark, lake)["bad_records"] == 1
    refresh_lake_table(spark, "taxi_trips", land(tmp_path / "good", **{"p.json": trips("a")}), lake)
    assert loaded(spark, lake) == ["a"] and account(spark, lake)["bad_records"] == 0


def test_a_load_that_fails_leaves_everything_as_it_was(spark, tmp_path):
    lake = str(tmp_path / "lake")
    refresh_lake_table(spark, "taxi_trips", land(tmp_path / "one", **{"p.json": trips("a", "a")}), lake)
    before = (loaded(spark, lake), account(spark, lake), pointer(spark, lake).count())

    class Broken(RuntimeError):
        pass

    import wardline.sources.tables as tables

    def fails_in_a_task(files, parsed, bad):
        return parsed.select(F.raise_error(F.lit("disk full")).alias("path"))

    original = tables.landed_pages
    tables.landed_pages = fails_in_a_task
    try:
        with pytest.raises(Exception, match="disk full"):
            refresh_lake_table(spark, "taxi_trips", land(tmp_path / "two", **{"p.json": trips("b")}), lake)
    finally:
        tables.landed_pages = original
    assert (loaded(spark, lake), account(spark, lake), pointer(spark, lake).count()) == before
    assert lake_rejects(spark, lake, "taxi_trips").count() == 1
    refresh_lake_table(spark, "taxi_trips", land(tmp_path / "two", **{"p.json": trips("b")}), lake)
    assert loaded(spark, lake) == ["b"] and lake_rejects(spark, lake, "taxi_trips").count() == 0


def test_a_write_that_fails_in_a_task_leaves_the_mart(spark, tmp_path):
    from wardline.sources.tables import mart_table, refresh

    path = str(tmp_path / "mart" / "numbers")
    refresh(spark.range(5), "id long", path)
    bad = spark.range(1000).repartition(4).select(F.when(F.col("id") == 700, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        refresh(bad, "id long", path)
    assert mart_table(spark, str(tmp_path / "mart"), "numbers").count() == 5
    # A frame that reads the table may replace it.
    refresh(mart_table(spark, str(tmp_path / "mart"), "numbers").where("id > 2"), "id long", path)
    assert mart_table(spark, str(tmp_path / "mart"), "numbers").count() == 2


def test_old_versions_can_be_dropped(spark, tmp_path):
    from wardline.sources.tables import mart_table, refresh

    mart = str(tmp_path / "mart")
    for n in range(1, 5):
        refresh(spark.range(n), "id long", f"{mart}/numbers")
        refresh(spark.range(10 * n), "id long", f"{mart}/tens")
    assert len(drop_versions(spark, mart, keep=1)) == 6
    assert mart_table(spark, mart, "numbers").count() == 4 and mart_table(spark, mart, "tens").count() == 40
    assert {os.path.isdir(p) for p in current(spark, mart).values()} == {True}
    assert len(os.listdir(f"{mart}/_versions/numbers")) == 1


def test_duplicates_that_are_refused_replace_nothing(spark, tmp_path):
    lake = str(tmp_path / "lake")
    row = {"row_id": "r1", "zip_code": "60601"}
    refresh_lake_table(spark, "weekly_covid_by_zip", land(tmp_path / "one", **{"p.json": [row]}), lake)
    with pytest.raises(DuplicateKeyError):
        refresh_lake_table(spark, "weekly_covid_by_zip", land(tmp_path / "two", **{"p.json": [row, row]}), lake)
    assert lake_table(spark, lake, "weekly_covid_by_zip").count() == 1


def test_names_of_many_broken_pages_stay_off_the_driver(spark, tmp_path, monkeypatch):
    """Nine broken pages where the driver may list two: the same account, and no more names than that collected."""
    import wardline.sources.pages as sources

    monkeypatch.setattr(sources, "FEW_PAGES", 2)
    broken = {f"cut [{n}].json": json.dumps(trips(f"x{n}", f"y{n}"))[:-5] for n in range(9)}
    pages = land(tmp_path / "in", **{"good.json": trips("a", "b"), "none.json": [], "blank.json": [{}], "again.json": trips("a"), **broken})
    frame, seen = type(spark.range(1)), []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda df: seen.append(collect(df)) or seen[-1])
    lake = str(tmp_path / "lake")
    refresh_lake_table(spark, "taxi_trips", pages, lake)
    assert max(map(len, seen), default=0) <= 3
    monkeypatch.undo()
    assert loaded(spark, lake) == ["", "a", "b"]
    bad = lake_bad_pages(spark, lake, ["taxi_trips"]).collect()
    assert sorted((r["reason"], r["bytes"]) for r in bad) == sorted(("page is cut off", len(t)) for t in broken.values())
    assert account(spark, lake)["bad_records"] == 9
    assert lake_pages(spark, lake, ["taxi_trips"]).count() == 13


def test_rows_of_keys_that_come_once_are_not_shuffled(spark, tmp_path):
    from wardline.operators.keyed import keyed_first, keyed_first_of_few

    rows = [(f"k{n}", n, "v") for n in range(50)] + [("k3", 60, "w"), ("k3", -1, "x"), (None, 70, "y"), (None, 71, "z")]
    df = spark.createDataFrame(rows, "key string, seq int, wide string")
    want = sorted(map(str, keyed_first(df, ["key"], ["seq"]).collect()))
    for limit in (10, 0):
        assert sorted(map(str, keyed_first_of_few(df, ["key"], "seq", limit).collect())) == want
    once = spark.createDataFrame([r for r in rows if r[0] and r[1] in range(50)], df.schema)
    plan = keyed_first_of_few(once, ["key"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and keyed_first_of_few(once, ["key"], "seq").count() == 50
