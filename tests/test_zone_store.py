import random

import pytest

from wardline.operators import zone_store
from wardline.operators.spatial import build_zone_index, locate
from wardline.operators.zone_store import open_zone_index

SCHEMA = "zip string, ingest_seq long, part int, ring int, seq int, longitude double, latitude double"


def square(zone, west, south, side, landed=0, part=0):
    corners = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    return [(zone, landed, part, 0, n, float(west + x * side), float(south + y * side)) for n, (x, y) in enumerate(corners)]


def outlines(spark, *squares):
    return spark.createDataFrame([row for s in squares for row in s], SCHEMA)


def grid(count, side=1.0, landed=0):
    return [square(f"z{n:03d}", n % 10, n // 10, side, landed + n) for n in range(count)]


def points(spark, count=2000, seed=1):
    draw = random.Random(seed)
    return spark.createDataFrame([(n, draw.uniform(-1, 11), draw.uniform(-1, 11)) for n in range(count)], "id int, lon double, lat double")


def zones(df, index):
    return {r["id"]: r["zone"] for r in locate(df, index, {"zone": ("lon", "lat")}).collect()}


def jobs(spark, run):
    spark.sparkContext.setJobGroup("counted", "counted")
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    result = run()
    after = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(after - before)


@pytest.fixture
def cut(monkeypatch):
    """The zones that are cut into cells, one list for each time."""
    seen = []
    original = zone_store.cut_pieces

    def noted(vertices, zone, extents, levels):
        seen.append(sorted(r[0] for r in vertices.select(zone).distinct().collect()))
        return original(vertices, zone, extents, levels)

    monkeypatch.setattr(zone_store, "cut_pieces", noted)
    return seen


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_the_same_outlines_build_nothing(spark, tmp_path, cut, limit):
    store, spots = str(tmp_path / "store"), points(spark)
    first = open_zone_index(spark, outlines(spark, *grid(50)), "zip", store, limit)
    assert (first.directory is None) == (limit == 0)
    wanted = zones(spots, build_zone_index(outlines(spark, *grid(50)), "zip"))
    assert zones(spots, first) == wanted and len(set(wanted.values())) > 40
    index, count = jobs(spark, lambda: open_zone_index(spark, outlines(spark, *grid(50)), "zip", store, limit))
    assert cut == [[f"z{n:03d}" for n in range(50)]] and count <= 4
    assert zones(spots, index) == wanted


def test_landed_again_without_a_change_cuts_nothing(spark, tmp_path, cut):
    store = str(tmp_path / "store")
    open_zone_index(spark, outlines(spark, *grid(20)), "zip", store)
    again = open_zone_index(spark, outlines(spark, *grid(20, landed=500)).repartition(3), "zip", store)
    assert cut[1:] == [[]]
    assert zones(points(spark), again) == zones(points(spark), build_zone_index(outlines(spark, *grid(20)), "zip"))


def test_only_changed_outlines_are_cut(spark, tmp_path, cut):
    store, spots = str(tmp_path / "store"), points(spark, 4000)
    before = grid(60)
    open_zone_index(spark, outlines(spark, *before), "zip", store)
    # One moves, one goes, one grows by a second part, a large one and a tiny one come.
    after = [s for s in before if s[0][0] not in ("z007", "z013", "z020")]
    after += [square("z007", 7.25, 0.25, 1.0), square("z020", 0, 2, 1.0, 20) + square("z020", 9, 9, 0.5, 20, part=1)]
    after += [square("big", -1, -1, 12.0, 900), square("a-tiny", 4.5, 4.5, 0.01, 901)]
    index = open_zone_index(spark, outlines(spark, *after), "zip", store)
    assert cut[1] == ["a-tiny", "big", "z007", "z020"]
    assert zones(spots, index) == zones(spots, build_zone_index(outlines(spark, *after), "zip"))
    inside = spark.createDataFrame([(0, 4.505, 4.505), (1, 9.2, 9.2), (2, 3.5, 1.5), (3, 7.1, 0.1), (4, 7.3, 0.3)], "id int, lon double, lat double")
    # Of zones that hold a point the smallest name wins.
    assert zones(inside, index) == {0: "a-tiny", 1: "big", 2: "big", 3: "big", 4: "big"}
    # And back again.
    back = open_zone_index(spark, outlines(spark, *before), "zip", store)
    assert cut[2] == ["z007", "z013", "z020"]
    assert zones(spots, back) == zones(spots, build_zone_index(outlines(spark, *before), "zip"))


def test_outlines_that_share_a_name_or_a_place(spark, tmp_path):
    store, spots = str(tmp_path / "store"), points(spark)
    twice = [square("a", 0, 0, 3, 1), square("a", 0, 0, 3, 2), square("a", 5, 5, 2, 3), square("b", 0, 0, 3, 4), square("A", 2, 2, 2, 5)]
    index = open_zone_index(spark, outlines(spark, *twice), "zip", store)
    assert zones(spots, index) == zones(spots, build_zone_index(outlines(spark, *twice), "zip"))


def test_no_outlines(spark, tmp_path):
    store = str(tmp_path / "store")
    index = open_zone_index(spark, spark.createDataFrame([], SCHEMA), "zip", store)
    assert set(zones(points(spark, 20), index).values()) == {None}
    index = open_zone_index(spark, outlines(spark, *grid(100)), "zip", store)
    assert len(set(zones(points(spark), index).values())) > 50
