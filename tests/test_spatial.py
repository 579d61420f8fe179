import math
import random

import pytest
from pyspark.sql import functions as F

from wardline.operators.spatial import assemble_rings, build_zone_index, locate, ring_edges, ring_vertices
from wardline.plans.city_tables import SOUTH, STEPS, WEST
from wardline.plans.lake_queries import _ARROW, slanted_outlines, slanted_zones
from wardline.sources.schemas import MULTIPOLYGON
from pyspark.sql import types as T

SHAPES = T.StructType([T.StructField("zone", T.StringType()), T.StructField("the_geom", MULTIPOLYGON)])


def shapes(spark, polygons):
    return spark.createDataFrame([(name, ("MultiPolygon", coordinates)) for name, coordinates in polygons.items()], SHAPES)


def star(cx, cy, radius, corners, seed):
    rng = random.Random(seed)
    ring = []
    for i in range(corners):
        angle, r = 2 * math.pi * i / corners, radius * rng.uniform(0.3, 1.0)
        ring.append([cx + r * math.cos(angle), cy + r * math.sin(angle)])
    return [*ring, ring[0]]


def inside(ring, x, y):
    """Reference answer: crossings of the ray to the right, one edge at a time."""
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if y1 == y2:
            continue
        (lx, ly), (hx, hy) = ((x1, y1), (x2, y2)) if y1 < y2 else ((x2, y2), (x1, y1))
        if ly <= y < hy and x < lx + (y - ly) * (hx - lx) / (hy - ly):
            odd = not odd
    return odd


def answers(spark, index, points):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    return [r["zone"] for r in locate(df, index, {"zone": ("x", "y")}).orderBy("i").collect()]


@pytest.mark.parametrize("limit", [10**9, 0], ids=["in place", "shuffled"])
def test_against_brute_force(spark, limit):
    """Overlapping stars with many corners; the smallest name wins."""
    stars = {f"z{i:02d}": star(i % 4 * 1.5, i // 4 * 1.5, 1.4, 7 + 9 * i, i) for i in range(12)}
    index = build_zone_index(ring_vertices(shapes(spark, {k: [[v]] for k, v in stars.items()})), "zone", None, limit)
    assert (index.directory is None) == (limit == 0)
    rng = random.Random(1)
    points = [(rng.uniform(-2, 7), rng.uniform(-2, 5)) for _ in range(600)]
    points += [tuple(p) for ring in stars.values() for p in ring[:5]]
    expected = [next((n for n in sorted(stars) if inside(stars[n], x, y)), None) for x, y in points]
    assert answers(spark, index, points) == expected
    assert 100 < sum(e is not None for e in expected) < 600


@pytest.mark.parametrize("limit", [10**9, 0], ids=["in place", "shuffled"])
@pytest.mark.parametrize("cell", [(0.1, 0.3), (0.7, 0.05), (100.0, 100.0)])
def test_cell_size_does_not_matter(spark, limit, cell):
    ring = star(0.0, 0.0, 3.0, 40, 5)
    index = build_zone_index(ring_vertices(shapes(spark, {"a": [[ring]]})), "zone", cell, limit)
    rng = random.Random(2)
    points = [(rng.uniform(-4, 4), rng.uniform(-4, 4)) for _ in range(300)]
    assert answers(spark, index, points) == ["a" if inside(ring, x, y) else None for x, y in points]


def test_shared_borders_have_one_owner(spark):
    sq = lambda x, y: [[[[x, y], [x + 8, y], [x + 8, y + 8], [x, y + 8], [x, y]]]]
    index = build_zone_index(ring_vertices(shapes(spark, {"w": sq(0.0, 0.0), "e": sq(8.0, 0.0), "n": sq(0.0, 8.0)})), "zone")
    got = answers(spark, index, [(8.0, 4.0), (4.0, 8.0), (0.0, 0.0), (16.0, 4.0), (4.0, 16.0), (8.0, 8.0)])
    assert got == ["e", "n", "w", None, None, None]


@pytest.mark.parametrize("limit", [10**9, 0], ids=["in place", "shuffled"])
def test_unusable_points_have_no_zone(spark, limit):
    ring = [[-5.0, -5.0], [5.0, -5.0], [5.0, 5.0], [-5.0, 5.0], [-5.0, -5.0]]
    index = build_zone_index(ring_vertices(shapes(spark, {"a": [[ring]]})), "zone", (1.0, 1.0), limit)
    points = [(None, 1.0), (1.0, None), (float("nan"), 0.0), (0.0, float("inf")), (1e300, 0.0), (0.0, 0.0)]
    assert answers(spark, index, points) == [None] * 5 + ["a"]


def test_holes_and_islands(spark):
    outer = [[0.0, 0.0], [9.0, 0.0], [9.0, 9.0], [0.0, 9.0], [0.0, 0.0]]
    hole = [[3.0, 3.0], [3.0, 6.0], [6.0, 6.0], [6.0, 3.0], [3.0, 3.0]]
    island = [[20.0, 0.0], [21.0, 0.0], [21.0, 1.0], [20.0, 1.0], [20.0, 0.0]]
    df = shapes(spark, {"a": [[outer, hole], [island]]})
    points = [(1.0, 1.0), (4.0, 4.0), (20.5, 0.5)]
    assert answers(spark, build_zone_index(ring_vertices(df), "zone"), points) == ["a", "a", None]
    assert answers(spark, build_zone_index(ring_vertices(df, all_rings=True), "zone"), points) == ["a", None, "a"]


@pytest.mark.parametrize("limit", [10**9, 0], ids=["in place", "shuffled"])
def test_two_outlines_of_one_zone(spark, limit):
    """Two records with the same zip: apart from each other, and over each other."""
    sq = lambda x: [[[[x, 0.0], [x + 2, 0.0], [x + 2, 2.0], [x, 2.0], [x, 0.0]]]]
    records = [("a", 1, sq(0.0)), ("a", 2, sq(10.0)), ("a", 3, sq(1.0)), ("b", 4, sq(11.0))]
    schema = T.StructType([SHAPES["zone"], T.StructField("ingest_seq", T.IntegerType()), SHAPES["the_geom"]])
    df = spark.createDataFrame([(z, i, ("MultiPolygon", c)) for z, i, c in records], schema)
    index = build_zone_index(ring_vertices(df), "zone", None, limit)
    got = answers(spark, index, [(0.5, 1.0), (1.5, 1.0), (2.5, 1.0), (10.5, 1.0), (11.5, 1.0), (12.5, 1.0), (3.5, 1.0)])
    assert got == ["a", "a", "a", "a", "a", "b", None]


def test_rings_there_and_back(spark):
    ring = star(0.0, 0.0, 1.0, 25, 3)
    vertices = ring_vertices(shapes(spark, {"a": [[ring]], "none": None}))
    assert vertices.count() == 26
    back = assemble_rings(vertices, "zone").first()["points"]
    assert [[p["x"], p["y"]] for p in back] == ring
    assert ring_edges(vertices, "zone").count() == 25


def test_empty_index(spark):
    index = build_zone_index(ring_vertices(shapes(spark, {"a": None})), "zone")
    assert answers(spark, index, [(0.0, 0.0)]) == [None]


def test_plan_has_no_pairwise_join_and_no_python(spark):
    ring = star(0.0, 0.0, 1.0, 9, 3)
    points = spark.range(1000).select((F.col("id") / 500).alias("x"), (F.col("id") / 900).alias("y"))
    for limit in (10**9, 0):
        index = build_zone_index(ring_vertices(shapes(spark, {"a": [[ring]]})), "zone", (0.5, 0.5), limit)
        plan = locate(points, index, {"zone": ("x", "y")})._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
            assert word not in plan
        if limit:
            assert "Exchange hashpartitioning" not in plan


def test_pieces_grow_with_vertices_whatever_the_sizes(spark):
    """One outline 10,000 times as large as the others, with few and with many corners."""
    small = {f"s{i:03d}": [[star(i % 20 * 0.01, i // 20 * 0.01, 0.004, 12, i)]] for i in range(200)}
    for corners in (5, 400):
        df = shapes(spark, {**small, "z": [[star(0.0, 0.0, 40.0, corners, 9)]]})
        index = build_zone_index(ring_vertices(df), "zone")
        vertices = 200 * 13 + corners + 1
        assert index.pieces.count() < 40 * vertices
        assert len(index.levels) <= 4
        limited = build_zone_index(ring_vertices(df), "zone", None, 0)
        rng = random.Random(4)
        points = [(rng.uniform(-0.01, 0.2), rng.uniform(-0.01, 0.1)) for _ in range(200)]
        points += [(rng.uniform(-40, 40), rng.uniform(-40, 40)) for _ in range(200)]
        rings = {k: v[0][0] for k, v in small.items()} | {"z": star(0.0, 0.0, 40.0, corners, 9)}
        expected = [next((n for n in sorted(rings) if inside(rings[n], x, y)), None) for x, y in points]
        assert answers(spark, index, points) == answers(spark, limited, points) == expected


@pytest.mark.parametrize("limit", [10**9, 0], ids=["in place", "shuffled"])
def test_open_rings_are_closed(spark, limit):
    closed = star(0.0, 0.0, 3.0, 9, 5)
    for ring in (closed, closed[:-1]):
        index = build_zone_index(ring_vertices(shapes(spark, {"a": [[ring]]})), "zone", None, limit)
        rng = random.Random(6)
        points = [(rng.uniform(-3, 3), rng.uniform(-3, 3)) for _ in range(200)]
        assert answers(spark, index, points) == ["a" if inside(closed, x, y) else None for x, y in points]


def test_slanted_zones_of_every_supplier(spark, tmp_path):
    """Against every outline, one edge at a time, also of suppliers beyond the first hundred."""
    suppliers, rows = range(120), [(n, 1 + n % 7, n * 31 % 997, n * 17 % 211, "N") for n in range(4000)]
    spark.createDataFrame([(k,) for k in suppliers], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    lines = "l_orderkey long, l_linenumber long, l_suppkey long, l_partkey long, l_returnflag string"
    spark.createDataFrame(rows, lines).write.parquet(str(tmp_path / "lineitem.parquet"))

    def holds(k, x, y):
        grow = 4 if k % 3 == 0 else 1
        west, south = WEST + k % 10 * 500, SOUTH + k // 10 * 500
        ring = [((west + dx * grow) / STEPS, (south + dy * grow) / STEPS) for dx, dy in _ARROW]
        odd = False
        for a, b in zip(ring, [*ring[1:], ring[0]]):
            (lx, ly), (hx, hy) = (a, b) if a[1] < b[1] else (b, a)
            if ly <= y < hy and x < max(min(lx, hx), min(lx + (y - ly) * (hx - lx) / (hy - ly), max(lx, hx))):
                odd = not odd
        return odd

    expected = {}
    for order, line, supplier, part, _ in rows:
        x, y = ((order * 59 + part) % 6000 - 880500) / STEPS, ((order * 97 + supplier) % 6000 + 415500) / STEPS
        expected[(order, line, supplier)] = next((f"{k:04d}" for k in suppliers if holds(k, x, y)), "")
    got = {(r["l_orderkey"], r["l_linenumber"], r["l_suppkey"]): r["zone"] for r in slanted_zones(spark, str(tmp_path)).collect()}
    assert got == expected
    assert sum(zone >= "0100" for zone in expected.values()) > 20


def test_no_two_suppliers_share_a_slanted_zone(spark):
    keys = spark.createDataFrame([(k,) for k in (7, 999, 1000, 9999, 10000, 100001)], "s_suppkey long")
    names = [r["zone"] for r in slanted_outlines(keys).collect()]
    assert sorted(names) == sorted(["0007", "0999", "1000", "9999", "10000", "100001"])


def test_of_a_large_index_the_probed_cells_are_sent_out(spark):
    """400 outlines are beyond the limit, those that hold points are not: no point is shuffled to its cell."""
    rings = {f"s{i:03d}": star(i % 20 * 1.0, i // 20 * 1.0, 0.4, 12, i) for i in range(400)}
    index = build_zone_index(ring_vertices(shapes(spark, {k: [[r]] for k, r in rings.items()})), "zone", None, 20_000)
    assert index.directory is None
    rng = random.Random(8)
    points = [(rng.uniform(-0.5, 1.5), rng.uniform(-0.5, 1.5)) for _ in range(300)]
    df = spark.createDataFrame(points, "x double, y double")
    plan = locate(df, index, {"zone": ("x", "y")})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    expected = [next((n for n in sorted(rings) if inside(rings[n], x, y)), None) for x, y in points]
    assert answers(spark, index, points) == expected and len(set(expected)) > 3


def test_columns_nobody_asks_for_are_not_shuffled(spark, monkeypatch):
    """Both ends are joined back by hash, and rows without a point keep their place."""
    import wardline.operators.spatial as spatial

    monkeypatch.setattr(spatial, "BROADCAST_LIMIT_BYTES", -1)
    monkeypatch.setattr(spatial, "measured_bytes", lambda df: 0)
    rows = [(str(n), "unused", float(n % 5), 1.0, None if n % 3 else 2.0, 1.0) for n in range(30)]
    df = spark.createDataFrame(rows, "id string, wide string, px double, py double, qx double, qy double")
    found = spark.createDataFrame([(2.0, 1.0, "a"), (4.0, 1.0, "b")], "lon double, lat double, zone string")
    got = spatial.attach_zones(df, found, {"p": ("px", "py"), "q": ("qx", "qy")}).select("id", "p", "q")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and "wide" not in "".join(line for line in plan.splitlines() if "ShuffledHashJoin" in line)
    zone = {2.0: "a", 4.0: "b"}
    assert {r["id"]: (r["p"], r["q"]) for r in got.collect()} == {i: (zone.get(px), zone.get(qx)) for i, _, px, _, qx, _ in rows}
