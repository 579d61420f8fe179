import math
import random

import numpy as np
import pytest

from wardline.llm import topk
from wardline.llm.topk import NONE, Regions, arithmetic, bounds, build_tree, exact_top_k, products, walk

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score string, shard string, rank string"


def frame(spark, data):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in data], SCHEMA)


def expected(data, k=20, every=20):
    usable = [
        (n, i, [math.floor(64 * x) for x in v]) for n, (i, v) in enumerate(data)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, v in usable:
        if i is None or i % every:
            continue
        scored = sorted(
            (-min(max(sum(a * b for a, b in zip(v, w)), -(2**63) + 1), 2**63 - 1), j is None, j or 0)
            for m, j, w in usable if m != n and len(w) == len(v)
        )
        out += [(i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def vectors(n, width, seed):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, 1) for _ in range(width)]) for i in range(n)]


CASES = {
    "plain": vectors(700, 8, 1),
    "ties": [(i, [float(i % 3), 1.0]) for i in range(200)],
    "one point": [(i, [0.5, -0.5]) for i in range(400)],
    "few": vectors(5, 4, 2),
    "broken": [(0, None), (20, [1.0, None]), (40, [math.nan, 1.0]), (60, [math.inf, 1.0]), (80, [1.0, 2.0]), (None, [5.0, 5.0])]
    + [(i, [float(i), -1.0]) for i in range(1, 19)] + [(100, [-1.0, 1.0])],
    "lengths": [(0, []), (20, []), (40, [1.0]), (60, [1.0, 2.0]), (1, [3.0]), (2, []), (3, [1.0, 1.0])],
    "repeated": [*vectors(60, 3, 3), *vectors(60, 3, 3)],
    "huge": [(i, [(-1) ** i * 2.0 ** (20 + i % 120), float(i), -(3.5e38 if i % 7 == 0 else 1.0)]) for i in range(90)],
    "huge squares": [(i, [2.0**27 + i, 2.0**28 - i, 1.0 * i]) for i in range(60)],
    "large": [(i, [1e4 * x for x in v]) for i, v in vectors(100, 4, 5)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("shard_rows", [8192, 50])
def test_answers(spark, name, shard_rows):
    got = exact_top_k(frame(spark, CASES[name]), shard_rows=shard_rows).collect()
    assert sorted(map(tuple, got), key=repr) == expected(CASES[name])


def test_empty_table(spark):
    assert exact_top_k(frame(spark, [])).collect() == []


def clusters(count, rows, width=6, seed=9):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 400, (count, width))
    return np.floor(np.repeat(centres, rows, axis=0) + draw.normal(0, 3, (count * rows, width)))


def test_a_tree_is_walked_best_first_and_left_early(monkeypatch):
    points = clusters(16, 100)
    tree = build_tree(np.arange(len(points)), np.arange(len(points)), points, leaf_rows=32)
    seen = []
    score = topk.products
    monkeypatch.setattr(topk, "products", lambda q, p, exact: seen.append(len(p)) or score(q, p, exact))
    for row in range(0, len(points), 97):
        query = points[row]
        bound = bounds(query[None, :], tree.low, tree.high)[0]
        inside = [(bound[n] >= score(query[None, :], tree.points[a:b], float).max()) for n, (a, b) in enumerate(zip(tree.start, tree.stop))]
        assert all(inside)
        seen.clear()
        best = walk(tree, bound, query, row, NONE, 5, arithmetic(query[None, :], points))
        wanted = sorted(((int(s), -n, -n) for n, s in enumerate(points @ query) if n != row), reverse=True)[:5]
        assert [b[:3] for b in best] == wanted
        assert sum(seen) < len(points) / 4
        # With the k-th score of elsewhere, nothing below it is looked at.
        seen.clear()
        assert walk(tree, bound, query, row, int(best[0][0]) + 1, 5, float) == [] and sum(seen) < len(points) / 8


def test_regions_keep_neighbours_together_and_deal_out_copies():
    points = clusters(8, 200)
    regions = Regions(points, 8)
    shards = regions.shard(np.arange(len(points)), points)
    assert sorted(set(shards)) == list(range(8)) and max(np.bincount(shards)) <= 300
    alike = Regions(np.ones((500, 3)), 4)
    assert alike.count == 1 and len(set(alike.shard(np.arange(10_000) * 7, np.ones((10_000, 3))))) == 4
    assert Regions(np.zeros((0, 3)), 4).shard(np.arange(40) << 16, np.ones((40, 3))).max() == 3


def test_queries_are_sent_to_few_shards(spark, monkeypatch):
    data = [(n, [float(x) / 64 for x in p]) for n, p in enumerate(clusters(12, 60).tolist())]
    sent = []
    original = topk._sent_on
    monkeypatch.setattr(topk, "_sent_on", lambda asked, boxes: sent.append((asked, boxes)) or original(asked, boxes))
    got = exact_top_k(frame(spark, data), k=5, shard_rows=60).collect()
    assert sorted(map(tuple, got), key=repr) == expected(data, k=5)
    asked, boxes = sent[0]
    assert original(asked, boxes).count() < asked.count() * (boxes.count() - 1) / 2


def test_products_beyond_64_bits():
    q, p = np.array([[2.0**80, 1.0]]), np.array([[2.0**60, 0.0], [-(2.0**60), 5.0], [0.0, 7.0]])
    assert products(q, p, arithmetic(q, p)).tolist() == [[2**63 - 1, -(2**63) + 1, 7]]
    assert (bounds(q, p, p)[0] >= products(q, p, object)[0]).all()
