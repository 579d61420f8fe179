import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.cases import DOCS, SPLIT_EARLY, ascii_lower, documents, final_plans, prose, settings, spaced_words
from wardline.llm import graphs, simhash
from wardline.llm.graphs import components
from wardline.llm.simhash import covering_masks, keep_one_of_each, midpoint_links, near_links, simhash_groups


def expected_fingerprint(text):
    words = spaced_words(ascii_lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[n : n + 4]) for n in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def expected_components(points, radius):
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(points, 2):
        if (a ^ b).bit_count() <= radius:
            parent[find(a)] = find(b)
    return {p: find(p) for p in points}


def test_groups(spark):
    got = simhash_groups(documents(spark)).collect()
    prints = {(d, t): expected_fingerprint(t) for d, t, _ in DOCS}
    roots = expected_components(sorted(set(prints.values())), 4)
    least = {}
    for (doc_id, _), p in prints.items():
        if doc_id is not None:
            least[roots[p]] = min(doc_id, least.get(roots[p], doc_id))
    expected = sorted(((d, f"{prints[d, t]:016x}", least.get(roots[prints[d, t]])) for d, t, _ in DOCS), key=repr)
    assert sorted(map(tuple, got), key=repr) == expected


def test_masks_cover_every_pair_within_the_radius():
    masks = [mask & (1 << 64) - 1 for mask in covering_masks(4)]
    assert len(masks) == 31
    draw = random.Random(5)
    for _ in range(20_000):
        flipped = sum(1 << bit for bit in draw.sample(range(64), draw.randint(0, 4)))
        assert any(mask & flipped == 0 for mask in masks)


@pytest.mark.parametrize("bucket", [1024, 8, 1])
def test_links_join_what_steps_join(spark, monkeypatch, bucket):
    """Also where buckets are too large to be compared in one place."""
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket)
    draw = random.Random(7)
    points = set()
    for _ in range(12):
        point = draw.getrandbits(64)
        for _ in range(25):
            point ^= sum(1 << bit for bit in draw.sample(range(64), draw.randint(1, 5)))
            points.add(point)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in points}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fingerprint long")
    roots = {r["node"]: r["root"] for r in components(near_links(frame, 4)).collect()}
    expected = expected_components(sorted(points), 4)
    for a, b in itertools.combinations(points, 2):
        joined = roots.get(signed[a], signed[a]) == roots.get(signed[b], signed[b])
        assert joined == (expected[a] == expected[b])


def test_a_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(n, n + 1) for n in range(300)] + [(1000, 999), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**{n: 0 for n in range(301)}, 999: 999, 1000: 999}


def test_one_of_each_group_stays(spark):
    rows = [*DOCS, *[(20 + n, prose(300, 2) + f" tail{n}", "z") for n in range(6)]]
    kept = [r["doc_id"] for r in keep_one_of_each(documents(spark, rows), ["doc_id", "text"]).collect()]
    groups = {r["component_id"] for r in simhash_groups(documents(spark, rows)).collect()}
    with_id = sorted(k for k in kept if k is not None)
    assert with_id == sorted(g for g in groups if g is not None)
    # The empty row without an id goes to the group of the empty texts; the other has a group of its own.
    assert kept.count(None) == 1


def test_empty_table(spark):
    assert simhash_groups(documents(spark, [])).collect() == []
    assert keep_one_of_each(documents(spark, []), ["doc_id", "text"]).collect() == []


def joined(members, pairs):
    """The sets of members that the pairs join."""
    root = {m: m for m in members}

    def top(m):
        while root[m] != m:
            m = root[m]
        return m

    for a, b in pairs:
        root[top(a)] = top(b)
    groups = {}
    for m in members:
        groups.setdefault(top(m), set()).add(m)
    return sorted(map(sorted, groups.values()))


#: 12 and 13 are one bit apart, and each has a smaller one next to it that the other is two bits from.
BRIDGE = [12, 13, 4, 9]


@pytest.mark.parametrize(("radius", "members"), [(1, BRIDGE), (1, None), (3, None), (2, None)])
def test_midpoints_join_what_steps_join(spark, radius, members):
    members = members or random.Random(radius).sample(range(1 << (9 + 3 * radius)), 150)
    rows = spark.createDataFrame([(m,) for m in members], "fingerprint long")
    links = [(r["a"], r["b"]) for r in midpoint_links(rows, radius).collect()]
    assert all((a ^ b).bit_count() <= radius for a, b in links)
    near = [(a, b) for a in members for b in members if a < b and (a ^ b).bit_count() <= radius]
    assert near and joined(members, links) == joined(members, near)


def test_links_of_a_hot_node_are_split(spark, monkeypatch):
    """A star whose centre has most of all links, and chains."""
    star = spark.range(20_000).select(F.lit(-(2**63)).cast("long").alias("a"), F.xxhash64("id").alias("b"))
    chains = spark.range(10_000, 18_000).select(F.col("id").alias("a"), F.when(F.col("id") % 4 == 0, F.col("id")).otherwise(F.col("id") - 1).alias("b"))
    with settings(spark, SPLIT_EARLY):
        plans = final_plans(monkeypatch, graphs)
        got = {r["node"]: r["root"] for r in graphs.components(star.unionByName(chains).repartition(8)).collect()}
    chained = {n: n - n % 4 for n in range(10_000, 18_000)}
    assert {n: r for n, r in got.items() if n in chained} == chained and len(got) == len(chained) + 20_001
    assert {r for n, r in got.items() if n not in chained} == {-(2**63)}
    assert any("skew=true" in plan for plan in plans)
