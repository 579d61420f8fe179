import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import prose
from wardline.llm.prefixes import Skeleton, conversation_paths, conversation_trie, prefix_trie, shared

SCHEMA = "conv_id long, turn long, role string, text string, depth string, path string, origin string, shard string, chars string"


def frame(spark, data):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in data], SCHEMA)


def rebuilt(data):
    turns = defaultdict(list)
    for c, t, role, text in data:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append((t is not None, t or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + mine[h:]
    return out


def expected(conversations):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, inside in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(inside) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, inside in members.items()
    )


def talk(c, *texts):
    return [(c, n, "user" if n % 2 == 0 else "assistant", t) for n, t in enumerate(texts)]


def random_talks(count, seed, words=3, longest=9):
    draw = random.Random(seed)
    return [r for c in range(count) for r in talk(c, *[f"w{draw.randrange(words)}" for _ in range(draw.randrange(1, longest))])]


CASES = {
    "plain": random_talks(300, 1),
    "copies": [r for c in range(400) for r in talk(c, "same", "talk", "for", "all", "of", "them", "here")] + random_talks(40, 2, 50),
    "all alike": [r for c in range(0, 20_000, 100) for r in talk(c, "one", "two")],
    "broken": [
        *random_talks(30, 3), (None, 0, "user", "nobody"), (700, None, None, None), (700, 1, "user", "é日本𝒳"), (700, 0, None, "x"),
        (800, 0, "user", prose(3000, 1)), (901, 5, "user", "only"), (901, 5, "user", "only"), (-5, 0, "a", "b"), (-105, 0, "a", "b"), (-100, 0, "q", "r"),
        (2**63 - 1, 0, "a", "b"), (1000, 0, "us", "erx"), (1100, 0, "user", "x"),
    ],
    "one": talk(100, "hello"),
    "turnless": [(c, 0, "user", "x") for c in range(1001, 1050)],
    "deep": [r for c in range(0, 300, 100) for r in talk(c, *["again"] * 300, f"end {c}")],
    "chain": [r for n in range(30) for r in talk(100 * n, *["again"] * n)] + [(5000, 0, "user", "again")],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("shard_rows", [50_000, 3])
def test_nodes(spark, name, shard_rows):
    got = conversation_trie(frame(spark, CASES[name]), shard_rows).collect()
    assert sorted(map(tuple, got)) == expected(rebuilt(CASES[name]))


def test_short_skeletons_give_the_same_nodes(spark):
    data = CASES["deep"] + CASES["copies"]
    paths = conversation_paths(frame(spark, data))
    whole = {r["conv_id"]: r for r in paths.collect()}
    assert all(len(r["path"]) == 16 * len(r["chars"]) for r in whole.values())
    wanted = sorted(map(tuple, prefix_trie(paths, 5).collect()))
    for most in (1, 500, 5000):
        assert sorted(map(tuple, prefix_trie(paths, 5, most).collect())) == wanted


def test_more_ids_than_a_chunk_end_at_one_node(spark):
    ids = spark.range(5000).select(
        F.col("id").alias("conv_id"), F.lit(bytes(range(16))).alias("path"), F.array(F.lit(7).cast("long")).alias("chars")
    )
    got = {r["depth"]: r for r in prefix_trie(ids, 2100).collect()}
    assert got[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest()
    assert (got[1]["n_convs"], got[1]["n_leaves"], got[1]["saved_tokens"], got[0]["saved_tokens"]) == (5000, 1, 4999 * 7, 4999 * 7)


def test_empty_table(spark):
    assert conversation_trie(frame(spark, [])).collect() == []
    assert conversation_trie(frame(spark, [(None, 0, "user", "x")])).collect() == []


def test_origins_of_skeleton_nodes():
    turn = [bytes([n]) * 16 for n in range(5)]
    paths = [turn[0] + turn[1] + turn[2], turn[0] + turn[1] + turn[3], turn[0] + turn[2], turn[0] + turn[2], turn[1]]
    trie = Skeleton([(p, n) for n, p in enumerate(paths)])
    for at, path in enumerate(paths):
        for depth in range(len(path) // 16 + 1):
            first = min(n for n, p in enumerate(paths) if p[: depth * 16] == path[: depth * 16] and len(p) >= depth * 16)
            assert trie.origin(at, depth) == first
    assert shared(paths[0], paths[1]) == 2 and shared(b"", paths[0]) == 0
