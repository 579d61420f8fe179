"""Exact top-k search by integer inner product over k-d trees, one for each shard of the candidates.

Rows are dealt into shards by a shallow tree of median splits over a sample, so that a shard holds a region; the sample
decides only which rows lie together. A shard is a tree of median splits with the tight bounding box of every node. No
row of a box can score above sum(max(q * low, q * high)). A query walks a tree best bound first, from the root down
along a queue of nodes, and stops at the first whose bound is below its k-th score so far.

Each query is answered in the shard that holds its own row first. The k-th score found there goes with it: it is sent
only to those other shards whose box can hold a better row, and most of their nodes fall below it at once. A task holds
one shard; the queries stream past it in batches, and at most k rows for each query and shard come out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import stable

SHARD_ROWS = 8192
LEAF_ROWS = 128
#: Rows that the splits between shards are made from, and the bytes of all boxes of shards, which every task gets.
SAMPLE_ROWS = 20_000
BOX_BYTES = 32 << 20
SCALE = 64
NONE = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """``row, vec_id, size, vector`` (whole numbers as packed doubles) of the rows whose vector takes part.

    A component x becomes floor(64 * x). Null vectors and those with a null or non-finite component are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.finfo(np.float64).max
        for batch in batches:
            kept, sizes, packed = [], [], []
            for at, value in enumerate(batch.column("embedding")):
                if not value.is_valid or value.values.null_count:
                    continue
                x = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(SCALE * x), -most, most)
                kept.append(at)
                sizes.append(len(x))
                packed.append(x.astype("<f8").tobytes())
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row").take(at), batch.column("vec_id").take(at), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                names=["row", "vec_id", "size", "vector"],
            )

    rows = embeddings.select(F.monotonically_increasing_id().alias("_row"), F.col("vec_id").cast("long"), "embedding")
    return rows.mapInArrow(run, "row long, vec_id long, size long, vector binary")


# ---------------------------------------------------------------- numbers

def _largest(x: np.ndarray) -> float:
    return float(np.abs(x).max(initial=0.0))


def arithmetic(queries: np.ndarray, points: np.ndarray) -> type:
    """The numbers in which the inner products are exact: doubles, 64-bit integers, or Python's own."""
    bound = _largest(queries) * _largest(points) * max(1, queries.shape[1])
    return float if bound < 2**53 else int if bound < 2**62 else object


def products(queries: np.ndarray, points: np.ndarray, exact: type) -> np.ndarray:
    """All inner products as 64-bit integers: exact, or the nearest limit beyond them."""
    if exact is float:
        return (queries @ points.T).astype(np.int64)
    if exact is int:
        return queries.astype(np.int64) @ points.astype(np.int64).T
    left, right = ([[int(v) for v in row] for row in x.tolist()] for x in (queries, points))
    return np.array([[min(max(sum(a * b for a, b in zip(q, p)), NONE + 1), MOST) for p in right] for q in left], np.int64)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For every query and box a score that no row of the box exceeds."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    size = max(_largest(low), _largest(high))
    if _largest(queries) * size * max(1, queries.shape[1]) < 2**52:
        return products(up, high, float) + products(down, low, float)
    with np.errstate(over="ignore", invalid="ignore"):
        found = up @ high.T + down @ low.T
        # Rounded away from what may be missed; infinities and what is no number count as no bound.
        slack = (up @ np.abs(high).T - down @ np.abs(low).T) * 1e-12
        found = np.where(np.isfinite(found) & np.isfinite(slack), found + slack, np.inf)
    return np.where(found < 2.0**62, np.clip(found, -(2.0**62), 2.0**62).astype(np.int64) + 1, MOST)


# ---------------------------------------------------------------- trees

@dataclass(frozen=True)
class Tree:
    """A k-d tree: node n has the rows ``start[n]`` to ``stop[n]``, a tight box, and two children or none (-1)."""

    rows: np.ndarray
    ids: np.ndarray
    points: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    left: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _split(inside: np.ndarray) -> int | None:
    """The component with the widest spread; none where all rows are equal."""
    if not inside.shape[1]:
        return None
    low, high = inside.min(axis=0), inside.max(axis=0)
    return int((high / 2 - low / 2).argmax()) if (high > low).any() else None


def build_tree(rows: np.ndarray, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    """Median splits along the widest component. The children of a node are next to each other."""
    order = np.arange(len(rows))
    spans, left = [(0, len(rows))], [-1]
    at = 0
    while at < len(spans):
        a, b = spans[at]
        inside = points[order[a:b]]
        wide = _split(inside) if b - a > leaf_rows else None
        if wide is not None:
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(inside[:, wide], half)]
            left[at] = len(spans)
            spans += [(a, a + half), (a + half, b)]
            left += [-1, -1]
        at += 1
    points = points[order]
    low = np.stack([points[a:b].min(axis=0) for a, b in spans])
    high = np.stack([points[a:b].max(axis=0) for a, b in spans])
    start, stop = np.array(spans).T
    return Tree(rows[order], ids[order], points, start, stop, np.array(left), low, high)


def walk(tree: Tree, bound: np.ndarray, query: np.ndarray, row: int, least: int, k: int, exact: type) -> list[tuple[int, int, int, int]]:
    """``(score, -id, -row, place)`` of the best ``k`` rows that score at least ``least``, best first from the root.

    The queue holds nodes by their bound. Once the best bound is below the k-th score, all others are too.
    """
    best: list[tuple[int, int, int, int]] = []
    kth = least
    queue = [(-int(bound[0]), 0)]
    while queue:
        most, node = heapq.heappop(queue)
        if -most < kth:
            break
        child = tree.left[node]
        if child >= 0:
            for n in (child, child + 1):
                if bound[n] >= kth:
                    heapq.heappush(queue, (-int(bound[n]), int(n)))
            continue
        a, b = int(tree.start[node]), int(tree.stop[node])
        scores = products(query[None, :], tree.points[a:b], exact)[0]
        for place in np.flatnonzero(scores >= kth).tolist():
            if tree.rows[a + place] != row:
                one = (int(scores[place]), -int(tree.ids[a + place]), -int(tree.rows[a + place]), a + place)
                if len(best) < k:
                    heapq.heappush(best, one)
                elif one > best[0]:
                    heapq.heapreplace(best, one)
        if len(best) == k:
            kth = max(kth, best[0][0])
    return sorted(best, reverse=True)


class Regions:
    """Median splits over a sample that deal rows into ``shards`` regions, each again into ``parts`` by hash."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.splits: dict[int, tuple[int, float, int, int]] = {}
        self.count = 0
        todo = [(0, np.arange(len(sample)), max(min(shards, len(sample) // 8), 1))]
        nodes = 1
        self.region: dict[int, int] = {}
        while todo:
            node, at, wanted = todo.pop()
            wide = _split(sample[at]) if wanted > 1 else None
            if wide is None:
                self.region[node] = self.count
                self.count += 1
                continue
            cut = float(np.sort(sample[at, wide])[len(at) * (wanted // 2) // wanted])
            below = sample[at, wide] < cut
            if not below.any():
                self.region[node] = self.count
                self.count += 1
                continue
            self.splits[node] = (wide, cut, nodes, nodes + 1)
            todo += [(nodes, at[below], wanted // 2), (nodes + 1, at[~below], wanted - wanted // 2)]
            nodes += 2
        self.parts = max(-(-shards // self.count), 1)

    def shard(self, rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        found, todo = np.zeros(len(rows), np.int64), [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if node not in self.splits:
                found[at] = self.region[node]
                continue
            wide, cut, left, right = self.splits[node]
            below = points[at, wide] < cut
            todo += [(left, at[below]), (right, at[~below])]
        # Rows of one region in turn; a multiplier spreads runs of row numbers.
        return found * self.parts + (rows * 2654435761 >> 16) % self.parts


def _points(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<f8").reshape(batch.num_rows, -1)


def _regions(vectors: DataFrame, shard_rows: int) -> dict[int, Regions]:
    """For each length of vectors its regions, from at most ``SAMPLE_ROWS`` of all rows, chosen by a hash."""
    counts = {r["size"]: r["count"] for r in vectors.groupBy("size").count().collect()}
    share = max(sum(counts.values()) // (SAMPLE_ROWS // 2), 1)
    sample = vectors.where(F.pmod(F.xxhash64("row"), F.lit(share)) == 0).orderBy("row").limit(SAMPLE_ROWS).select("size", "vector").collect()
    found = {}
    for size, count in counts.items():
        shards = min(-(-count // shard_rows), max(BOX_BYTES // (16 * max(size, 1)), 1))
        rows = [np.frombuffer(r["vector"], "<f8") for r in sample if r["size"] == size]
        found[size] = Regions(np.array(rows).reshape(len(rows), size), shards)
    return found


def _dealt(vectors: DataFrame, regions: dict[int, Regions]) -> DataFrame:
    """The vectors with their ``shard``."""
    sent = vectors.sparkSession.sparkContext.broadcast(regions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, rows = batch.column("size").to_numpy(), batch.column("row").to_numpy()
            shards = np.zeros(len(rows), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                shards[at] = sent.value[int(size)].shard(rows[at], _points(batch.take(pa.array(at))))
            yield batch.append_column("shard", pa.array(shards))

    return vectors.mapInArrow(run, "row long, vec_id long, size long, vector binary, shard long")


# ---------------------------------------------------------------- search

def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, ids (null: the largest number), k-th scores and vectors of a batch of one size of vector."""
    ids = batch.column("vec_id").fill_null(MOST).to_numpy()
    return batch.column("row").to_numpy(), ids, batch.column("least").fill_null(NONE).to_numpy(), _points(batch)


FOUND = "query_row long, query_id long, row long, vec_id long, score long, size long, shard long, low binary, high binary"
_FOUND_TYPES = dict(zip([p.split()[0] for p in FOUND.split(", ")], [pa.int64()] * 7 + [pa.binary()] * 2))


def _found(columns: dict[str, list | np.ndarray], rows: int) -> pa.RecordBatch:
    arrays = [pa.array(columns[name], kind) if name in columns else pa.nulls(rows, kind) for name, kind in _FOUND_TYPES.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(_FOUND_TYPES))


def search_shards(members: DataFrame, asked: DataFrame, k: int, boxes: bool = False) -> DataFrame:
    """The best ``k`` of each query in each shard it is sent to; with ``boxes`` a row for the box of each shard as well."""
    columns = ["size", "shard", "asks", "row", "vec_id", "least", "vector"]
    sides = members.withColumns({"asks": F.lit(False), "least": F.lit(None).cast("long")}).select(*columns).unionByName(
        asked.withColumn("asks", F.lit(True)).select(*columns)
    )
    ordered = sides.repartition("size", "shard").sortWithinPartitions("size", "shard", "asks", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current, tree = None, None

        def planted() -> Tree | None:
            if not held:
                return None
            rows, ids, _, points = (np.concatenate(x) for x in zip(*map(_matrix, held)))
            return build_tree(rows, ids, points)

        def box(tree: Tree) -> pa.RecordBatch:
            sides = {"low": [tree.low[0].tobytes()], "high": [tree.high[0].tobytes()]}
            return _found({"size": [current[0]], "shard": [current[1]], **sides}, 1)

        for batch in batches:
            keys = np.stack([batch.column(c).cast(pa.int64()).to_numpy() for c in ("size", "shard", "asks")])
            cuts = [0, *(np.flatnonzero(np.diff(keys, axis=1).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part, key, asks = batch.slice(a, b - a), tuple(keys[:2, a].tolist()), bool(keys[2, a])
                if key != current:
                    if boxes and held and tree is None:
                        yield box(planted())
                    held, current, tree = [], key, None
                if not asks:
                    held.append(part)
                    continue
                if tree is None:
                    tree = planted()
                    if tree is None:
                        continue
                    held = []
                    if boxes:
                        yield box(tree)
                rows, ids, least, queries = _matrix(part)
                exact = arithmetic(queries, tree.points)
                for at in range(0, len(rows), 256):
                    bound = bounds(queries[at : at + 256], tree.low, tree.high)
                    out: dict[str, list] = {name: [] for name in ("query_row", "query_id", "row", "vec_id", "score")}
                    for n in range(len(bound)):
                        for score, minus_id, minus_row, _ in walk(tree, bound[n], queries[at + n], rows[at + n], int(least[at + n]), k, exact):
                            out["query_row"].append(rows[at + n])
                            out["query_id"].append(ids[at + n])
                            out["row"].append(-minus_row)
                            out["vec_id"].append(None if -minus_id == MOST else -minus_id)
                            out["score"].append(score)
                    yield _found(out, len(out["row"]))
        if boxes and held and tree is None:
            yield box(planted())

    return ordered.mapInArrow(run, FOUND)


def _sent_on(asked: DataFrame, boxes: DataFrame) -> DataFrame:
    """Queries (``row, vec_id, size, vector, home, least``) with each other shard whose box may hold one of their best.

    The boxes of all shards come to the driver and go to the tasks: ``BOX_BYTES`` for each length of vectors at most.
    """
    table: dict[int, tuple] = {}
    for r in boxes.orderBy("size", "shard").collect():
        table.setdefault(r["size"], []).append((r["shard"], np.frombuffer(r["low"], "<f8"), np.frombuffer(r["high"], "<f8")))
    table = {size: tuple(np.stack(x) if n else np.array(x) for n, x in enumerate(zip(*rows))) for size, rows in table.items()}
    sent = asked.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                shards, low, high = sent.value[int(size)]
                least, home = own.column("least").fill_null(NONE).to_numpy(), own.column("home").to_numpy()
                points = _points(own)
                for at in range(0, own.num_rows, 1024):
                    piece = slice(at, at + 1024)
                    going = (bounds(points[piece], low, high) >= least[piece, None]) & (shards[None, :] != home[piece, None])
                    query, place = np.nonzero(going)
                    rows = own.take(pa.array(query + at))
                    for part in range(0, len(query), 4096):
                        some = rows.slice(part, 4096)
                        yield some.append_column("shard", pa.array(shards[place[part : part + 4096]], pa.int64()))

    columns = ["row", "vec_id", "size", "vector", "home", "least"]
    return asked.select(*columns).mapInArrow(run, "row long, vec_id long, size long, vector binary, home long, least long, shard long")


def exact_top_k(embeddings: DataFrame, k: int = 20, every: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows by inner product of every query.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates are all rows but the query's own, so a
    repeated row is a candidate of its copy, and each copy of a query has an answer of its own. Ties go to the smaller
    id (null ids last). Vectors meet only vectors of the same length; those of length 0 score 0. Vectors that are null
    or hold null or non-finite components take no part; scores beyond 64 bits count as the nearest limit. An empty table
    gives an empty result; columns other than ``vec_id`` and ``embedding`` are not looked at.
    """
    vectors = stable(integer_vectors(embeddings))
    members = stable(_dealt(vectors, _regions(vectors, shard_rows)))
    asked = members.where(F.col("vec_id") % every == 0).withColumn("least", F.lit(None).cast("long"))
    found = stable(search_shards(members, asked, k, boxes=True))
    first, boxes = found.where("low is null"), found.where("low is not null").select("size", "shard", "low", "high")
    reached = first.groupBy("query_row").agg(F.count("*").alias("n"), F.min("score").alias("lowest"))
    reached = reached.select(F.col("query_row").alias("row"), F.when(F.col("n") >= k, F.col("lowest")).alias("least"))
    onward = asked.drop("least").withColumnRenamed("shard", "home").join(reached, "row", "left")
    rest = search_shards(members, _sent_on(onward, boxes), k)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
