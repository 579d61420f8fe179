"""Near copies by SimHash, found through covering locality-sensitive hashing.

Every bit of a fingerprint is given a nonzero vector of ``radius + 1`` bits. For each nonzero vector v of that length
there is a mask of the fingerprint bits whose vector has an odd inner product with v, and a table keyed by the masked
fingerprint. At most ``radius`` differing bits leave some v with an even product for all of them, so its mask shows
none of them: every pair within the radius meets in some table, and no probability is involved. Masks cover about
half of the bits each, so other pairs seldom meet.

Only different fingerprints are compared; copies are one fingerprint. A bucket with up to ``BUCKET_ROWS`` members is
compared in one place and gives the links of a spanning forest, not all its pairs. The members of larger buckets are
linked over the points halfway between them: two fingerprints within the radius are both within ``radius / 2`` bits of
some point, so each gives all points that close and is linked to the smallest fingerprint at each. That is exact, and
its cost grows with the number of members, not of pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import PLACE, column_bytes, with_place
from wardline.llm.graphs import components
from wardline.session import stable

BITS = 64
SEED = 42
BUCKET_ROWS = 1024


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned SimHash of the shingles of a text in UTF-8, repeats included; 0 where it has no words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:count].tolist()
    ends = ends[-count:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, count)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, 4096):
        octets = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > count).tolist())


def fingerprints(docs: DataFrame, keep: Sequence[str], shingle: int) -> DataFrame:
    """The columns ``keep`` and ``fingerprint`` (long, the 64 bits as they are) of every row."""
    docs = docs.select(*keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in column_bytes(batch, "text")), np.uint64, batch.num_rows)
            columns = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], names=[*keep, "fingerprint"])

    schema = docs.select(*keep, F.lit(0).cast("long").alias("fingerprint")).schema
    return docs.mapInArrow(run, schema)


def covering_masks(radius: int) -> list[int]:
    """The masks, as signed 64-bit numbers; the vectors of the bits go round all nonzero ones."""
    vectors = [bit % ((1 << (radius + 1)) - 1) + 1 for bit in range(BITS)]
    masks = []
    for v in range(1, 1 << (radius + 1)):
        mask = sum(1 << bit for bit, vector in enumerate(vectors) if (vector & v).bit_count() % 2)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def _forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join what is joined by steps of at most ``radius`` bits."""
    left = np.ones(len(members), bool)
    links = []
    for start in range(len(members)):
        if not left[start]:
            continue
        left[start] = False
        frontier = [start]
        while frontier:
            at = frontier.pop()
            near = np.flatnonzero(left & (np.bitwise_count(members ^ members[at]) <= radius))
            left[near] = False
            links.extend((at, int(other)) for other in near)
            frontier.extend(near.tolist())
    return links


def bucket_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` within the buckets of ``rows`` (mask, masked, fingerprint), each at most ``BUCKET_ROWS`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)]))
            rows = np.concatenate(held, axis=1) if held else np.empty((3, 0), np.int64)
            edges = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
            bounds = [0, *edges.tolist(), rows.shape[1]]
            whole = bounds if batch is None else bounds[:-1]
            points = rows[2].view(np.uint64)
            pairs = [(a + i, a + j) for a, b in itertools.pairwise(whole) for i, j in _forest(points[a:b], radius)]
            if pairs:
                at = np.array(pairs)
                ends = [pa.array(rows[2][at[:, 0]]), pa.array(rows[2][at[:, 1]])]
                yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])
            held = [rows[:, whole[-1] :]]

    ordered = rows.repartition("mask", "masked").sortWithinPartitions("mask", "masked", "fingerprint")
    return ordered.select("mask", "masked", "fingerprint").mapInArrow(run, "a long, b long")


def midpoint_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links among the ``fingerprint`` of ``rows`` over all points within half the radius.

    Two members that an odd radius parts have a point that is nearer to one of them: the smallest of the nearer members
    of a point is linked to all others, which are within the radius of it.
    """
    flips = [0]
    for n in range(1, (radius + 1) // 2 + 1):
        for bits in itertools.combinations(range(BITS), n):
            flip = sum(1 << bit for bit in bits)
            flips.append(flip - (1 << BITS) if flip >> (BITS - 1) else flip)
    patterns = F.split(F.lit(",".join(map(str, flips))), ",").cast("array<bigint>")
    points = rows.select("fingerprint", F.explode(patterns).alias("flip"))
    points = points.select("fingerprint", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("point"))
    bits = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("point")))
    nearer = F.when(bits <= radius // 2, F.col("fingerprint")) if radius % 2 else F.col("fingerprint")
    ends = [F.min("fingerprint").alias("least"), F.max("fingerprint").alias("most")]
    least = points.groupBy("point").agg(F.min(nearer).alias("b"), *ends).where("b IS NOT NULL AND least < most")
    links = points.join(stable(least.select("point", "b")), "point").where("fingerprint <> b")
    return links.where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("b"))) <= radius).select(
        F.col("fingerprint").alias("a"), "b"
    )


def near_links(points: DataFrame, radius: int) -> DataFrame:
    """Links that join exactly what steps of at most ``radius`` bits join, among distinct ``fingerprint`` rows."""
    tables = F.array(
        *[
            F.struct(F.lit(n).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("masked"))
            for n, mask in enumerate(covering_masks(radius))
        ]
    )
    keyed = points.select("fingerprint", F.explode(tables).alias("key")).select("fingerprint", "key.*")
    shared = stable(keyed.groupBy("mask", "masked").agg(F.count("*").alias("members")).where("members > 1"))
    met = stable(keyed.join(shared, ["mask", "masked"]))
    small = bucket_links(met.where(F.col("members") <= BUCKET_ROWS), radius)
    large = midpoint_links(met.where(F.col("members") > BUCKET_ROWS).select("fingerprint").distinct(), radius)
    return small.unionByName(large)


def simhash_groups(docs: DataFrame, shingle: int = 4, radius: int = 4, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, fingerprint, component_id`` (and the columns ``keep``) of every row of ``docs``.

    ``fingerprint`` is written in 16 hexadecimal digits; ``component_id`` is the smallest id among all documents that
    can be reached by steps of at most ``radius`` differing bits. Null, empty and blank texts have fingerprint zero and
    are linked like any other. Null ids are left out of the minimum (null where a group has no other). Repeated rows
    stay and get the same answer; an empty table gives an empty result; columns not named are not looked at.
    """
    marked = stable(fingerprints(docs, ["doc_id", *keep], shingle))
    points = stable(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = stable(components(near_links(points.select("fingerprint"), radius)))
    rooted = points.join(roots, points["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root")
    )
    # Written, so that the fingerprints of a large component and the copies of a text are split in the joins.
    rooted = stable(rooted)
    ids = stable(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")))
    named = stable(rooted.select("fingerprint", "root").join(ids, "root").select("fingerprint", "component_id"))
    return marked.join(named, "fingerprint").select(
        "doc_id", *keep, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, columns: Sequence[str], shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group that with the smallest id stays (one of them, if repeated)."""
    placed = with_place(docs, columns)
    groups = simhash_groups(placed, shingle, radius, keep=PLACE)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *PLACE)
    # A group without any id is told apart by its fingerprint.
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("f"), "fingerprint"))
    first = groups.groupBy(group.alias("_group")).agg(F.min(order).alias("first"))
    first = first.select(*[F.col(f"first.{c}").alias(c) for c in PLACE])
    return placed.join(first, list(PLACE), "left_semi").select(*columns)
