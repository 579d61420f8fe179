"""The prefix trie of conversations over sorted shards and a skeleton of their splitters.

A conversation's path is the sequence of its turns, each as 16 bytes of a SHA-256 over role and text, so that paths
sort like strings of turns and a prefix comes right before what it begins.

1. Splitters: ranges of (path, conversation) of about ``SHARD_ROWS`` each, from a sample. They decide only where shards
   begin; any sample gives the same nodes. Their paths are broadcast; the trie of these paths is the skeleton.
2. Shards: a node can lie in several shards only if it is a prefix of a splitter, and within a shard only of the two
   that bound it. Every shard is read once in sorted order with the open nodes on a stack. All other nodes are finished
   there; of skeleton nodes the shard gives one row of partial counts.
3. Reduction: the partial rows are added up by node, then one pass over the skeleton in the order of its trie, deepest
   nodes first, adds up the subtrees. The skeleton has at most as many nodes as the splitters have turns.

Copies of one conversation, however many, are cut by the conversation's id; they are then one skeleton node.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.lookups import broadcast_if_small
from wardline.session import stable

TURN = 16
SHARD_ROWS = 50_000
SAMPLED = 50
#: The splitters' paths in bytes; where they would be longer, fewer splitters are taken.
SKELETON_BYTES = 4 << 20
CHUNK_IDS = 1024

Key = tuple[bytes, int]


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, digest, chars`` of every turn, ``place`` from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.substring(F.unhex(F.sha2(framed.cast("binary"), 256)), 1, TURN).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return turns.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "digest", "chars")


def _path(turns: Column) -> list[Column]:
    digests = F.transform(turns, lambda t: F.hex(t["digest"]))
    return [F.unhex(F.array_join(digests, "")).alias("path"), F.transform(turns, lambda t: t["chars"]).alias("chars")]


def conversation_paths(conversations: DataFrame, heads: Column | None = None, group: Column | None = None) -> DataFrame:
    """``conv_id, path, chars`` of every conversation; ``chars`` are the code points of its turns.

    With ``heads`` (an expression over ``conv_id``: how many turns) and ``group`` (whose) the first turns of every
    conversation are exchanged for those of the conversation of its group, as far as that one has any.
    """
    turns = _turns(conversations)
    one = F.struct("place", "digest", "chars")
    whole = stable(turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns")))
    if heads is None:
        return whole.select("conv_id", *_path(F.col("turns")))
    wanted = whole.select("conv_id", "turns", heads.cast("int").alias("heads"), group.alias("base"))
    longest = wanted.agg(F.max("heads")).first()[0] or 0
    bases = wanted.select("base").distinct()
    first = whole.select(F.col("conv_id").alias("base"), F.slice("turns", 1, max(longest, 1)).alias("head"))
    first = first.join(bases, "base", "left_semi")
    joined = wanted.join(first, "base", "left")
    taken = F.coalesce(F.expr("slice(head, 1, heads)"), F.expr("slice(turns, 1, 0)"))
    own = F.expr("slice(turns, heads + 1, size(turns))")
    return joined.select("conv_id", F.concat(taken, own).alias("turns")).select("conv_id", *_path(F.col("turns")))


def shared(a: bytes, b: bytes) -> int:
    """How many turns two paths have in common."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: middle * TURN] == b[: middle * TURN] else (low, middle - 1)
    return low


class Skeleton:
    """The trie of the splitters' paths. A node is (the first splitter that it is a prefix of, its depth)."""

    def __init__(self, splitters: list[Key]):
        self.splitters = splitters
        self.runs: list[list[tuple[int, int]]] = []
        for at, (path, _) in enumerate(splitters):
            # (splitter, depth): from the end of the run before down to this depth, nodes belong to that splitter.
            common = shared(splitters[at - 1][0], path) if at else -1
            runs = [(s, min(d, common)) for s, d in self.runs[-1]] if at else []
            kept = [r for n, r in enumerate(runs) if not n or r[1] > runs[n - 1][1]]
            own = len(path) // TURN
            self.runs.append(kept + [(at, own)] if own > common else kept)

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def depth_within(self, shard: int, path: bytes) -> tuple[int, int]:
        """The deepest prefix of a path of this shard that is in the skeleton, and a splitter that has it; -1: none."""
        near = [s for s in (shard - 1, shard) if 0 <= s < len(self.splitters)]
        return max(((shared(self.splitters[s][0], path), s) for s in near), default=(-1, -1))

    def origin(self, splitter: int, depth: int) -> int:
        """The first splitter with the prefix that ``splitter`` has at ``depth``."""
        return next(s for s, until in self.runs[splitter] if depth <= until)


def skeleton(paths: DataFrame, shard_rows: int = SHARD_ROWS, skeleton_bytes: int = SKELETON_BYTES) -> Skeleton:
    """Splitters between shards of about ``shard_rows``, and at least one shard for each shuffle partition."""
    rows = paths.count()
    partitions = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-rows // shard_rows), min(partitions, rows))
    # Of a sample by hash, about SAMPLED rows a shard: sorted and numbered by Spark, one in SAMPLED comes here.
    sample = paths.select("path", "conv_id", F.octet_length("path").alias("bytes"))
    sample = sample.where(F.pmod(F.xxhash64("conv_id"), F.lit(max(rows // max(shards * SAMPLED, 1), 1))) == 0)
    sample = stable(sample)
    found, size = sample.agg(F.count("*"), F.sum("bytes")).first()
    shards = min(shards, found)
    if shards and size / found * shards > skeleton_bytes:
        shards = max(int(skeleton_bytes * found // size), 1)
    if shards < 2:
        return Skeleton([])
    place = F.row_number().over(Window.orderBy("path", "conv_id"))
    numbered = sample.select("path", "conv_id", "bytes", place.alias("place"))
    ends = numbered.where(F.floor(F.col("place") * shards / found) > F.floor((F.col("place") - 1) * shards / found)).where(F.col("place") < found)
    # Long paths may gather at the ends; of those no more than the bytes allowed.
    ends = ends.withColumn("sum", F.sum("bytes").over(Window.orderBy("bytes", "place").rowsBetween(Window.unboundedPreceding, 0)))
    kept = ends.where(F.col("sum") <= skeleton_bytes).select("path", "conv_id").collect()
    return Skeleton(sorted((bytes(r["path"]), r["conv_id"]) for r in kept))


@dataclass
class Node:
    """An open node: what is known of the conversations below it."""

    depth: int
    chars: int
    origin: int
    least: int = 2**63 - 1
    convs: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    digest: object = None
    ended: bool = False
    chunk: list[str] = field(default_factory=list)
    chunks: int = 0
    waiting: list[tuple] = field(default_factory=list)


ROW = (
    "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, origin int, chars long, shard int, chunk int, ids string"
)
FINISHED, PARTIAL, ENDS = 0, 1, 2
KINDS = dict(zip("kind conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256 origin chars shard chunk ids".split(),
                 [pa.int32(), *[pa.int64()] * 7, pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string()]))
EMPTY = hashlib.sha256().hexdigest()


class Shard:
    """One pass over the sorted paths of a shard. Rows wait for nothing but their parent's smallest member."""

    def __init__(self, number: int, trie: Skeleton):
        self.number, self.trie = number, trie
        self.open: list[Node] = []
        self.last = b""
        self.out: list[tuple] = []

    def add(self, conv_id: int, path: bytes, chars: list[int]) -> None:
        common = shared(self.last, path) if self.open else -1
        self._close(common)
        if len(self.open) <= len(path) // TURN:
            until, splitter = self.trie.depth_within(self.number, path)
            for depth in range(len(self.open), len(path) // TURN + 1):
                origin = self.trie.origin(splitter, depth) if depth <= until else -1
                self.open.append(Node(depth, chars[depth - 1] if depth else 0, origin))
        self.last = path
        # Only at the node where it ends; the nodes above learn of it when this one is closed.
        node = self.open[-1]
        node.convs += 1
        node.least = min(node.least, conv_id)
        if node.origin >= 0:
            node.chunk.append(str(conv_id))
            if len(node.chunk) == CHUNK_IDS:
                self._flush(node)
        else:
            if not node.digest:
                node.digest = hashlib.sha256()
            node.digest.update(f"{',' if node.ended else ''}{conv_id}".encode())
            node.ended = True

    def _flush(self, node: Node) -> None:
        if node.chunk:
            self.out.append((ENDS, None, node.depth, *[None] * 6, node.origin, None, self.number, node.chunks, ",".join(node.chunk)))
            node.chunk, node.chunks = [], node.chunks + 1

    def _close(self, depth: int) -> None:
        """Finish the open nodes below ``depth``."""
        while len(self.open) > depth + 1:
            node = self.open.pop()
            above = self.open[-1] if self.open else None
            if above:
                above.convs += node.convs
                above.least = min(above.least, node.least)
            if node.origin >= 0:
                self._flush(node)
                self.out.append(
                    (PARTIAL, node.least, node.depth, None, node.convs, node.children, node.leaves, node.saved, None, node.origin, node.chars, *[None] * 3)
                )
                continue
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.convs - 1) * node.chars
            ends = node.digest.hexdigest() if node.digest else EMPTY
            row = (node.least, node.depth, node.convs, node.children, leaves, saved, ends)
            self.out += [self._row(r, node.least, None) for r in node.waiting]
            if above is None:
                self.out.append(self._row(row, None, None))
                continue
            above.children += 1
            above.leaves += leaves
            above.saved += saved
            if above.origin >= 0:
                self.out.append(self._row(row, None, above.origin))
            else:
                above.waiting.append(row)

    def _row(self, row: tuple, parent: int | None, origin: int | None) -> tuple:
        return (FINISHED, row[0], row[1], parent, *row[2:], origin, *[None] * 4)

    def end(self) -> None:
        self._close(-1)


def _shard_rows(sent) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None

        def rows() -> pa.RecordBatch:
            out, shard.out = shard.out, []
            columns = zip(*out) if out else [[] for _ in KINDS]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS.values())], names=list(KINDS))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "chars")]
            for number, conv_id, path, chars in zip(*columns):
                if shard is None or shard.number != number:
                    if shard is not None:
                        shard.end()
                        yield rows()
                    shard = Shard(number, sent.value)
                shard.add(conv_id, path, chars)
                if len(shard.out) > 10_000:
                    yield rows()
        if shard is not None:
            shard.end()
            yield rows()

    return run


def _into_shards(paths: DataFrame, trie: Skeleton, sent) -> DataFrame:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = map(sent.value.shard, batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            yield batch.append_column("shard", pa.array(list(found), pa.int32()))

    dealt = paths.mapInArrow(deal, "conv_id long, path binary, chars array<long>, shard int")
    return dealt.repartitionById(len(trie.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")


def _ends(rows: DataFrame) -> DataFrame:
    """``origin, depth, ends_sha256``: the digests of skeleton nodes, their chunks of ids one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def done() -> pa.RecordBatch:
            values = [[node[0]], [node[1]], [digest.hexdigest()]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int64(), pa.string()))], names=["origin", "depth", "ends_sha256"])

        for batch in batches:
            for origin, depth, ids in zip(*[batch.column(c).to_pylist() for c in ("origin", "depth", "ids")]):
                if node == (origin, depth):
                    digest.update(b",")
                else:
                    if node:
                        yield done()
                    node, digest = (origin, depth), hashlib.sha256()
                digest.update(ids.encode())
        if node:
            yield done()

    chunks = rows.where(F.col("kind") == ENDS).select("origin", "depth", "shard", "chunk", "ids")
    ordered = chunks.repartition("origin", "depth").sortWithinPartitions("origin", "depth", "shard", "chunk")
    return ordered.select("origin", "depth", "ids").mapInArrow(run, "origin int, depth long, ends_sha256 string")


def _reduce(rows: DataFrame) -> DataFrame:
    """The finished skeleton: partial rows added up by node, then subtrees in one pass over the trie's own order."""
    partial = rows.where(F.col("kind") == PARTIAL).groupBy("origin", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    columns = "origin depth conv_id chars n_convs n_children n_leaves saved_tokens".split()
    kinds = {"origin": pa.int32()} | dict.fromkeys([*columns[1:], "parent_conv_id"], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        path: list[dict] = []

        def close(depth: int) -> None:
            while len(path) > depth:
                node = path.pop()
                node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
                node["saved_tokens"] += (node["n_convs"] - 1) * node["chars"]
                if path:
                    for name, more in (("n_children", 1), ("n_leaves", node["n_leaves"]), ("saved_tokens", node["saved_tokens"])):
                        path[-1][name] += more
                node["parent_conv_id"] = path[-1]["conv_id"] if path else None
                done.append(node)

        for batch in batches:
            for node in batch.to_pylist():
                close(node["depth"])
                path.append(node)
            yield pa.RecordBatch.from_arrays([pa.array([n[c] for n in done], t) for c, t in kinds.items()], names=list(kinds))
            done.clear()
        close(0)
        yield pa.RecordBatch.from_arrays([pa.array([n[c] for n in done], t) for c, t in kinds.items()], names=list(kinds))

    schema = "origin int, " + ", ".join(f"{c} long" for c in [*columns[1:], "parent_conv_id"])
    return partial.select(*columns).coalesce(1).sortWithinPartitions("origin", "depth").mapInArrow(run, schema)


def prefix_trie(paths: DataFrame, shard_rows: int = SHARD_ROWS, skeleton_bytes: int = SKELETON_BYTES) -> DataFrame:
    """One row for every node of the trie of ``conv_id, path, chars``.

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    The root has depth 0 and no parent. No conversations: an empty result.
    """
    spark = paths.sparkSession
    paths = stable(paths)
    trie = skeleton(paths, shard_rows, skeleton_bytes)
    sent = spark.sparkContext.broadcast(trie)
    rows = stable(_into_shards(paths, trie, sent).select("conv_id", "path", "chars", "shard").mapInArrow(_shard_rows(sent), ROW))
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    finished = rows.where(F.col("kind") == FINISHED)
    if not trie.splitters:
        return finished.select(*columns)
    top = stable(_reduce(rows).join(_ends(rows), ["origin", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))))
    # One row for each turn of the splitters at most; its size is measured all the same.
    above = broadcast_if_small(top.select(F.col("origin").alias("_origin"), (F.col("depth") + 1).alias("_depth"), F.col("conv_id").alias("_above")))
    hung = finished.join(above, (F.col("origin") == F.col("_origin")) & (F.col("depth") == F.col("_depth")), "left")
    hung = hung.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    return hung.select(*columns).unionByName(top.select(*columns))


def conversation_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of rebuilt conversations: the first crc32(conv_id) % 6 turns come from conversation c - c % 100.

    Turns are ordered by ``turn``, null first, equal ones by a hash of their role and text; null role or text is empty.
    Rows without ``conv_id`` belong to no conversation. Repeated rows are repeated turns; other columns are not read.
    A conversation is one row of 16 bytes and a number for each turn, however long its texts are.
    """
    conv_id = F.col("conv_id")
    heads = F.crc32(conv_id.cast("string").cast("binary")) % 6
    return prefix_trie(conversation_paths(conversations, heads, conv_id - conv_id % 100), shard_rows)
