"""Packing documents into windows by non-negative least squares over a histogram of piece lengths.

1. Tokenise; a document longer than the window is cut into whole windows and a rest.
2. Count the pieces of each length: at most ``window`` numbers, the only thing that comes to the driver.
3. List the combinations of up to three lengths that fill a window to the last token, and solve for the non-negative
   number of times each is used, by least squares against the histogram (a piece left over weighs more the longer it
   is). The solution is rounded, never using more pieces than there are.
4. Pieces left over are packed greedily, longest first, each window filled with the longest pieces that still fit.
   Where nothing fits a gap, the window is closed with padding. If padding then takes more windows than ``PADDING``
   allows, the longest piece is cut at the gap instead, and what is left of it is a piece like any other: of these
   windows only the last is padded.
5. The plan says which pieces of each length go where, as ranges of their number within the length. Numbers are
   made from counts of each (partition, length), so a length shared by a third of all pieces is numbered in parallel.
   What is left of a cut piece is numbered behind the pieces that have its length from the start.

The plan's size depends on the window alone (some 90,000 combinations for 1024), not on the data.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import column_bytes
from wardline.session import stable

END = 0
STEPS = 300
ROUND = 0.5
#: Part of the windows, and one more, that padding may take before rests are cut.
PADDING = 0.01


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a file of the tokenizers library that are cut out of a text wherever they occur."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    for token in tokens:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token {token['content']!r} takes in what stands around it")
    return {token["content"]: token["id"] for token in tokens}


@functools.cache
def encoder(path: str):
    """A function from texts to lists of ids. ``.json``: a file of the tokenizers library; ``.tiktoken``: ranks of a
    byte-level vocabulary, which with the added tokens of the ``.json`` file of the same name give its ids several times
    faster. Added tokens that occur in a text get their own ids, as ``Tokenizer.encode`` has it."""
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        added = added_tokens(path.removesuffix(".tiktoken") + ".json")
        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
        return lambda texts: [
            encoding.encode(text, allowed_special="all") if any(token in text for token in added) else encoding.encode_ordinary(text)
            for text in texts
        ]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda texts: [found.ids for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def token_pieces(docs: DataFrame, tokenizer: str, window: int = 1024) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids`` of every piece; ``ids`` are little-endian unsigned 32-bit numbers.

    Each row of ``docs`` gives its ids followed by ``END``, cut every ``window`` ids. Null and empty texts give the one
    id ``END``; repeated rows and null ids are documents like any other; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            texts, row = column_bytes(batch, "text"), 0
            while row < batch.num_rows:
                doc, start, length, total, ids, size = [], [], [], [], [], 0
                while row < batch.num_rows and size < 1 << 21:
                    tokens = np.array([*encode([next(texts).decode()])[0], END], "<u4")
                    for at in range(0, len(tokens), window):
                        piece = tokens[at : at + window]
                        doc.append(row)
                        start.append(at)
                        length.append(len(piece))
                        total.append(len(tokens))
                        ids.append(piece.tobytes())
                    size += len(tokens)
                    row += 1
                names = batch.column("doc_id").take(pa.array(doc, pa.int64()))
                numbers = [pa.array(x, pa.int64()) for x in (start, length, total)]
                yield pa.RecordBatch.from_arrays(
                    [names, *numbers, pa.array(ids, pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "ids"]
                )

    doc_id = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {doc_id}, start long, length long, doc_tokens long, ids binary"
    )


def combinations(window: int) -> np.ndarray:
    """Rows of three lengths in descending order (0: none) that sum to the window."""
    first, second = np.meshgrid(np.arange(1, window + 1), np.arange(0, window + 1), indexing="ij")
    third = window - first - second
    good = (third >= 0) & (second <= first) & (third <= second)
    return np.stack([first[good], second[good], third[good]], axis=1)


def repeat_counts(histogram: np.ndarray, patterns: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: how often each pattern is used so that the pieces used match ``histogram``.

    Accelerated projected gradient steps on the sparse incidence of patterns and lengths; ``histogram[0]`` is ignored.
    """
    window = len(histogram) - 1
    weight = np.arange(window + 1) / window
    weight[0] = 0
    flat, flags = patterns.ravel(), (patterns > 0).ravel()

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, np.repeat(x, 3) * flags, window + 1)

    def back(y: np.ndarray) -> np.ndarray:
        return y[patterns].sum(axis=1)

    scale = np.ones(len(patterns))
    for _ in range(20):  # the largest eigenvalue bounds the step
        scale = back(weight**2 * used(scale))
        scale /= np.linalg.norm(scale)
    step = 0.9 / max(scale @ back(weight**2 * used(scale)), 1e-12)
    x = momentum = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        moved = np.maximum(momentum - step * back(weight**2 * (used(momentum) - histogram)), 0)
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum, x, t = moved + (t - 1) / faster * (moved - x), moved, faster
    return x


def pack_left(left: np.ndarray, window: int, cut: bool) -> list[tuple[int, tuple[tuple[int, ...], ...]]]:
    """A plan for ``left[length]`` pieces of each length, longest first; ``left`` is used up."""
    plan = []
    while left.any():
        parts, room = [], window
        free = left.copy()
        while room and (fits := np.flatnonzero(free[: room + 1])).size:
            n = int(fits[-1])
            k = min(int(free[n]), room // n)
            parts.append((n, k))
            free[n] -= k
            room -= n * k
        if cut and room and (longer := np.flatnonzero(free)).size:
            parts.append((int(longer[-1]), 1, room))
        need: dict[int, int] = {}
        for n, k, *_ in parts:
            need[n] = need.get(n, 0) + k
        times = min(int(left[n]) // k for n, k in need.items())
        plan.append((times, tuple(parts)))
        for n, k, *size in parts:
            left[n] -= times * k
            if size:
                left[n - size[0]] += times
    return plan


def plan_windows(counts: dict[int, int], window: int = 1024, cut: bool = False) -> list[tuple[int, tuple[tuple[int, ...], ...]]]:
    """``(times, ((length, number), ...))``: windows with these pieces, that many times; every piece is used once.

    With ``cut``, ``(length, 1, size)`` is a piece of which the first ``size`` ids are placed and the others are a piece
    of length - size from there on.
    """
    left = np.zeros(window + 1, np.int64)
    for length, number in counts.items():
        left[length] = number
    whole = int(left[window])
    left[window] = 0
    plan = [(whole, ((window, 1),))] if whole else []
    if left.any():
        patterns = combinations(window)
        patterns = patterns[patterns[:, 0] < window]
        patterns = patterns[((left[patterns] > 0) | (patterns == 0)).all(axis=1)]
        # Rounded to the nearest, used most first, and never more than what is left of a length.
        x = repeat_counts(left.astype(float), patterns) if len(patterns) else np.zeros(0)
        for at in np.argsort(-x, kind="stable"):
            if x[at] + ROUND < 1:
                break
            parts = tuple(sorted(((int(n), int((patterns[at] == n).sum())) for n in set(patterns[at].tolist()) - {0}), reverse=True))
            times = min([int(x[at] + ROUND), *(int(left[n]) // k for n, k in parts)])
            if times:
                plan.append((times, parts))
                for n, k in parts:
                    left[n] -= times * k
    rest = pack_left(left.copy(), window, False)
    least = -(-sum(n * k for n, k in counts.items()) // window)
    if cut and sum(times for times, _ in plan + rest) > least * (1 + PADDING) + 1:
        rest = pack_left(left, window, True)
    return plan + rest


@dataclass(frozen=True)
class Places:
    """Ranges of piece numbers within a length, in order of ``key`` = length * 2^44 + first number of the range.

    ``size`` ids are placed; ``tail`` is the key of what is left of the first piece of the range.
    """

    key: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    number: np.ndarray
    size: np.ndarray
    tail: np.ndarray

    def _at(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, key, "right") - 1
        inside = key - self.key[at]
        times, which = np.divmod(inside, self.number[at])
        return self.sequence[at] + times, self.offset[at] + which * self.size[at], self.size[at], self.tail[at] + inside

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset, of a cut piece those of its first part."""
        return self._at((length << 44) + rank)[:2]

    def parts(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """``row, begin, size, sequence, offset`` of every part of the pieces; ``begin`` counts ids of the piece."""
        row, key = np.arange(len(length)), (length << 44) + rank
        begin, done = np.zeros(len(length), np.int64), []
        while len(row):
            sequence, offset, size, tail = self._at(key)
            done.append((row, begin, size, sequence, offset))
            more = size < key >> 44
            row, begin, key = row[more], (begin + size)[more], tail[more]
        return tuple(np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 5

    def cut_lengths(self) -> list[int]:
        """Lengths of which a piece is cut."""
        length = self.key >> 44
        return np.unique(length[self.size < length]).tolist()


def lay_out(plan: list[tuple[int, tuple[tuple[int, ...], ...]]]) -> Places:
    rows = []
    used: dict[int, int] = {}
    tails: dict[int, int] = {}  # numbers of the first tails: behind the pieces that are there from the start
    for times, parts in plan:
        for n, k, *size in parts:
            tails[n] = tails.get(n, 0) + times * k
    for times, parts in plan:
        for n, _, *size in parts:
            if size:
                tails[n - size[0]] -= times
    first = 0
    for times, parts in plan:
        at = 0
        for n, k, *size in parts:
            placed, tail = size[0] if size else n, 0
            if size:
                tail = (n - placed << 44) + tails[n - placed]
                tails[n - placed] += times
            rows.append(((n << 44) + used.get(n, 0), first, at, k, placed, tail))
            used[n] = used.get(n, 0) + times * k
            at += placed * k
        first += times
    rows.sort()
    return Places(*(np.array(x, np.int64) for x in zip(*rows))) if rows else Places(*[np.zeros(0, np.int64)] * 6)


def pack_pieces(pieces: DataFrame, window: int = 1024) -> DataFrame:
    """``pieces`` (any columns, among them ``length`` of 1 to ``window``) with ``sequence_id`` and ``offset`` added.

    Sequences are numbered from 0, the pieces of one lie next to each other from offset 0, and none exceeds the window.
    Rows of the same length are interchangeable, so repeated rows are all placed. An empty table gives an empty result.
    Where whole pieces would leave much padding, those with ``start`` and ``ids`` are cut: a row for each part, with its
    own ``start``, ``length``, ``ids`` and, where there is one, ``ids_crc32``. Pieces without those columns stay whole.
    """
    spark = pieces.sparkSession
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    placed = stable(pieces.select(*columns).withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33).alias("_part")
    numbers = stable(placed.groupBy(part, "length").agg(F.count("*").alias("number")))
    counts = {r["length"]: r["number"] for r in numbers.groupBy("length").agg(F.sum("number").alias("number")).collect()}
    laid = lay_out(plan_windows(counts, window, {"start", "ids"} <= set(columns)))
    places = spark.sparkContext.broadcast(laid)
    if "ids" in columns and "ids_crc32" in columns:  # the ids are only there to be cut
        needed = F.when(F.col("length").isin(laid.cut_lengths()), F.col("ids")) if laid.cut_lengths() else F.lit(None).cast("binary")
        placed = placed.withColumn("ids", needed)
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = numbers.select("_part", "length", F.coalesce(F.sum("number").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_part", "length").orderBy("_row")
    ranked = placed.withColumn("_part", part).withColumn("_rank", F.row_number().over(within).cast("long") - 1)
    ranked = ranked.join(bases, ["_part", "length"]).select(*columns, (F.col("_base") + F.col("_rank")).alias("_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            row, begin, size, sequence, offset = places.value.parts(length, batch.column("_rank").to_numpy())
            kept = {name: batch.column(name) for name in columns}
            if len(row) > batch.num_rows or (size < length[row]).any():
                kept = {name: column.take(pa.array(row)) for name, column in kept.items()}
                cut = np.flatnonzero(size < length[row])
                ids = kept["ids"].to_pylist()
                for at in cut:
                    ids[at] = ids[at][4 * begin[at] : 4 * (begin[at] + size[at])]
                kept["ids"] = pa.array(ids, kept["ids"].type)
                kept["start"] = pa.array(kept["start"].to_numpy() + begin, kept["start"].type)
                kept["length"] = pa.array(size, kept["length"].type)
                if "ids_crc32" in kept:
                    sums = kept["ids_crc32"].to_numpy().copy()
                    sums[cut] = [zlib.crc32(ids[at]) for at in cut]
                    kept["ids_crc32"] = pa.array(sums, kept["ids_crc32"].type)
            yield pa.RecordBatch.from_arrays([*kept.values(), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    schema = pieces.select(*columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    return ranked.mapInArrow(run, schema)


def packed_sequences(placed: DataFrame, window: int = 1024, pad: int = END) -> DataFrame:
    """``sequence_id, ids, filled``: the ids of each sequence, padded to the window unless ``filled`` is a power of two."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("offset")
        ids = np.frombuffer(b"".join(rows["ids"]), "<u4").astype(np.int64)
        filled = len(ids)
        if filled & (filled - 1):
            ids = np.concatenate([ids, np.full(window - filled, pad, np.int64)])
        return pd.DataFrame({"sequence_id": [rows["sequence_id"].iloc[0]], "ids": [ids], "filled": [filled]})

    return placed.groupBy("sequence_id").applyInPandas(join, "sequence_id long, ids array<long>, filled long")


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 1024) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece of ``docs``.

    The ids themselves go no further than their checksum and the cuts; take ``token_pieces``, ``pack_pieces`` and
    ``packed_sequences`` for the sequences.
    """
    pieces = token_pieces(docs, tokenizer, window)
    checked = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "ids")
    return pack_pieces(checked, window).drop("ids")
