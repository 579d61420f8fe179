"""Scores of texts by context-tree weighting over bytes, beside the unigram score of their words.

A byte is eight binary decisions, first bit first. A decision is predicted from the bits of its byte so far and from the
bytes before: a node of the tree for every depth 0 to ``DEPTH``. A node with a zeros and b ones has the Krichevsky-
Trofimov estimate of its sequence, KT(a, b), and the weight

    P(node) = (KT(a, b) + product of P(its longer contexts)) / 2,        at the deepest level KT(a, b).

The probability of a bit is the mean of the estimates (b + 1/2) / (a + b + 1) on the way down, weighted by how much of
P each owes to its own estimate. Contexts that no training text holds have no estimate: the mixture ends above them.

1. Every block of documents is reduced to its distinct byte strings of ``DEPTH + 1`` and its distinct words, with their
   counts in training texts (0 for those of other texts only). What is gathered follows the documents.
2. The counts are added up over the blocks and dealt by the last two bytes of context, so that a task holds whole
   subtrees, in sorted order; all levels below the first are weighted there. Of the two levels on top, 65,535 nodes at
   most, the sums come to the driver.
3. Each byte string gets its probability once and goes back to the blocks that hold it; there every text is the sum of
   its byte strings. Tables are those of one block, whatever the size of the corpus; documents stream past them.

Texts are lower-cased (A-Z) bytes of UTF-8 between two edges, which count as a byte that UTF-8 never has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import with_place
from wardline.session import stable

DEPTH = 5
TOP = 2
EDGE = b"\xff"
BLOCK_BYTES = 32 << 20
#: Texts are taken together to about so many bytes, their words to WORD_CHUNK; what was gathered is given out beyond HELD rows.
CHUNK = 1 << 20
WORD_CHUNK = 1 << 23
HELD = 1_500_000
GROUP_ROWS = 500_000
SLOT_ROWS = 1 << 18
FOLDS, HELD_OUT = 7, 2

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
END = b" "
LONG_WORD = 64


def lowered(texts: pa.Array) -> pa.Array:
    """Texts with A-Z in lower case; null is empty."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = filled.buffers()
    ends = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1] if len(filled) else np.zeros(1, np.int64)
    low = bytes(memoryview(data)[ends[0] : ends[-1]]).translate(LOWER) if data else b""
    return pa.LargeStringArray.from_buffers(len(filled), pa.py_buffer(np.ascontiguousarray(ends - ends[0])), pa.py_buffer(low))


def chunks(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Rows together to about ``size`` bytes, at least one."""
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
    start = 0
    while start < len(texts):
        stop = max(int(np.searchsorted(ends, ends[start] + size)), start + 1)
        yield texts.slice(start, stop - start)
        start = stop


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of lower-cased texts, each text closed by its end, and the number of the text of each.

    A word of more than ``LONG_WORD`` bytes goes by its hash, which no shorter one can be.
    """
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten().cast(pa.large_binary())
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    if (sizes == 0).any():
        words, owner, sizes = words.filter(pa.array(sizes > 0)), owner[sizes > 0], sizes[sizes > 0]
    if (sizes > LONG_WORD).any():
        named = [b"#" + hashlib.sha512(w).digest() if len(w) > LONG_WORD else w for w in words.to_pylist()]
        words = pa.array(named, pa.large_binary())
    ends = pa.array([END] * len(texts), pa.large_binary())
    return pa.concat_arrays([words, ends]), np.concatenate([owner, np.arange(len(texts))])


def codes_of(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings of all texts as numbers, and where those of each text begin.

    The last byte of context is the highest, then those before it, then the byte that is predicted, so that numbers in
    order keep the contexts of a subtree together.
    """
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    edge = EDGE * (depth + 1)
    # One edge closes a text, the others open the next one.
    data = EDGE * depth + edge.join(text.as_buffer().to_pybytes() for text in texts) + EDGE + bytes(8)
    windows = np.ndarray((len(data) - 8 - depth,), "<u8", data, strides=(1,))
    context, bits = np.uint64((1 << 8 * depth) - 1), np.uint64(8 * depth)
    codes = ((windows & context) << np.uint64(8)) | ((windows >> bits) & np.uint64(255))
    starts = np.concatenate([[0], np.cumsum(sizes + 1 + depth)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
    if len(starts) > 1:
        # Windows that reach from one text into the next are none.
        inside = np.ones(len(codes), bool)
        for back in range(1, depth + 1):
            inside[starts[1:] - back] = False
        codes = codes[inside]
    return codes.view(np.int64), np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64) if len(sizes) else starts


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers and their summed counts from sorted lists; a stable sort merges what is in order already."""
    every, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every = every[order]
    starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    return every[starts], np.add.reduceat(n[order], starts) if len(starts) else n


def lgamma(x: np.ndarray) -> np.ndarray:
    """The logarithm of the gamma function for x >= 1/2, by Stirling's series eight steps up."""
    up = x + 8
    series = (up - 0.5) * np.log(up) - up + 0.5 * np.log(2 * np.pi) + (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / up**2) / up**2) / up**2) / up
    return series - sum(np.log(x + n) for n in range(8))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    found = lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1.0) - np.log(np.pi)
    return np.where(zeros + ones > 0, found, 0.0)


@dataclass
class Bits:
    """For one depth and one bit of the byte: the nodes, and what each string finds at its own."""

    starts: np.ndarray
    values: np.ndarray
    total: np.ndarray
    ones: np.ndarray
    weight: np.ndarray
    estimate: np.ndarray
    own: np.ndarray
    seen: np.ndarray


def _mixed(estimate: np.ndarray, own: np.ndarray, below: np.ndarray, seen_below: np.ndarray) -> np.ndarray:
    """``own``: the logarithm of the node's own estimate over that of its longer contexts."""
    share = 1 / (1 + np.exp(-np.clip(own, -700, 700)))
    return np.where(seen_below, share * estimate + (1 - share) * below, estimate)


def _level(keys: np.ndarray, counts: np.ndarray, bit: int, below: np.ndarray | None) -> Bits:
    """The nodes of one depth that predict ``bit``; ``below`` has the weights of their longer contexts, multiplied."""
    nodes = keys >> (8 - bit)
    new = np.concatenate([[True], nodes[1:] != nodes[:-1]])
    starts, at = np.flatnonzero(new), np.cumsum(new) - 1
    one = (keys >> (7 - bit)) & 1
    total, ones = np.add.reduceat(counts, starts), np.add.reduceat(counts * one, starts)
    kt = log_kt(total - ones, ones)
    longer = np.zeros(len(starts)) if below is None else below(at, len(starts))
    weight = kt if below is None else np.logaddexp(kt, longer) - np.log(2)
    p = ((ones + 0.5) / (total + 1.0))[at]
    return Bits(starts, nodes[starts], total, ones, weight, np.where(one, p, 1 - p), (kt - longer)[at], (total > 0)[at])


def weigh(codes: np.ndarray, counts: np.ndarray, depth: int) -> tuple[list[Bits], np.ndarray, np.ndarray]:
    """The nodes at depth ``TOP`` (a ``Bits`` for each bit) over sorted distinct strings.

    And for every string and bit the probability by all depths from there on, and whether depth ``TOP`` has an estimate.
    """
    keys, place = codes, np.arange(len(codes))
    bits = [_level(keys, counts, bit, None) for bit in range(8)]
    chance = np.stack([b.estimate for b in bits])
    seen = np.stack([b.seen for b in bits])
    for _ in range(depth - TOP):
        shorter, to = np.unique((keys >> 16 << 8) | (keys & 255), return_inverse=True)
        counts = np.bincount(to, counts).astype(np.int64)
        place = to[place]

        def below(bit: int):
            return lambda at, size: np.bincount(at[to[bits[bit].starts]], bits[bit].weight, size)

        keys, bits = shorter, [_level(shorter, counts, bit, below(bit)) for bit in range(8)]
        chance = np.stack([_mixed(b.estimate[place], b.own[place], chance[n], seen[n]) for n, b in enumerate(bits)])
        seen = np.stack([b.seen[place] for b in bits])
    return bits, chance, seen


@dataclass(frozen=True)
class Crown:
    """The two levels on top. Arrays go by the last byte (level 1 only) and the bits so far, with a one before them."""

    total: np.ndarray
    ones: np.ndarray
    own: np.ndarray
    root_total: np.ndarray
    root_ones: np.ndarray
    root_own: np.ndarray

    @classmethod
    def of(cls, total: np.ndarray, ones: np.ndarray, longer: np.ndarray) -> Crown:
        kt = log_kt(total - ones, ones)
        root_total, root_ones = total.sum(axis=0), ones.sum(axis=0)
        root_kt = log_kt(root_total - root_ones, root_ones)
        return cls(total, ones, kt - longer, root_total, root_ones, root_kt - (np.logaddexp(kt, longer) - np.log(2)).sum(axis=0))

    def log10(self, codes: np.ndarray, chance: np.ndarray, seen: np.ndarray, depth: int) -> np.ndarray:
        """The logarithm of every string's last byte after the others."""
        last, found = codes >> (8 * depth), np.zeros(len(codes))
        for bit in range(8):
            node = (1 << bit) | ((codes & 255) >> (8 - bit))
            one = ((codes >> (7 - bit)) & 1).astype(bool)
            p = (self.ones[last, node] + 0.5) / (self.total[last, node] + 1.0)
            mixed = _mixed(np.where(one, p, 1 - p), self.own[last, node], chance[bit], seen[bit])
            p = (self.root_ones[node] + 0.5) / (self.root_total[node] + 1.0)
            mixed = _mixed(np.where(one, p, 1 - p), self.root_own[node], mixed, self.total[last, node] > 0)
            found += np.log10(mixed)
        return found


class Gathered:
    """Distinct strings and words of one block with their counts in training texts."""

    def __init__(self, depth: int):
        self.depth = depth
        self.codes: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.counts: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.words: list[pa.Table] = []
        self.held = 0

    def add(self, texts: pa.Array, training: bool) -> None:
        for part in chunks(texts, CHUNK):
            codes, counts = np.unique(codes_of(part, self.depth)[0], return_counts=True)
            self.codes.append(codes)
            self.counts.append(counts if training else np.zeros_like(counts))
            self.held += len(codes)
        words = words_of(texts)[0].dictionary_encode()
        counts = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
        self.words.append(pa.table({"word": words.dictionary, "n": counts if training else np.zeros_like(counts)}))
        self.held += len(counts)
        if self.held > HELD:
            self._merge()

    def _merge(self) -> None:
        codes, counts = merged(self.codes, self.counts)
        self.codes, self.counts = [codes], [counts]
        if self.words:
            self.words = [pa.concat_tables(self.words).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])]
        self.held = len(codes) + sum(len(t) for t in self.words)

    @property
    def full(self) -> bool:
        return self.held > HELD

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        self._merge()
        grams = pa.table({"gram": self.codes[0], "word": pa.nulls(len(self.codes[0]), pa.binary()), "n": self.counts[0]})
        words = self.words[0] if self.words else pa.table({"word": pa.array([], pa.large_binary()), "n": pa.array([], pa.int64())})
        words = pa.table({"gram": pa.nulls(len(words), pa.int64()), "word": words["word"].cast(pa.binary()), "n": words["n"]})
        for part in pa.concat_tables([grams, words]).to_batches(max_chunksize=100_000):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), *part.columns], names=["block", *part.schema.names])


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _entries(docs: DataFrame, depth: int) -> DataFrame:
    """``block, gram, word, n``: what the documents of each block hold; a block may name a string twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, Gathered(depth)
        for batch in batches:
            blocks, training = batch.column("block").to_numpy(), batch.column("training").to_numpy(zero_copy_only=False)
            texts = batch.column("text")
            for here in dict.fromkeys(blocks.tolist()):
                if block is not None and here != block:
                    yield from held.rows(block)
                    held = Gathered(depth)
                block = here
                for kind in (True, False):
                    for part in chunks(texts.filter(pa.array((blocks == here) & (training == kind))), WORD_CHUNK):
                        held.add(lowered(part), kind)
                        if held.full:
                            yield from held.rows(block)
                            held = Gathered(depth)
        if block is not None:
            yield from held.rows(block)

    return docs.select("block", "training", "text").mapInArrow(run, "block long, gram long, word binary, n long")


def _whole_groups(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Strings and counts in order, cut between the groups of the last two bytes only."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        codes = np.concatenate([codes, batch.column("gram").to_numpy()])
        counts = np.concatenate([counts, batch.column("n").to_numpy()])
        if len(codes) > GROUP_ROWS:
            end = int(np.searchsorted(codes, codes[-1] >> (8 * (depth - 1)) << (8 * (depth - 1))))
            if end:
                yield codes[:end], counts[:end]
                codes, counts = codes[end:], counts[end:]
    if len(codes):
        yield codes, counts


def _crown(dealt: DataFrame, depth: int) -> Crown:
    """The sums over the second level, by the last byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, ones, longer = np.zeros(1 << 16), np.zeros(1 << 16), np.zeros(1 << 16)
        for codes, counts in _whole_groups(batches, depth):
            for bit, b in enumerate(weigh(codes, counts, depth)[0]):
                node = (b.values >> (8 + bit) << 8) | (1 << bit) | (b.values & ((1 << bit) - 1))
                for sums, values in ((total, b.total), (ones, b.ones), (longer, b.weight)):
                    sums += np.bincount(node, values, 1 << 16)
        used = np.flatnonzero(total)
        columns = [pa.array(used), pa.array(total[used].astype(np.int64)), pa.array(ones[used].astype(np.int64)), pa.array(longer[used])]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "total", "ones", "longer"])

    parts = dealt.mapInArrow(run, "node long, total long, ones long, longer double")
    rows = parts.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("total", "ones", "longer")]).collect()
    arrays = [np.zeros(1 << 16) for _ in range(3)]
    for r in rows:
        for array, name in zip(arrays, ("total", "ones", "longer")):
            array[r["node"]] = r[name]
    return Crown.of(*[a.reshape(256, 256) for a in arrays])


def gram_scores(totals: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``gram, value`` (log10 of the probability of the last byte) of distinct ``gram, n``."""
    dealt = totals.repartition(F.shiftright("gram", 8 * (depth + 1 - TOP))).sortWithinPartitions("gram")
    sent = totals.sparkSession.sparkContext.broadcast(_crown(dealt, depth))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, counts in _whole_groups(batches, depth):
            _, chance, seen = weigh(codes, counts, depth)
            values = sent.value.log10(codes, chance, seen, depth)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(values)], names=["gram", "value"])

    return dealt.mapInArrow(run, "gram long, value double")


class Slots:
    """Values by number: an open table that finds many numbers at once."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.bits = max(int(len(codes) * 2.5).bit_length(), 4)
        self.codes, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits)
        # In pieces, so that what is needed on the way stays small beside the table.
        for start in range(0, len(codes), SLOT_ROWS):
            self._add(codes[start : start + SLOT_ROWS], values[start : start + SLOT_ROWS])

    def _add(self, codes: np.ndarray, values: np.ndarray) -> None:
        left, slot = np.arange(len(codes)), self._slot(codes)
        while len(left):
            free = self.codes[slot] < 0
            self.codes[slot[free]] = codes[left[free]]
            self.values[slot[free]] = values[left[free]]
            # Of several numbers for one slot the last one has it; a number that is there already has its value.
            placed = self.codes[slot] == codes[left]
            self.values[slot[placed]] = values[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        slot = self._slot(codes)
        wrong = np.flatnonzero(self.codes[slot] != codes)
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            wrong = wrong[self.codes[slot[wrong]] != codes[wrong]]
        return self.values[slot]


class Tables:
    """The strings and words of one block."""

    def __init__(self, block: int):
        self.block = block
        self.parts: dict[int, list[tuple]] = {0: [], 1: []}
        self.grams: Slots | None = None

    def add(self, rows: pa.RecordBatch, kind: int) -> None:
        # Copies, so that the batch itself is not kept.
        keys = rows.column("gram").to_numpy().copy() if kind == 0 else pa.array(rows.column("word").to_numpy(zero_copy_only=False), pa.large_binary())
        self.parts[kind].append((keys, rows.column("value").to_numpy().copy()))

    def _ready(self) -> None:
        # What arrived is let go before the table is made.
        codes, values = (np.concatenate(column) for column in zip(*self.parts.pop(0)))
        self.grams = Slots(codes, values)
        del codes, values
        words, counts = zip(*self.parts.pop(1))
        self.words, self.counts = pa.concat_arrays(words), np.concatenate(counts)

    def scores(self, texts: pa.Array, depth: int, floor: float) -> tuple[np.ndarray, ...]:
        """For each text its tokens, the known ones, the score of its words and that of its bytes."""
        if self.grams is None:
            self._ready()
        words, owner = words_of(texts)
        counts = self.counts[pc.index_in(words, value_set=self.words).to_numpy()]
        tokens, known = np.bincount(owner, minlength=len(texts)), np.bincount(owner[counts > 0], minlength=len(texts))
        base = np.bincount(owner, np.log10(counts + 1), len(texts)) - floor * tokens
        bits = []
        for part in chunks(texts, CHUNK):
            codes, starts = codes_of(part, depth)
            bits.append(np.add.reduceat(self.grams[codes], starts))
        return tokens, known, base, np.concatenate(bits)


def score_texts(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    ``score`` is log10 of the probability of the lower-cased text and its end by the context tree, ``base_score`` that of
    its words and its end by their smoothed counts. Both learn from the rows whose id has another remainder than
    ``HELD_OUT``; they are fixed before any text is scored, so the order of rows changes nothing.

    A null text is empty: it is scored for its end alone. A null id is not held out and teaches nothing. Repeated rows
    teach and are scored each. Nothing to learn from: eight even bits a byte, and ``base_score`` 0. Other columns are not
    read. An empty table gives an empty result.
    """
    if not TOP <= depth <= 6:
        raise ValueError("depth must be 2 to 6")
    spark = docs.sparkSession
    rest = remainder(F.col("doc_id"))
    placed = with_place(docs.select("doc_id", "text"), ["doc_id", "text"])
    rows, size = placed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()
    block_rows = max(int(block_bytes * rows // max(size, 1)), 1)
    blocked = placed.select(
        F.xxhash64("place_file", F.floor(F.col("place_row") / block_rows)).alias("block"),
        "doc_id",
        "text",
        F.coalesce(rest == HELD_OUT, F.lit(False)).alias("held_out"),
        F.coalesce(rest != HELD_OUT, F.lit(False)).alias("training"),
    )
    entries = stable(_entries(blocked, depth))

    words = entries.where("word is not null").select("block", "word", "n")
    same = Window.partitionBy("word")
    counted = stable(
        words.select("block", "word", F.sum("n").over(same).alias("c"), (F.row_number().over(same.orderBy("block")) == 1).alias("first"))
    )
    n_training = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    distinct = counted.where("first and c > 0").count()
    floor = float(np.log10(n_training + distinct + 1.0))

    grams = entries.where("gram is not null").select("block", "gram", "n")
    known = stable(gram_scores(stable(grams.groupBy("gram").agg(F.sum("n").alias("n"))), depth))
    found = grams.select("block", "gram").join(known, "gram")

    def null(kind: str) -> Column:
        return F.lit(None).cast(kind)

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    shared = [null(doc_type).alias("doc_id"), null("string").alias("text"), null("boolean").alias("held_out")]
    tables = found.select("block", F.lit(0).alias("kind"), "gram", "value", null("binary").alias("word"), *shared).unionByName(
        counted.select("block", F.lit(1).alias("kind"), null("long").alias("gram"), F.col("c").cast("double").alias("value"), "word", *shared)
    )
    texts = blocked.select(
        "block", F.lit(2).alias("kind"), null("long").alias("gram"), null("double").alias("value"), null("binary").alias("word"), "doc_id", "text", "held_out"
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(blocks)]):
                if start == stop:
                    continue
                own, kind = batch.slice(start, stop - start), kinds[start]
                if held is None or held.block != blocks[start]:
                    held = Tables(blocks[start])
                if kind < 2:
                    held.add(own, kind)
                    continue
                for part in chunks(own.column("text"), WORD_CHUNK):
                    tokens, known, base, bits = held.scores(lowered(part), depth, floor)
                    rows, own = own.slice(0, len(part)), own.slice(len(part))
                    columns = [rows.column("doc_id"), rows.column("held_out"), pa.array(tokens), pa.array(known), pa.array(base), pa.array(bits)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    schema = f"doc_id {doc_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = tables.unionByName(texts).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(score, schema)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_training).cast("long").alias("train_tokens"), "base_score", "score")
