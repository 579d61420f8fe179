"""A quality classifier on random-indexing word vectors.

1. Every word (or run of punctuation) falls into one of ``BUCKETS`` buckets by its CRC-32 and has a sparse random index
   vector: a few entries of +1 and -1. The vector of a bucket is the sum of the index vectors of the words found next
   to it anywhere in the corpus, up to ``REACH`` words away. All documents count; a task sums in a table of fixed size
   and the tables are added up by bucket, so what is gathered follows the number of tasks and what comes to the driver
   is one table of fixed size.
2. A document is pooled to the mean and the spread of its word vectors and the likeness of neighbouring ones.
3. A two-layer network in numpy learns from at most ``TRAIN_ROWS`` labelled rows (chosen by a hash of the id), and one
   temperature, fitted on a fifth of those rows that the network did not learn from, turns its output into probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import column_bytes
from wardline.session import stable

BUCKETS = 1 << 14
WIDTH = 32
ENTRIES = 4
REACH = 2
BLOCK = 256
TRAIN_ROWS = 20_000
HIDDEN = 32
EPOCHS = 40
THRESHOLD = 0.3
FOLDS = 5

WORDS = re.compile(r"\w+|[^\w\s]+").findall


class BucketOf(dict):
    """Buckets of words already met; emptied when it grows large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = bucket = zlib.crc32(word.encode()) % BUCKETS
        return bucket


def word_buckets(text: bytes, bucket_of: BucketOf) -> np.ndarray:
    words = WORDS(text.decode())
    return np.fromiter(map(bucket_of.__getitem__, words), np.int64, len(words))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each bucket's index vector."""
    draw = np.random.default_rng(7)
    return draw.integers(0, WIDTH, (BUCKETS, ENTRIES)), draw.choice([-1, 1], (BUCKETS, ENTRIES))


def _add_contexts(table: np.ndarray, words: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add the index vectors of the neighbours of each word; -1 in ``words`` parts documents."""
    for step in range(1, REACH + 1):
        for here, there in ((words[:-step], words[step:]), (words[step:], words[:-step])):
            both = (here >= 0) & (there >= 0)
            here, there = here[both] * WIDTH, there[both]
            for n in range(ENTRIES):
                table += np.bincount(here + places[there, n], signs[there, n], BUCKETS * WIDTH).astype(np.int64)


def context_table(docs: DataFrame) -> np.ndarray:
    """The summed neighbours of every bucket over all rows of ``docs``: ``BUCKETS`` x ``WIDTH`` integers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        table, bucket_of = np.zeros(BUCKETS * WIDTH, np.int64), BucketOf()
        held: list[np.ndarray] = []
        gap = np.full(REACH, -1)
        size = 0
        for batch in batches:
            for text in column_bytes(batch, "text"):
                words = word_buckets(text, bucket_of)
                held += [words, gap]
                size += len(words)
                if size > 1 << 20:
                    _add_contexts(table, np.concatenate(held), places, signs)
                    held, size = [], 0
        if held:
            _add_contexts(table, np.concatenate(held), places, signs)
        blocks = table.reshape(-1, BLOCK * WIDTH)
        used = np.flatnonzero(blocks.any(axis=1))
        packed = pa.array([blocks[n].astype("<i8").tobytes() for n in used], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), packed], names=["block", "sums"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist()):
                found = np.frombuffer(packed, "<i8")
                totals[block] = totals[block] + found if block in totals else found
        packed = pa.array([x.tobytes() for x in totals.values()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), packed], names=["block", "sums"])

    schema = "block long, sums binary"
    # Two rounds: what many tasks hold of one block is added up in several places first.
    partial = docs.select("text").mapInArrow(sums, schema).withColumn("part", F.spark_partition_id() % 8)
    partial = partial.repartition("block", "part").select("block", "sums").mapInArrow(total, schema)
    table = np.zeros((BUCKETS // BLOCK, BLOCK * WIDTH), np.int64)
    for row in partial.repartition("block").mapInArrow(total, schema).collect():
        table[row["block"]] = np.frombuffer(row["sums"], "<i8")
    return table.reshape(BUCKETS, WIDTH)


def word_vectors(table: np.ndarray) -> np.ndarray:
    """Unit vectors of the buckets, without the direction that all share; never met: zero."""
    length = np.linalg.norm(table, axis=1, keepdims=True)
    vectors = np.where(length > 0, table / np.maximum(length, 1), 0.0)
    vectors -= vectors[length[:, 0] > 0].mean(axis=0) if (length > 0).any() else 0.0
    vectors[length[:, 0] == 0] = 0.0
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(words: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors and the likeness of neighbours; no words: zeros."""
    if not len(words):
        return np.zeros(2 * WIDTH + REACH + 1, np.float32)
    found = vectors[words]
    mean = found.mean(axis=0)
    spread = np.sqrt(np.maximum(np.square(found).mean(axis=0) - mean * mean, 0))
    like = [np.einsum("ij,ij->", found[n:], found[:-n]) / (len(words) - n) if len(words) > n else 0.0 for n in range(1, REACH + 1)]
    return np.concatenate([mean, spread, like, [np.linalg.norm(mean)]]).astype(np.float32)


@dataclass(frozen=True)
class Network:
    """Two layers on standardised features, and the temperature of the output."""

    shift: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    second: np.ndarray
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.shift) / self.scale, -8, 8)
        hidden = np.tanh(x @ self.first[:-1] + self.first[-1])
        return hidden @ self.second[:-1] + self.second[-1]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -30, 30)))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def train(features: np.ndarray, labels: np.ndarray) -> Network | None:
    """A network for the labels 0 and 1, the same for the same rows in the same order; None without rows."""
    if not len(labels):
        return None
    held = np.arange(len(labels)) % FOLDS == FOLDS - 1
    x, y = features[~held].astype(np.float64), labels[~held].astype(np.float64)
    draw = np.random.default_rng(11)
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    first = np.vstack([draw.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN)])
    second = np.append(draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), 0.0)
    parts = [first, second]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    x = np.clip((x - shift) / scale, -8, 8)
    step = 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(y))
        for at in range(0, len(y), 256):
            rows = order[at : at + 256]
            ones = np.ones((len(rows), 1))
            hidden = np.hstack([np.tanh(x[rows] @ first[:-1] + first[-1]), ones])
            error = (1 / (1 + np.exp(-np.clip(hidden @ second, -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, second[:-1]) * (1 - hidden[:, :-1] ** 2)
            slopes = [np.hstack([x[rows], ones]).T @ back + 1e-4 * first, hidden.T @ error + 1e-4 * second]
            step += 1
            rate = 3e-3 * (1 - epoch / EPOCHS)
            for part, slope, (m, v) in zip(parts, slopes, moments):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                part -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    network = Network(shift, scale, first, second, 1.0)
    if held.any():
        logits = network.logits(features[held])
        choices = np.geomspace(0.25, 8, 61)
        best = min(choices, key=lambda t: _loss(logits / t, labels[held]))
        network = Network(shift, scale, first, second, float(best))
    return network


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text is divisible by 5; null id: no."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _doc_features(batch: pa.RecordBatch, vectors: np.ndarray, bucket_of: BucketOf) -> np.ndarray:
    found = [pooled(word_buckets(text, bucket_of), vectors) for text in column_bytes(batch, "text")]
    return np.stack(found) if found else np.zeros((0, 2 * WIDTH + REACH + 1), np.float32)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network | None]:
    """Word vectors from all of ``docs`` and the network from labelled rows that are not held out."""
    spark = docs.sparkSession
    vectors = word_vectors(context_table(docs))
    sent = spark.sparkContext.broadcast(vectors)
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    sample = stable(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = BucketOf()
        for batch in batches:
            rows = [x.tobytes() for x in _doc_features(batch, sent.value, bucket_of)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.binary())], names=["doc_id", "quality", "features"]
            )

    # At most train_rows ids: a bounded side.
    taught = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")
    schema = taught.select("doc_id", "quality", F.lit(b"").alias("features")).schema
    # Rows that repeat an id teach once.
    rows = taught.mapInArrow(features, schema).groupBy("doc_id").agg(F.min(F.struct("features", "quality")).alias("r"))
    rows = rows.select(F.xxhash64("doc_id").alias("h"), "doc_id", "r.*").orderBy("h", "doc_id").collect()
    x = np.array([np.frombuffer(r["features"], np.float32) for r in rows])
    return vectors, train(x, np.array([r["quality"] for r in rows], np.int64))


def score_documents(
    docs: DataFrame, labels: DataFrame, keep: Sequence[str] = ("doc_id",), train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """The columns ``keep`` and ``score`` of every row of ``docs``: the probability of label 1, from the text alone.

    Null and empty texts are scored as a document without words. Without any label to learn from every score is 0.5.
    Null ids and labels other than 0 and 1 teach nothing; an id with several labels counts by its majority; repeated
    rows get the same score; an empty table gives an empty result.
    """
    vectors, network = fit(docs, labels, train_rows)
    sent = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = BucketOf()
        vectors, network = sent.value
        for batch in batches:
            features = _doc_features(batch, vectors, bucket_of)
            scores = network.scores(features) if network else np.full(len(features), 0.5)
            kept = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], names=[*keep, "score"])

    columns = list(dict.fromkeys([*keep, "text"]))
    schema = docs.select(*keep, F.lit(0.5).cast("double").alias("score")).schema
    return docs.select(*columns).mapInArrow(run, schema)


def judge_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    scored = score_documents(docs, labels)
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, columns: Sequence[str], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    return score_documents(docs, labels, columns).where(F.col("score") >= threshold).select(*columns)
