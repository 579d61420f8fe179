"""Whitening of embeddings by a weighted covariance over distinct vectors.

1. Identical integer vectors are grouped; a vector counts by its copies or, for the registered query, once.
2. The sums of every dimension are exact integers: a task adds up in two halves, Spark adds up the tasks as decimals.
3. Each task centres its distinct vectors, weighs them and multiplies them (one GEMM for each batch); the cells of the
   products are added up by Spark. The eigenvectors of this one matrix are found on the driver.
4. Every distinct vector is whitened once and written; the rows get their result by a join on the vector. A vector that
   a third of all rows hold is one row of a written table, so that adaptive execution splits its partition.

A vector's length decides what comes to the driver: its square in doubles. Vectors of different lengths are whitened
among themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.session import stable

SCALE = 256.0
COMPONENTS = 4
#: A component whose share of the variance is below this has none: rounding alone makes such shares.
NO_VARIANCE = 1e-13
LONGEST = 2**63 - 1


@dataclass(frozen=True)
class Whitener:
    """The fit for one length of vectors: components as columns, largest eigenvalue first."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float | None]:
        return [float(v / self.trace) if self.trace > 0 else None for v in self.values]

    def whiten(self, x: np.ndarray) -> list[list[float | None]]:
        """The components of every row of ``x``; null where the fit has no variance."""
        some = self.values > NO_VARIANCE * self.trace
        found = (centred(x, self.n, self.sums) @ self.vectors) / np.sqrt(np.where(some, self.values, 1.0))
        return [[float(v) if ok else None for v, ok in zip(row, some)] for row in found]


def integer_vectors(embeddings: DataFrame, vector: str = "embedding") -> Column:
    """Every component c as floor(256 * c); null unless all of them are finite. Beyond 64 bits: the nearest limit."""
    c = F.col(vector).cast("array<double>")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(finite, F.transform(c, lambda v: F.floor(F.lit(SCALE) * v)))


def matrices(batch: pa.RecordBatch, *others: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length in a batch: its rows' positions and their vectors as one matrix."""
    column = batch.column("x")
    sizes = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(), column.offsets.to_numpy()[:-1]
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, flat[starts[rows, None] + np.arange(size)]


def exceeds(x: np.ndarray, n: int, sums: np.ndarray) -> bool:
    """Whether n * x - sums or its squares may leave 64 bits."""
    most = n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(int(s)) for s in sums) if x.size else 0
    return most * most * x.shape[1] > LONGEST


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x minus the mean, rounded once."""
    if exceeds(x, n, sums):
        return ((x.astype(object) * n - sums) / n).astype(np.float64)
    return (x * n - sums.astype(np.int64)) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The exact sum of (n * x - sums)^2 of every row; null beyond 64 bits."""
    if exceeds(x, n, sums):
        found = ((x.astype(object) * n - sums) ** 2).sum(axis=1)
        return [int(v) if v <= LONGEST else None for v in found]
    moved = x * n - sums.astype(np.int64)
    return np.einsum("ij,ij->i", moved, moved).tolist()


def _totals(distinct: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """For each length the summed weights and the exact weighted sums of every dimension, as Python integers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for size, rows, x in matrices(batch):
                w = weights[rows, None]
                high, low = (w * (x >> 32)).sum(axis=0), (w * (x & 0xFFFFFFFF)).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array(high), pa.array(low)],
                    names=["size", "place", "high", "low"],
                )

    parts = distinct.select("x", "weight").mapInArrow(add, "size int, place int, high long, low long")
    whole = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]
    sums = {}
    for r in parts.groupBy("size", "place").agg(*whole).collect():
        sums.setdefault(r["size"], {})[r["place"]] = (int(r["high"]) << 32) + int(r["low"])
    counts = distinct.groupBy(F.size("x").alias("size")).agg(F.sum("weight").alias("n")).collect()
    return {
        r["size"]: (int(r["n"]), np.array([sums[r["size"]][i] for i in range(r["size"])], object)) for r in counts if r["size"]
    }


def _covariances(distinct: DataFrame, totals: dict[int, tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """The weighted covariance of each length: centred in the tasks, multiplied, added up cell by cell."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for size, rows, x in matrices(batch):
                moved = centred(x, *totals[size])
                products[size] = products.get(size, 0.0) + (moved * weights[rows, None]).T @ moved
        for size, product in products.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array(list(product), pa.list_(pa.float64()))],
                names=["size", "line", "cells"],
            )

    parts = distinct.select("x", "weight").mapInArrow(multiply, "size int, line int, cells array<double>")
    cells = parts.select("size", "line", F.posexplode("cells").alias("place", "value")).groupBy("size", "line", "place").agg(F.sum("value").alias("value"))
    found = {size: np.zeros((size, size)) for size in totals}
    for r in cells.collect():
        found[r["size"]][r["line"], r["place"]] = r["value"] / totals[r["size"]][0]
    return found


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """A whitener for each length of ``distinct`` (``x, weight``)."""
    totals = _totals(distinct)
    fits = {}
    for size, covariance in _covariances(distinct, totals).items():
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        order = np.argsort(-values, kind="stable")[:components]
        vectors = vectors[:, order]
        # Of the two directions that whose largest entry is positive, so that reruns agree.
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
        fits[size] = Whitener(*totals[size], vectors, np.maximum(values[order], 0.0), float(np.trace(covariance)))
    return fits


def _whitened(distinct: DataFrame, fits: dict[int, Whitener]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows, x in matrices(batch):
                one = fits[size]
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        kept.column("x"),
                        kept.column("weight"),
                        pa.array(deviations(x, one.n, one.sums), pa.int64()),
                        pa.array(one.whiten(x), pa.list_(pa.float64())),
                    ],
                    names=["x", "weight", "deviation", "whitened"],
                )

    return distinct.select("x", "weight").mapInArrow(run, "x array<long>, weight long, deviation long, whitened array<double>")


def identity_errors(whitened: DataFrame, fits: dict[int, Whitener]) -> dict[int, float]:
    """For each length how far the covariance of what came out is from the identity: the largest absolute entry.

    Measured on the whitened vectors themselves, centred before multiplying; components without variance do not count.
    """
    errors = {}
    width = max((len(f.values) for f in fits.values()), default=0)
    if not width:
        return errors
    w, z = F.col("weight"), [F.get("whitened", F.lit(i)) for i in range(width)]
    size = F.size("x").alias("size")
    means = whitened.groupBy(size).agg(F.sum(w).alias("n"), *[F.sum(w * z[i]).alias(f"m{i}") for i in range(width)])
    means = {r["size"]: [(r[f"m{i}"] or 0.0) / r["n"] for i in range(width)] for r in means.collect()}
    centres = F.create_map(*[v for s, m in means.items() for v in (F.lit(s), F.array(*map(F.lit, m)))])
    centre = F.element_at(centres, F.size("x"))
    moved = [z[i] - F.get(centre, F.lit(i)) for i in range(width)]
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    products = [(F.sum(w * moved[i] * moved[j]) / F.sum(w)).alias(f"c{i}_{j}") for i, j in pairs]
    for r in whitened.groupBy(size).agg(*products).collect():
        found = [abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c{i}_{j}"] is not None]
        errors[r["size"]] = max(found, default=0.0)
    return errors


def whiten_embeddings(
    embeddings: DataFrame, components: int = COMPONENTS, weights: str = "one", row_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Up to ``components`` rows for every row of ``embeddings`` whose vector has finite entries only.

    ``<row_id>, component`` (from 1, largest eigenvalue first), ``n, deviation, whitened, explained, identity_error``.
    ``weights`` says how a distinct vector counts in the fit: ``one``, or ``copies`` for the number of its rows.

    Rows with a null vector, a null or a non-finite entry are left out, and so are empty vectors, which have no
    component. Null and repeated ids keep their rows. Equal vectors have equal results; vectors of another length are
    fitted and whitened among themselves. A component without variance has ``whitened`` null, and ``explained`` is null
    where nothing varies; ``deviation`` is null beyond 64 bits. Other columns are not read. No rows: an empty result.
    """
    if weights not in ("one", "copies"):
        raise ValueError("weights must be 'one' or 'copies'")
    rows = embeddings.select(F.col(row_id), integer_vectors(embeddings, vector).alias("x")).where("size(x) > 0")
    weight = F.lit(1).cast("long") if weights == "one" else F.count(F.lit(1))
    distinct = stable(rows.groupBy("x").agg(weight.alias("weight")))
    fits = fit(distinct, components)
    whitened = stable(_whitened(distinct, fits))
    errors = identity_errors(whitened, fits)

    def of_size(values: dict[int, Column], kind: str) -> Column:
        pairs = [v for size, value in values.items() for v in (F.lit(size), value)]
        return F.element_at(F.create_map(*pairs), F.size("x")) if pairs else F.lit(None).cast(kind)

    joined = rows.join(whitened.drop("weight"), "x")
    shares = of_size({s: F.array(*map(F.lit, f.explained)).cast("array<double>") for s, f in fits.items()}, "array<double>")
    return joined.select(
        row_id,
        F.posexplode("whitened").alias("place", "whitened"),
        of_size({s: F.lit(f.n).cast("long") for s, f in fits.items()}, "long").alias("n"),
        "deviation",
        shares.alias("shares"),
        of_size({s: F.lit(e) for s, e in errors.items()}, "double").alias("identity_error"),
    ).select(
        row_id,
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get("shares", F.col("place")).alias("explained"),
        "identity_error",
    )
