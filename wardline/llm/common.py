"""Small helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import stable

#: White space of the word rules: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(column, UPPER, UPPER.lower())


#: Two numbers that tell the rows of a frame apart.
PLACE = ("place_file", "place_row")


def with_place(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns with ``PLACE``, the same in every job, whatever executors there are and however files are split.

    The place is the file and the position in it. A frame that is not read straight from files, or in which a row of a
    file occurs more than once, is written to the shared folder first.
    """
    place = [F.xxhash64("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1])]
    try:
        placed = df.select(*columns, *place)
        if placed.groupBy(*PLACE).count().where("count > 1").isEmpty():
            return placed
    except AnalysisException:  # no metadata: not read from files
        pass
    return stable(df.select(*columns)).select(*columns, *place)


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACES)), F.lit(0)).cast("long")


def unit(hashed: Column) -> Column:
    """A number strictly between 0 and 1 from a 64-bit hash."""
    return (F.shiftrightunsigned(hashed, 12).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def column_bytes(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """The texts of a column in UTF-8, one at a time; null is empty."""
    for value in batch.column(name):
        yield value.as_buffer().to_pybytes() if value.is_valid else b""


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often or deep in lambdas ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Arrays are folded in runs of so many elements: a fold copies what it has gathered for every element.
RUN = 64


def running(values: Column, zero: Column, add: Callable[[Column, Column], Column], kind: str) -> Column:
    """For each element of an array of ``kind`` the sum, by ``add``, of all elements up to it.

    ``add`` is associative and ``zero`` adds nothing. Linear for arrays of up to some ten thousand elements and nearly so
    beyond: every run is folded by itself, then what the runs before it add up to is added.
    """
    start = F.array(zero).cast(f"array<{kind}>")

    def fold(array: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(array, start, lambda done, x: F.concat(done, F.array(add(F.element_at(done, -1), of(x)))))

    def runs(whole: Column) -> Column:
        last = F.floor((F.size(whole) - 1) / F.lit(RUN)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda n: fold(F.slice(whole, n * RUN + 1, F.lit(RUN)), lambda x: x))

    def joined(parts: Column) -> Column:
        before = F.slice(fold(parts, lambda part: F.element_at(part, -1)), F.lit(1), F.size(parts))
        return F.flatten(F.zip_with(parts, before, lambda part, b: F.transform(F.slice(part, F.lit(2), F.lit(RUN)), lambda x: add(b, x))))

    found = bound(values, lambda whole: F.when(F.size(whole) > 0, bound(runs(whole), joined)))
    return F.coalesce(found, F.array().cast(f"array<{kind}>"))


def match_places(text: Column, pattern: Column) -> Column:
    """``start, stop, value`` of the leftmost non-overlapping matches of a pattern that matches no empty text.

    Offsets count code points from 0: sums over the lengths of what lies between the matches and of the matches.
    """
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, pattern), F.length)

    def placed(steps: Column) -> Column:
        stops = running(F.transform(steps, lambda s: s["gap"] + F.length(s["value"])), F.lit(0), lambda a, b: a + b, "int")
        return F.zip_with(
            steps, stops, lambda s, stop: F.struct((stop - F.length(s["value"])).alias("start"), stop.alias("stop"), s["value"].alias("value"))
        )

    steps = bound(
        values,
        lambda found: F.zip_with(
            F.slice(gaps, F.lit(1), F.size(found)), found, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value"))
        ),
    )
    return bound(steps, placed)


def pieces(text: Column, size: int) -> Column:
    """A text in pieces of ``size`` code points, so that a place far into it is reached at once."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def between(cut: Column, size: int, start: Column, stop: Column) -> Column:
    """The code points from ``start`` to ``stop`` of a text in pieces."""
    first, last = (F.floor(at / F.lit(size)).cast("int") for at in (start, stop))
    inside = F.substring(F.get(cut, first), start % size + 1, stop - start)
    across = F.concat(
        F.substring(F.get(cut, first), start % size + 1, F.lit(size)),
        F.array_join(F.slice(cut, first + 2, last - first - 1), ""),
        F.coalesce(F.substring(F.get(cut, last), F.lit(1), stop % size), F.lit("")),
    )
    return F.when(start >= stop, "").when(first == last, inside).otherwise(across)
