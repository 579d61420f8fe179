"""Keyed loads: which row of a key is kept, and what happens to the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import stable


class DuplicateKeyError(ValueError):
    """A load that must be unique on its key is not."""


def _position(key: Sequence[str], order: Sequence[str | Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*key).orderBy(*order))


def keyed_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of every key in the given order.

    The rank filter plans as a group limit on both sides of the shuffle: each
    task keeps one row per key before sending, so a key with a third of all rows
    puts one row per task on the wire.
    """
    return (
        df.withColumn("_position", _position(key, order))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def keyed_first_of_few(df: DataFrame, key: Sequence[str], sequence: str, limit: int = 1 << 20) -> DataFrame:
    """The same of a written frame in which few keys repeat: only the rows of such keys are shuffled.

    Keys are counted by their hash, eight bytes a row. Hashes that come more than once go to all tasks, up to ``limit``
    of them; a key that shares its hash with another is merely shuffled as well. Beyond the limit every row is.
    """
    hashed = F.xxhash64(*key)
    repeated = stable(df.groupBy(hashed.alias("_key")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_key"))
    count = repeated.count()
    if count == 0:
        return df
    if count > limit:
        return keyed_first(df, key, [sequence])
    named, side = df.withColumn("_key", hashed), F.broadcast(repeated)
    once, again = (named.join(side, "_key", how).drop("_key") for how in ("left_anti", "left_semi"))
    return once.unionByName(keyed_first(again, key, [sequence]))


def keyed_rejects(df: DataFrame, key: Sequence[str], sequence: str) -> DataFrame:
    """The rows :func:`keyed_first` leaves out, for the reject table.

    ``sequence`` is unique per row. The anti join runs on it and not on the key,
    so no task ever holds all rows of a frequent key.
    """
    kept = keyed_first(df.select(*key, sequence), key, [sequence]).select(sequence)
    return df.join(kept, sequence, "left_anti")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def require_unique(df: DataFrame, key: Sequence[str], table: str) -> DataFrame:
    """Fail the load when a key repeats; otherwise hand the rows back unchanged."""
    sample = duplicate_keys(df, key).limit(5).collect()
    if sample:
        shown = ", ".join(str(row.asDict()) for row in sample)
        raise DuplicateKeyError(f"{table}: duplicate key {list(key)}: {shown}")
    return df
