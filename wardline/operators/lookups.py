"""Joins with dimension tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is sent to every executor only below this measured size.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame) -> Column:
    total = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(column), F.lit(0)) + F.lit(8)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            total = total + F.lit(8)
    return total.cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame in memory, measured by one distributed sum."""
    return df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0).cast("bigint")).alias("n")).first()["n"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast a side whose measured size is below the limit.

    Above it the frame comes back without a hint: the join is then shuffled, and
    adaptive execution splits the partitions of frequent keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def last_match(dim: DataFrame, key: str, order: Sequence[Column] | Column) -> DataFrame:
    """One row per key: the last one in the given order.

    This makes the key unique, so a join with it never multiplies rows. Rows are
    compared through a plain maximum, which combines on the map side.
    """
    rank = F.struct(*order) if isinstance(order, (list, tuple)) else order
    others = [c for c in dim.columns if c != key]
    winner = F.max_by(F.struct(*others), rank).alias("_last")
    return dim.groupBy(key).agg(winner).select(key, *[F.col(f"_last.{c}").alias(c) for c in others])


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    df_key: str,
    dim_key: str,
    outputs: Mapping[str, tuple[str, object]],
    unknown: object | None = None,
) -> DataFrame:
    """Left join with a dimension that is unique on its key.

    The caller decides about broadcasting once per dimension, with
    :func:`broadcast_if_small`; the hint stays in force for every join with it.
    ``outputs`` maps a new column to (dimension column, default without a match).
    ``unknown`` is a key value that stands for "no zone" and never matches.
    """
    picked = dim.select(
        F.col(dim_key).alias("_key"), *[F.col(source).alias(name) for name, (source, _) in outputs.items()]
    ).filter(F.col("_key").isNotNull())
    if unknown is not None:
        picked = picked.filter(F.col("_key") != F.lit(unknown))
    joined = df.join(picked, df[df_key] == F.col("_key"), "left").drop("_key")
    filled = {
        name: F.coalesce(F.col(name), F.lit(default)) for name, (_, default) in outputs.items() if default is not None
    }
    return joined.withColumns(filled) if filled else joined


def in_any(df: DataFrame, df_key: str, allowed: DataFrame, allowed_key: str) -> DataFrame:
    """Keep the rows whose key occurs in the other frame, without multiplying them."""
    keys = allowed.select(F.col(allowed_key).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    return df.join(broadcast_if_small(keys), df[df_key] == F.col("_key"), "left_semi")
