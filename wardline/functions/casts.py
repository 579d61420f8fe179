"""Text to typed values: lenient (bad text becomes a default) and strict (bad text fails)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number, and the timestamp layout of the feeds.
# ``\z`` and not ``$``: the latter would let a trailing line break through.
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
SPECIAL_TEXT = r"^([+-]?(?i:inf|infinity)|(?i:nan))\z"
INTEGER_TEXT = r"^[+-]?[0-9]+\z"
ZIP_TEXT = r"^[0-9]{5}(-?[0-9]{4})?\z"
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS"
TIMESTAMP_LENGTH = 23

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def double_or_null(text: Column) -> Column:
    """Number text as double; NULL where it is not a number.

    The guard is needed because ``try_cast`` alone also takes ``' 5 '`` and ``'1.0d'``.
    """
    is_number = text.rlike(DECIMAL_TEXT) | text.rlike(SPECIAL_TEXT)
    return F.when(is_number, text.try_cast("double"))


def lenient_double(text: Column) -> Column:
    """Number text as double; blank, malformed or missing becomes 0.0."""
    return F.coalesce(double_or_null(text), F.lit(0.0))


def long_or_null(text: Column) -> Column:
    """Integer text as bigint; NULL where malformed; out of range stops at the limit."""
    limit = F.when(text.startswith("-"), F.lit(LONG_MIN)).otherwise(F.lit(LONG_MAX))
    return F.when(text.rlike(INTEGER_TEXT), F.coalesce(text.try_cast("bigint"), limit))


def lenient_long(text: Column) -> Column:
    """Integer text as bigint; blank, malformed (``'12.0'``, ``' 5 '``) or missing becomes 0."""
    return F.coalesce(long_or_null(text), F.lit(0).cast("bigint"))


def timestamp_or_null(text: Column) -> Column:
    """``2023-01-01T00:00:00.000`` read as UTC; NULL where the layout does not fit."""
    parsed = F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(TIMESTAMP_PATTERN + "X"))
    return F.when(F.length(text) == TIMESTAMP_LENGTH, parsed)


def lenient_timestamp(text: Column) -> Column:
    """As :func:`timestamp_or_null`, with the first instant of year 1 as the default."""
    return F.coalesce(timestamp_or_null(text), F.expr("TIMESTAMP '0001-01-01 00:00:00Z'"))


def strict_timestamp(text: Column) -> Column:
    """Any ISO date-time as a zoneless timestamp; malformed text fails the query."""
    return F.to_timestamp_ntz(text)


def strict(text: Column, kind: str) -> Column:
    """ANSI cast: malformed text fails the query. Blanks around a number are malformed too."""
    bad = F.raise_error(F.concat(F.lit(f"not a valid {kind}: "), text))
    guard = INTEGER_TEXT if kind in ("int", "bigint") else f"({DECIMAL_TEXT})|({SPECIAL_TEXT})"
    return F.when(text.isNull() | text.rlike(guard), text.cast(kind)).otherwise(bad.cast(kind))


def in_int_range(value: Column) -> Column:
    """Does the bigint fit a 32-bit column?"""
    return value.between(INT_MIN, INT_MAX)


def five_digit_zip(text: Column) -> Column:
    """``60666-1234`` and ``606661234`` become ``60666``; anything else stays as it is."""
    return F.when(text.rlike(ZIP_TEXT), F.substring(text, 1, 5)).otherwise(text)
