"""Rounding, estimates and number-to-text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column) -> Column:
    """Nearest whole number, ties away from zero, staying in plain double arithmetic."""
    nearest = F.rint(value)
    tie = F.abs(value - nearest) == 0.5
    return F.when(tie, value + F.signum(value) * 0.5).otherwise(nearest)


def snap_half_away(degrees: Column, steps: int = 1000) -> Column:
    """Snap a coordinate to a grid of 1/steps, ties away from zero."""
    return round_half_away(degrees * F.lit(float(steps))) / F.lit(float(steps))


def snap_half_even(degrees: Column, steps: int = 1000) -> Column:
    """Snap a coordinate to a grid of 1/steps, ties to the even neighbour."""
    return F.rint(degrees * F.lit(float(steps))) / F.lit(float(steps))


def estimated_cases(share_positive: Column, tests: Column) -> Column:
    """Share of positive tests times tests, to the nearest whole case; NULL if not a finite count."""
    return round_half_away(share_positive * tests).try_cast("bigint")


def coordinate_key(latitude: Column, longitude: Column) -> Column:
    """``lat,lon`` as text. Equal to the shortest decimal form from 0.001 up to 10 million."""
    return F.concat(latitude.cast("string"), F.lit(","), longitude.cast("string"))


def six_decimals(degrees: Column) -> Column:
    """Fixed six-decimal text of a coordinate."""
    return F.format_string("%.6f", degrees)
