"""Calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trip_date(moment: Column) -> Column:
    return F.to_date(moment)


def monday_based_weekday(moment: Column) -> Column:
    """0 for Monday up to 6 for Sunday."""
    return F.weekday(moment)
