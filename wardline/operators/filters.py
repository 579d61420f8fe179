"""Row predicates of the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Categories the feeds use.
NEW_CONSTRUCTION = "PERMIT - NEW CONSTRUCTION"
ZIP_GEOGRAPHY = "ZIP"

# Full place names that count as an airport pickup.
AIRPORT_PLACES = (
    "O'Hare International Airport, 10000, Perimeter Road, O'Hare, Chicago, Jefferson Township, Cook County, Illinois, 60666, United States",
    "Lot A, O'Hare Commercial Departure, O'Hare, Chicago, Jefferson Township, Cook County, Illinois, 60666, United States",
    "Chicago Midway International Airport, 5700, South Cicero Avenue, Chicago, Illinois, 60638, United States",
)


def equals(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column) == value)


def filled(column: str | Column) -> Column:
    """Neither missing nor empty, in a form the Parquet scan can check itself."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isNotNull() & (c != "")


def drop_blank(df: DataFrame, *columns: str) -> DataFrame:
    """Drop a row as soon as one of the columns is empty or missing."""
    for name in columns:
        df = df.filter(filled(name))
    return df


def either_present(df: DataFrame, first: str, second: str, blank_as_null: bool = False) -> DataFrame:
    present = filled if blank_as_null else (lambda name: F.col(name).isNotNull())
    return df.filter(present(first) | present(second))


def contact_or_area(contact_zip: str, area: str, blank_as_null: bool = False) -> Column:
    """A permit with a contact zip other than ``0``, or with a community area."""
    present = filled if blank_as_null else (lambda name: F.col(name).isNotNull())
    return (present(contact_zip) & (F.col(contact_zip) != "0")) | present(area)


def below(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Strict integer cast, then strictly below the limit."""
    return df.filter(F.col(column).cast("int") < limit)


def one_of(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(list(names)))
