"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def null_to_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def without_dashes(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(""))


def seeded_order(seed: int, *parts: Column) -> Column:
    """A shuffle key that is random over rows but the same on every run with one seed."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed))))
