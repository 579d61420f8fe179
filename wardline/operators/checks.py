"""Row-level constraints and load audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def flag_rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the first rule a row breaks, NULL for a good row.

    A rule that evaluates to NULL counts as kept, like a CHECK constraint.
    """
    broken = [F.when(~rule, F.lit(reason)) for reason, rule in rules.items()]
    return df.withColumn(REASON, F.coalesce(*broken))


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col(REASON).isNotNull())


def load_audit(
    df: DataFrame,
    table: str,
    key: Sequence[str],
    required: Sequence[str] = (),
) -> DataFrame:
    """One row per table: rows, distinct keys, surplus rows of repeated keys, blanks.

    Two steps of plain counting: per key, then over keys. Both combine before the
    shuffle, so neither a frequent key nor the number of keys lands in one task.
    """
    blanks = [
        F.sum(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", 1).otherwise(0)).alias(f"_blank_{c}")
        for c in required
    ]
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies"), *blanks)
    blank_total = sum((F.sum(f"_blank_{c}") for c in required), F.lit(0))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("rows_in"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.coalesce(blank_total, F.lit(0)).cast("bigint").alias("blank_values"),
    )


def cast_audit(df: DataFrame, guards: Mapping[str, Column]) -> DataFrame:
    """Per column, how many values a lenient cast would turn into its default.

    ``guards`` maps a column name to its nullable parse (``double_or_null`` and so on).
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count(F.when(parsed.isNull(), 1)).alias(name) for name, parsed in guards.items()],
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("defaulted")) for n in guards])
    return counts.select("rows_in", F.explode(pairs).alias("p")).select("p.column_name", "rows_in", "p.defaulted")
