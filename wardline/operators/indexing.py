"""A running row number over a whole table without one task seeing it all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.session import stable
from wardline.sources.versions import current, new_version, publish

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """Number the rows 0, 1, 2, … in the given order, which should be unique.

    Rows are range-partitioned and sorted in parallel; each partition then adds the
    row count of those before it. Only that list of partition counts, one row per
    task, goes through a single window. The sorted rows are written once to the
    shared folder, so that counts and rows come from the same partitioning.
    """
    placed = (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _POSITION_BITS))
        .withColumn("_pos", F.col("_id").bitwiseAND(F.lit(2**_POSITION_BITS - 1)))
        .drop("_id")
    )
    placed = stable(placed)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_pos")).alias(name), *df.columns
    )


# ---------------------------------------------------------------- numbers that stay over loads

_LEDGER = "load string, first bigint, rows bigint"


def number_load(spark: SparkSession, df: DataFrame, order: Sequence[str], load: str, store: str, name: str = "index") -> DataFrame:
    """Number the rows of a load after those of all loads before it; returns them as they are kept.

    Below ``store`` lie the numbered rows of every load and a ledger of their ranges. Rows once numbered are never
    written again, so a number never changes; a load that is repeated finds its own rows. ``order`` should be unique.
    """
    known = current(spark, store)
    if f"load/{load}" not in known:
        ledger = spark.read.schema(_LEDGER).parquet(known["ledger"]) if "ledger" in known else spark.createDataFrame([], _LEDGER)
        start = ledger.agg(F.max(F.col("first") + F.col("rows"))).first()[0] or 0
        folders = {f"load/{load}": new_version("load"), "ledger": new_version("ledger")}
        rows = with_row_index(df, order, name)
        rows.withColumn(name, F.col(name) + F.lit(start)).write.parquet(f"{store}/{folders[f'load/{load}']}")
        count = spark.read.parquet(f"{store}/{folders[f'load/{load}']}").count()
        entry = spark.range(1).select(F.lit(load).alias("load"), F.lit(start).cast("bigint").alias("first"), F.lit(count).cast("bigint").alias("rows"))
        ledger.unionByName(entry).coalesce(1).write.parquet(f"{store}/{folders['ledger']}")
        known = publish(spark, store, folders)
    return spark.read.parquet(known[f"load/{load}"])


def numbered_rows(spark: SparkSession, store: str) -> DataFrame:
    """The rows of all loads with their numbers."""
    return spark.read.parquet(*[folder for name, folder in sorted(current(spark, store).items()) if name.startswith("load/")])


def number_ledger(spark: SparkSession, store: str) -> DataFrame:
    """``load, first, rows``: which numbers each load got."""
    return spark.read.schema(_LEDGER).parquet(current(spark, store)["ledger"])
