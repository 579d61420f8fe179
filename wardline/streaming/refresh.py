"""Lake table kept up to date from a folder of landed pages, under the key rule of its feed.

A table is a folder for every batch, and in it one for every part of the batch's keys (``sources.key_index``). Beside
them lie the index of these parts (``_keys``) and the pages and lines that were no JSON (``_bad_pages``), by batch too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType

from wardline.operators.keyed import DuplicateKeyError, require_unique
from wardline.operators.lookups import broadcast_if_small
from wardline.session import stable
from wardline.sources.key_index import (
    BATCH,
    PART,
    PART_KEYS,
    depth_for,
    filter_bits,
    index_rows,
    key_hash,
    part_name,
    parts_that_may_hold,
    read_index,
)
from wardline.sources.pages import (
    BAD_SCHEMA,
    bad_records,
    file_columns,
    flat_rows,
    good_rows,
    json_options,
    mark_unread,
    parsed_rows,
    with_ingest_seq,
)
from wardline.sources.schemas import Feed
from wardline.sources.winners import FIRST, first_of_keys, mark_rows

#: Tasks that write the rows of a batch, unless it has fewer parts.
WRITERS = 128


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _stored_schema(feed: Feed):
    return feed.lake_schema.add(BATCH, IntegerType()).add(PART, StringType())


def files_that_may_hold(spark: SparkSession, table: str, wanted: DataFrame, key: Sequence[str], number: int) -> list[str]:
    """Folders of batches before ``number`` that may hold a key of ``wanted``; none where no key was loaded before."""
    try:
        index = read_index(spark, f"{table}/_keys").where(F.col(BATCH) < number)
    except AnalysisException as error:
        if _missing(error):
            return []
        raise
    return [f"{table}/{BATCH}={batch}/{PART}={part}" for batch, part in parts_that_may_hold(index, wanted, key)]


def known_keys(spark: SparkSession, feed: Feed, table: str, wanted: DataFrame, number: int) -> DataFrame | None:
    """Keys of ``wanted`` that earlier batches hold: read from the files that may, of these the key columns alone."""
    key = list(feed.key)
    folders = files_that_may_hold(spark, table, wanted, key, number)
    if not folders:
        return None
    rows = spark.read.schema(_stored_schema(feed)).option("basePath", table).parquet(*folders).select(*key)
    return rows.join(broadcast_if_small(wanted), key, "left_semi").distinct()


def _write_batch(rows: DataFrame, keys: DataFrame, count: int, feed: Feed, table: str, number: int, all_rings: bool, part_keys: int) -> None:
    """Write the rows of a batch and the index of their ``count`` keys, in place of what an earlier attempt wrote."""
    folder, key = f"{table}/{BATCH}={number}", list(feed.key)
    depth = depth_for(count, part_keys)
    part = part_name(key_hash(key), depth)
    # A task writes several parts where there are many: a shuffle to so few tasks holds no rows back to sort them.
    dealt = rows.repartition(min(1 << depth, WRITERS), part)
    flat_rows(dealt, feed, all_rings).withColumn(PART, part).write.mode("overwrite").partitionBy(PART).parquet(folder)
    index = index_rows(keys, key, depth, filter_bits(count, depth))
    index.write.mode("overwrite").parquet(f"{table}/_keys/{BATCH}={number}")


def refresh_stream(
    spark: SparkSession,
    feed: Feed,
    pages: str,
    table: str,
    checkpoint: str,
    multiline: bool = True,
    files_per_batch: int | None = None,
    all_rings: bool = True,
    part_keys: int = PART_KEYS,
) -> StreamingQuery:
    """Load pages that arrived since the last run, with the outcome of a full load of them all.

    By the rule of the feed the first row of a key stays for good, a key that repeats
    within the batch or from an earlier one fails it, or every row is added. Outlines
    are kept or left out whole. Pages and lines that are no JSON go to ``_bad_pages``.

    Every batch writes folders of its own and compares itself with earlier ones only,
    so a batch that is repeated after a failure replaces what it had written. It opens
    the files that may hold its keys, and no others.
    """
    reader = json_options(spark.readStream, feed, multiline)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    source = reader.json(pages).select("*", *file_columns())
    key = list(feed.key)

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # Parsed once and written, so that neither the check nor a lost executor parses it again.
        marked = stable(parsed_rows(with_ingest_seq(mark_unread(batch, feed, multiline)), feed, marked=True))
        bad = stable(bad_records(session, marked, multiline, pages))
        rows = good_rows(marked, bad, multiline)
        if not key:
            flat_rows(rows, feed, all_rings).withColumn(PART, F.lit("0-0")).write.mode("overwrite").partitionBy(PART).parquet(f"{table}/{BATCH}={number}")
        elif feed.on_duplicate == "fail":
            rows = stable(rows)
            require_unique(rows, key, feed.table)
            keys = rows.select(*key)
            known = known_keys(session, feed, table, keys, number)
            repeated = known.limit(5).collect() if known is not None else []
            if repeated:
                shown = ", ".join(str(row.asDict()) for row in repeated)
                raise DuplicateKeyError(f"{feed.table}: loaded before: {shown}")
            _write_batch(rows, keys, rows.count(), feed, table, number, all_rings, part_keys)
        else:
            total = rows.count()
            chosen = first_of_keys(rows, key, total)
            known = known_keys(session, feed, table, chosen.select(*key), number)
            if known is not None:
                chosen = stable(chosen.join(known, key, "left_anti"))
            count = chosen.count()
            if count < total:
                rows = mark_rows(rows, chosen, count).where(FIRST).drop(FIRST)
            _write_batch(rows, chosen.select(*key), count, feed, table, number, all_rings, part_keys)
        bad.write.mode("overwrite").parquet(f"{table}/_bad_pages/{BATCH}={number}")

    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_refreshed(spark: SparkSession, feed: Feed, table: str) -> DataFrame:
    return spark.read.schema(_stored_schema(feed)).parquet(table).select(*feed.lake_schema.names)


def read_bad_pages(spark: SparkSession, table: str) -> DataFrame:
    """``path, reason, bytes, record, ingest_batch`` of what no batch could parse."""
    return spark.read.schema(f"{BAD_SCHEMA}, {BATCH} int").parquet(f"{table}/_bad_pages")


def compact_refreshed(spark: SparkSession, feed: Feed, table: str, target: str, part_keys: int = PART_KEYS) -> str:
    """Write the table anew below ``target`` as one batch, cut into as many parts as its keys need.

    Point the loader at ``target`` afterwards, between two runs: its rows carry the number of the last batch, which
    later batches count as earlier. Rows do not pass through a task by batch: parts are dealt out by key, those of
    a feed without a key as they are.
    """
    rows = spark.read.schema(_stored_schema(feed)).parquet(table)
    last = rows.agg(F.max(BATCH)).first()[0] or 0
    rows, key = rows.select(*feed.lake_schema.names), list(feed.key)
    folder = f"{target}/{BATCH}={last}"
    if not key:
        rows.withColumn(PART, F.lit("0-0")).write.partitionBy(PART).parquet(folder)
    else:
        keys = stable(rows.select(*key).distinct())
        count = keys.count()
        depth = depth_for(count, part_keys)
        part = part_name(key_hash(key), depth)
        rows.withColumn(PART, part).repartition(1 << depth, PART).write.partitionBy(PART).parquet(folder)
        index_rows(keys, key, depth, filter_bits(count, depth)).write.parquet(f"{target}/_keys/{BATCH}={last}")
    try:
        read_bad_pages(spark, table).drop(BATCH).write.parquet(f"{target}/_bad_pages/{BATCH}={last}")
    except AnalysisException as error:
        if not _missing(error):
            raise
    return target
