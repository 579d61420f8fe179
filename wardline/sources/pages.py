"""Landed JSON pages to lake rows, and JSON snapshots of tables."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.text import null_to_blank
from wardline.operators.keyed import keyed_first
from wardline.operators.lookups import broadcast_if_small
from wardline.operators.spatial import ring_vertices
from wardline.session import stable
from wardline.sources.schemas import Feed

_PLACE = ("_landed", "_file", "_split")

#: Of rows in which no field could be read, and of lines that are no JSON the line itself.
UNREAD, LINE = "_unread", "_line"
#: So many page names may come to the driver.
FEW_PAGES = 200
BAD_SCHEMA = "path string, reason string, bytes bigint, record string"
PAGE_SCHEMA = "path string, landed timestamp, bytes bigint, rows bigint, bad_records bigint"


def file_columns() -> list[Column]:
    """When and where the file of a row was landed; for :func:`with_ingest_seq`."""
    return [
        F.col("_metadata.file_modification_time").alias("_landed"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
    ]


def read_pages(
    spark: SparkSession,
    feed: Feed,
    path: str,
    multiline: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Read landed pages against the declared schema.

    ``multiline`` pages are JSON arrays, one file each; with ``multiline=False``
    a page holds one object per line and big files are split. Fields of the feed
    the schema leaves out are never parsed into columns. A value that does not
    fit its field becomes NULL and the rest of its record is kept.

    ``ingest_seq`` records landing time, file, split and position. ``limit`` keeps
    the first rows in that order. ``_unread`` marks rows without any field; those that
    are no JSON are among them, see :func:`bad_records`.
    """
    rows = (
        json_options(spark.read, feed, multiline)
        .json(path)
        .select("*", *file_columns())
    )
    rows = with_ingest_seq(mark_unread(rows, feed, multiline))
    return rows.orderBy("ingest_seq").limit(limit) if limit is not None else rows


def json_options(reader, feed: Feed, multiline: bool):
    """A batch or stream reader for the pages of a feed.

    A line that is no JSON is kept as text. Of an array page Spark would keep the whole page, anew for every record
    with a field of another type, so there it is left out; :func:`bad_records` looks at the few pages in question.
    """
    schema = feed.page_schema if multiline else feed.page_schema.add(LINE, "string")
    reader = reader.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", LINE).option("recursiveFileLookup", True)


def mark_unread(rows: DataFrame, feed: Feed, multiline: bool) -> DataFrame:
    """Add ``_unread`` and, for array pages, an empty ``_line``. Lines that can be read in part are read."""
    nothing = reduce(lambda a, b: a & b, [F.col(name).isNull() for name in feed.page_schema.names])
    if multiline:
        return rows.withColumns({UNREAD: nothing, LINE: F.lit(None).cast("string")})
    return rows.withColumn(UNREAD, nothing & F.col(LINE).isNotNull()).withColumn(LINE, F.when(F.col(UNREAD), F.col(LINE)))


def _pages_that_are_no_json(spark: SparkSession, asked: DataFrame, folder: str) -> DataFrame:
    """Of the pages ``asked`` (``path``), read as text, those that hold neither an array nor an object.

    A few are opened by their names, as many as the driver may list; of more, every page of the folder is read once.
    """
    few = [r["path"] for r in asked.limit(FEW_PAGES + 1).collect()]
    if not few:
        return spark.createDataFrame([], BAD_SCHEMA)
    reader = spark.read.option("wholetext", True)
    if len(few) <= FEW_PAGES:
        # Names may hold characters that stand for others in a path pattern.
        reader = reader.text([re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(path)) for path in few])
        pages = reader.select(F.col("_metadata.file_path").alias("path"), "value")
    else:
        every = reader.option("recursiveFileLookup", True).text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
        pages = every.join(broadcast_if_small(asked), "path", "left_semi")
    bad = pages.where(F.json_array_length("value").isNull() & F.json_object_keys("value").isNull())
    ends = F.rlike(F.col("value"), F.lit(r"[\]}]\s*\z"))
    reason = F.when(F.trim("value") == "", "page is empty").when(ends, "page is no JSON").otherwise("page is cut off")
    return bad.select("path", reason.alias("reason"), F.octet_length("value").cast("bigint").alias("bytes"), F.left("value", F.lit(200)).alias("record"))


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, landed, bytes`` of every page there is; contents are not read. Files of no bytes are not listed by Spark."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("landed"), F.col("length").alias("bytes"))


def bad_records(spark: SparkSession, parsed: DataFrame, multiline: bool, folder: str, files: DataFrame | None = None) -> DataFrame:
    """What could not be parsed: one row for each broken page, or for each broken line, with the reason.

    ``parsed`` has been written; its pages lie below ``folder``. A page that is no JSON gives one row without any field; so
    does a page whose only record names no known field, so these pages are read once more, as text, and with them the ones
    of ``files`` that gave no row. Rows are added up by page before they meet the pages.
    """
    if not multiline:
        lines = parsed.where(UNREAD).select(F.col("ingest_seq.file").alias("path"), LINE)
        return lines.select("path", F.lit("line is no JSON").alias("reason"), F.octet_length(LINE).cast("bigint").alias("bytes"), F.col(LINE).alias("record"))
    unread = F.count(F.when(F.col(UNREAD), 1)).alias("unread")
    per_page = stable(parsed.groupBy(F.col("ingest_seq.file").alias("path")).agg(unread))
    asked = per_page.where("unread = 1").select("path")
    if files is not None:
        asked = asked.unionByName(files.select("path").join(per_page.select("path"), "path", "left_anti"))
    return _pages_that_are_no_json(spark, stable(asked), folder)


def good_rows(parsed: DataFrame, bad: DataFrame, multiline: bool) -> DataFrame:
    """Parsed rows without those that stand for a broken page or line."""
    if not multiline:
        return parsed.where(~F.col(UNREAD)).drop(UNREAD, LINE)
    # Rows with a field are never looked up.
    blank = parsed.where(UNREAD).join(bad.select(F.col("path").alias("_path")), F.col("ingest_seq.file") == F.col("_path"), "left_anti")
    return parsed.where(~F.col(UNREAD)).unionByName(blank).drop(UNREAD, LINE)


def landed_pages(files: DataFrame, parsed: DataFrame, bad: DataFrame) -> DataFrame:
    """Every page there is with its size, the rows read from it and the records that could not be; empty ones too.

    ``parsed`` without the bad records.
    """
    rows = parsed.groupBy(F.col("ingest_seq.file").alias("path")).agg(F.count("*").alias("_rows"))
    broken = bad.groupBy("path").agg(F.count("*").alias("_bad"))
    listed = files.join(rows, "path", "left").join(broken, "path", "left")
    counts = [F.coalesce("_rows", F.lit(0)).alias("rows"), F.coalesce("_bad", F.lit(0)).alias("bad_records")]
    return listed.select("path", "landed", "bytes", *counts)


def with_ingest_seq(rows: DataFrame) -> DataFrame:
    """Turn :func:`file_columns` into ``ingest_seq``. Call it right on the scan.

    Files count in the order they were landed in; those of one moment by the first
    number in their names, then by path. A split is read by one task from front to
    back, so the increasing row id orders the rows inside it.
    """
    return rows.withColumn(
        "ingest_seq",
        F.struct(
            F.col("_landed").alias("landed"),
            F.regexp_extract("_file", r"^(?:.*/)?[^/0-9]*([0-9]{1,18})[^/]*$", 1).try_cast("bigint").alias("page"),
            F.col("_file").alias("file"),
            F.col("_split").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ),
    ).drop(*_PLACE)


def _field(source: str | tuple[str, ...]) -> Column:
    """A feed field as text; blank when missing, first filled one of several spellings."""
    if isinstance(source, str):
        return null_to_blank(F.col(source))
    return null_to_blank(F.coalesce(*[F.when(F.col(s) != "", F.col(s)) for s in source]))


def parsed_rows(pages: DataFrame, feed: Feed, marked: bool = False) -> DataFrame:
    """Rename fields, blank out missing text, unnest points. Outlines stay whole, one row each.

    ``marked`` keeps the columns that tell which rows could not be read.
    """
    columns = [_field(source).alias(name) for name, source in feed.columns.items()]
    marks = [UNREAD, LINE] if marked else []

    if feed.point:
        coordinates = F.col(feed.point)["coordinates"]
        longitude, latitude = F.get(coordinates, F.lit(0)), F.get(coordinates, F.lit(1))
        if feed.point_default is not None:
            longitude = F.coalesce(longitude, F.lit(feed.point_default))
            latitude = F.coalesce(latitude, F.lit(feed.point_default))
        kinds = [null_to_blank(F.col(feed.point)["type"]).alias(name) for name in feed.extra]
        columns += [*kinds, latitude.alias("latitude"), longitude.alias("longitude")]

    if feed.geometry:
        kinds = [null_to_blank(F.col(feed.geometry)["type"]).alias(name) for name in feed.extra]
        return pages.select(*columns, *kinds, "ingest_seq", feed.geometry, *marks)

    return pages.select(*columns, "ingest_seq", *marks)


def flat_rows(rows: DataFrame, feed: Feed, all_rings: bool = True) -> DataFrame:
    """Parsed rows as the table holds them: outlines become one row per vertex."""
    if feed.geometry:
        return ring_vertices(rows, feed.geometry, all_rings).select(*feed.lake_schema.names)
    return rows


def first_rows(rows: DataFrame, feed: Feed) -> DataFrame:
    """Parsed rows without those that lose to an earlier one of their key.

    The rule goes by outline: its vertices stay or go together. Tables without a
    key keep everything, and so do those that refuse duplicates, whose loader checks.
    """
    return keyed_first(rows, feed.key, ["ingest_seq"]) if feed.on_duplicate == "first" else rows


def to_lake_rows(pages: DataFrame, feed: Feed, all_rings: bool = True) -> DataFrame:
    """Pages as rows of the table, under its key rule.

    ``all_rings=False`` keeps the outer ring of the first polygon only.
    """
    return flat_rows(first_rows(parsed_rows(pages, feed), feed), feed, all_rings)


def write_snapshot(df: DataFrame, path: str, packed: bool = False) -> str:
    """JSON snapshot of a frame, one object per line. Packed files cannot be split, so they get a bounded number of rows."""
    writer = df.write.mode("overwrite")
    if packed:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "FIVE").option("maxRecordsPerFile", 500_000)
    writer.json(path)
    return path


def write_array_pages(df: DataFrame, path: str, page_rows: int = 1000) -> str:
    """The same as pages of the array form: files of one JSON array, of at most ``page_rows`` objects each."""
    line = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    numbered = df.select(line.alias("line"), F.floor(F.monotonically_increasing_id() / F.lit(page_rows)).alias("page"))
    array = F.concat(F.lit("["), F.array_join(F.collect_list("line"), ",\n"), F.lit("]"))
    pages = numbered.groupBy("page").agg(array.alias("value")).select("value")
    pages.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path


def read_snapshot(spark: SparkSession, schema, path: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
