"""Lake and mart tables: full refresh, reading, read-back.

Every refresh writes a new version of its tables and moves the pointer when all of them are there (``versions``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.casts import double_or_null, long_or_null, timestamp_or_null
from wardline.operators.checks import REASON, flag_rejects
from wardline.operators.keyed import require_unique
from wardline.session import PACKED, drop_scratch, scratch_path, stable
from wardline.sources.pages import (
    BAD_SCHEMA,
    LINE,
    PAGE_SCHEMA,
    UNREAD,
    bad_records,
    flat_rows,
    good_rows,
    landed_pages,
    page_files,
    parsed_rows,
    read_pages,
)
from wardline.sources.schemas import FEEDS, MART_SCHEMAS, Feed
from wardline.sources.versions import current, current_path, new_version, publish, split_path
from wardline.sources.winners import FIRST, tell_first

_ENDS = ("pickup", "dropoff")

#: Columns of lake tables that marts cast leniently, with their nullable parse.
LENIENT = {
    "taxi_trips": {
        "tripstarttimestamp": timestamp_or_null,
        **{f"{end}centroid{axis}": double_or_null for end in _ENDS for axis in ("latitude", "longitude")},
    },
    "weekly_covid_by_zip": {
        "weekstart": timestamp_or_null,
        "weekend": timestamp_or_null,
        "testsweekly": long_or_null,
        "pctpositiveweekly": double_or_null,
        "population": long_or_null,
    },
    "covid_vulnerability": {"community_area_or_zip": long_or_null, "ccvi_score": double_or_null},
    "building_permits": {"permit_num": long_or_null, "latitude": double_or_null, "longitude": double_or_null},
}
CAST_SCHEMA = "table_name string, column_name string, rows_in bigint, defaulted bigint"

AUDIT_SCHEMA = (
    "table_name string, rows_in bigint, rows_kept bigint, duplicate_rows bigint, bad_records bigint, blank_values bigint"
)


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Select the declared columns in declared order; a value that does not fit fails the load."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields])


def refresh(df: DataFrame, schema: T.StructType | str, path: str, partition_by: Sequence[str] = ()) -> str:
    """Rebuild a table from scratch with its declared schema, in one distributed write; returns the new version's folder.

    Readers see the old rows until all new ones are written.
    """
    return _replace(df.sparkSession, path, conform(df, schema), partition_by)


def _replace(spark: SparkSession, path: str, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
    root, name = split_path(path)
    folder = new_version(name)
    df.write.partitionBy(*partition_by).parquet(f"{root}/{folder}")
    return publish(spark, root, {name: folder})[name]


VERSION = "rule_version"


def _checked(flagged: DataFrame, declared: T.StructType) -> DataFrame:
    """The declared columns and the reason; a value that does not fit its column is NULL and a reason of its own."""
    fitted = {f.name: F.col(f.name).try_cast(f.dataType) for f in declared.fields}
    lost = [
        F.when(F.col(f.name).isNotNull() & fitted[f.name].isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
        for f in declared.fields
    ]
    checked = flagged.withColumn(REASON, F.coalesce(F.col(REASON), *lost))
    others = [c for c in flagged.columns if c not in (*declared.names, REASON)]
    return checked.select(*[column.alias(name) for name, column in fitted.items()], REASON, *others)


def refresh_checked(flagged: DataFrame, schema: T.StructType | str, path: str, version: str | None = None) -> str:
    """Rebuild a table whose rows carry ``reject_reason``.

    Good and rejected rows go out in the same pass, below ``rejected=false`` and
    ``rejected=true``, so the input is computed once. A value that does not fit its
    column is NULL, and its row is a rejected one: the reason says which column,
    unless a rule had one already. No row is accepted with a value lost.

    ``version`` names the rules; rejected rows keep it as ``rule_version``.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = _checked(flagged.select(*declared.names, REASON), declared)
    if version is not None:
        rows = rows.withColumn(VERSION, F.when(F.col(REASON).isNotNull(), F.lit(version)))
    rows = rows.withColumn("rejected", F.col(REASON).isNotNull())
    return _replace(flagged.sparkSession, path, rows, ["rejected"])


def replay_rejects(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    corrections: DataFrame,
    key: Sequence[str],
    rules: Mapping[str, Column],
    version: str,
) -> str:
    """Try the rejected rows of a checked table again, with the values that ``corrections`` has for their keys.

    A correction is a row of ``key`` and some columns of the table, one for each key; a NULL in it leaves the value as it
    is. Corrected rows that break none of ``rules`` join the accepted ones under the key rule: a row whose key is loaded
    already, or that comes after another of its key, stays rejected. Rejected rows without a correction are not judged
    again; they keep their reason and the version of the rules that refused them.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = spark.read.parquet(current_path(spark, path))
    if VERSION not in rows.columns:
        rows = rows.withColumn(VERSION, F.lit(None).cast("string"))
    # The partition column is read back as text.
    was = F.col("rejected").cast("boolean")
    good, refused = rows.where(~was).drop("rejected"), rows.where(was).drop("rejected")
    changed = [c for c in corrections.columns if c in declared.names and c not in key]
    given = corrections.select(*key, *[F.col(c).alias(f"_new_{c}") for c in changed], F.lit(True).alias("_given"))
    met = stable(refused.join(given, list(key), "left"))
    waiting = met.where("_given IS NULL").select(*declared.names, REASON, VERSION)
    given_types = dict(corrections.dtypes)
    values = [
        F.coalesce(F.col(f"_new_{c}"), F.col(c).cast(given_types[c])).alias(c) if c in changed else F.col(c) for c in declared.names
    ]
    tried = _checked(flag_rejects(met.where("_given").select(*values), rules), declared)
    loaded = good.select(*key, F.lit(True).alias("_loaded")).distinct()
    order = Window.partitionBy(*key).orderBy(F.col(REASON).isNotNull(), *declared.names)
    tried = tried.withColumn("_place", F.row_number().over(order)).join(loaded, list(key), "left")
    twice = F.when(F.col("_loaded"), "key is loaded already").when(F.col("_place") > 1, "key comes twice")
    tried = tried.withColumn(REASON, F.coalesce(F.col(REASON), twice)).drop("_place", "_loaded")
    tried = tried.withColumn(VERSION, F.when(F.col(REASON).isNotNull(), F.lit(version)))
    parts = [df.select(*declared.names, REASON, VERSION) for df in (good, waiting, tried)]
    every = reduce(DataFrame.unionByName, parts).withColumn("rejected", F.col(REASON).isNotNull())
    return _replace(spark, path, every, ["rejected"])


def read_checked(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """Good rows of a checked table, or its rejected ones with their reasons."""
    rows = spark.read.parquet(current_path(spark, path)).filter(F.col("rejected") == F.lit(rejects)).drop("rejected")
    return rows if rejects else rows.drop(REASON, VERSION)


def refresh_lake_table(
    spark: SparkSession, table: str, pages: str, lake: str, multiline: bool = True, all_rings: bool = True
) -> str:
    """Landed pages of one feed to its lake table, with every row accounted for; returns the new version's folder.

    The pages are parsed once, into the shared folder. From there go the rows that stay to the table, those that lose
    to an earlier row of their key to ``_rejects/<table>``, pages and lines that are no JSON to ``_bad_pages/<table>``,
    the list of pages with their rows to ``_pages/<table>`` and the counts of all to ``_audit/<table>``; what the marts
    will cast leniently and how much of it becomes a default to ``_cast_audit/<table>``. All are replaced together, after
    the last has been written; then the parsed rows are dropped. A table that refuses duplicates fails before that.
    """
    feed = FEEDS[table]
    marked, seen = observed(parsed_rows(read_pages(spark, feed, pages, multiline), feed, marked=True), _landing_counts(feed))
    scratch = scratch_path(spark, "parsed")
    marked, files = stable(marked, scratch, **PACKED), page_files(spark, pages)
    bad = stable(bad_records(spark, marked, multiline, pages, files))
    some_bad = bool(seen.get["unread"])
    parsed = good_rows(marked, bad, multiline) if some_bad else marked.drop(UNREAD, LINE)
    if feed.on_duplicate == "fail":
        require_unique(parsed, feed.key, feed.table)
    names = [table, f"_rejects/{table}", f"_bad_pages/{table}", f"_pages/{table}", f"_audit/{table}", f"_cast_audit/{table}"]
    folders = {name: new_version(name) for name in names}
    paths = [f"{lake}/{folder}" for folder in folders.values()]
    lenient = LENIENT.get(table, {})
    defaulted = {f"cast_{name}": F.count(F.when(parse(F.col(name)).isNull(), 1)) for name, parse in lenient.items()}
    counts = seen.get if not some_bad else parsed.agg(*[c.alias(n) for n, c in _landing_counts(feed).items() if n != "unread"]).first().asDict()
    first, rejects = parsed, parsed.limit(0)
    if feed.on_duplicate == "first" and counts["rows_parsed"]:
        told = tell_first(parsed, feed.key, counts["rows_parsed"])
        if told is not None:
            first, rejects = told.where(FIRST).drop(FIRST), told.where(~F.col(FIRST)).drop(FIRST)
    rows = conform(flat_rows(first, feed, all_rings), feed.lake_schema)
    rows, kept = observed(rows, {"rows_kept": F.count(F.lit(1)), **defaulted})
    rows.write.options(**PACKED).parquet(paths[0])
    rows_kept = kept.get["rows_kept"]
    if feed.geometry:
        # Vertices were counted above; outlines are what the rule goes by.
        rows_kept = spark.read.schema(feed.lake_schema).parquet(paths[0]).agg(F.count_distinct("ingest_seq")).first()[0]
    rejects, lost = observed(rejects, {"duplicate_rows": F.count(F.lit(1))})
    rejects.write.options(**PACKED).parquet(paths[1])
    bad, broken = observed(bad, {"bad_records": F.count(F.lit(1))})
    bad.write.parquet(paths[2])
    landed_pages(files, parsed, bad).write.parquet(paths[3])
    audit = {
        "rows_in": counts["rows_parsed"] + broken.get["bad_records"],
        "rows_kept": rows_kept,
        **lost.get,
        **broken.get,
        "blank_values": counts["blank_values"],
    }
    one = spark.range(1).select(F.lit(table).alias("table_name"), *[F.lit(n).cast("bigint").alias(name) for name, n in audit.items()])
    one.write.parquet(paths[4])
    if lenient:
        casts = [
            F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("column_name"), F.lit(rows_kept).cast("bigint").alias("rows_in"), F.lit(kept.get[f"cast_{name}"]).cast("bigint").alias("defaulted"))
            for name in lenient
        ]
        spark.range(1).select(F.explode(F.array(*casts)).alias("c")).select("c.*").write.parquet(paths[5])
    else:
        del folders[f"_cast_audit/{table}"]
    path = publish(spark, lake, folders)[table]
    drop_scratch(spark, scratch)
    return path


def observed(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """A frame that counts while it is written, right before the write, so that no task counts twice."""
    observation = Observation()
    return df.observe(observation, *[count.alias(name) for name, count in counts.items()]), observation


def _landing_counts(feed: Feed) -> dict[str, Column]:
    """What is counted of parsed rows; ``blank_values`` are blanks in the key."""
    blanks = sum((F.count(F.when(F.col(c) == "", 1)) for c in feed.key), F.lit(0))
    unread = F.count(F.when(F.col(UNREAD), 1))
    return {"rows_parsed": F.count(F.lit(1)), "blank_values": blanks.cast("bigint"), "unread": unread}


def _lake_parts(spark: SparkSession, lake: str, kind: str, schema: str, tables: Sequence[str]) -> DataFrame:
    folders = current(spark, lake, *[f"{kind}/{table}" for table in tables])
    parts = [
        spark.read.schema(schema).parquet(folders[f"{kind}/{table}"]).select(F.lit(table).alias("table_name"), *[p.split()[0] for p in schema.split(", ")])
        for table in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def lake_audit(spark: SparkSession, lake: str, tables: Sequence[str] = tuple(FEEDS)) -> DataFrame:
    """The audits of the last load of each table, one row per table."""
    folders = current(spark, lake, *[f"_audit/{table}" for table in tables])
    return spark.read.schema(AUDIT_SCHEMA).parquet(*folders.values())


def lake_cast_audit(spark: SparkSession, lake: str, tables: Sequence[str] = tuple(LENIENT)) -> DataFrame:
    """``table_name, column_name, rows_in, defaulted``, as counted by the last load of each table."""
    folders = current(spark, lake, *[f"_cast_audit/{table}" for table in tables])
    return spark.read.schema(CAST_SCHEMA).parquet(*folders.values())


def lake_rejects(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """Rows that lost to an earlier one of their key in the last load."""
    name = f"_rejects/{table}"
    return spark.read.parquet(current(spark, lake, name)[name])


def lake_bad_pages(spark: SparkSession, lake: str, tables: Sequence[str] = tuple(FEEDS)) -> DataFrame:
    """``table_name, path, reason, bytes, record`` of the pages and lines that the last loads could not parse.

    ``record`` is the line, or the beginning of the page.
    """
    return _lake_parts(spark, lake, "_bad_pages", BAD_SCHEMA, tables)


def lake_pages(spark: SparkSession, lake: str, tables: Sequence[str] = tuple(FEEDS)) -> DataFrame:
    """``table_name, path, landed, bytes, rows, bad_records`` of every page of the last loads."""
    return _lake_parts(spark, lake, "_pages", PAGE_SCHEMA, tables)


def mart_audit(spark: SparkSession, mart: str, tables: Sequence[str] = tuple(MART_SCHEMAS)) -> DataFrame:
    """Rows kept and rejected in each mart table, by reason."""
    audits = []
    folders = current(spark, mart, *tables)
    for table in tables:
        df = spark.read.parquet(folders[table])
        reason = F.coalesce(F.col(REASON), F.lit("")) if REASON in df.columns else F.lit("")
        audits.append(df.groupBy(reason.alias(REASON)).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table_name"), REASON, "rows"))
    return reduce(DataFrame.unionByName, audits)


def lake_table(spark: SparkSession, lake: str, table: str) -> DataFrame:
    return spark.read.schema(FEEDS[table].lake_schema).parquet(current_path(spark, f"{lake}/{table}"))


def mart_table(spark: SparkSession, mart: str, table: str) -> DataFrame:
    """A mart table without its rejected rows."""
    df = spark.read.parquet(current_path(spark, f"{mart}/{table}"))
    if "rejected" in df.columns:
        df = df.filter(~F.col("rejected")).drop("rejected", REASON, VERSION)
    return df


def save_as_table(df: DataFrame, schema: T.StructType | str, name: str) -> None:
    """The same full refresh into a catalog table."""
    conform(df, schema).write.mode("overwrite").saveAsTable(name)


def read_back(df: DataFrame, column: str, rows: int = 10) -> list:
    """A few values of one column, for a look after a load."""
    return [row[0] for row in df.select(column).limit(rows).collect()]


def mart_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(MART_SCHEMAS[table])
