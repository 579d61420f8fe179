"""A zone index that is kept as a table and follows its outlines.

Every outline has a mark, a checksum of its vertices. Opening the index compares marks with those it was built from:
the same outlines open what is stored; of others, only the outlines that are new or changed are cut into cells again,
the pieces of those that are gone are left out. The sizes of cells stay as they were first fitted; a size of outline
that was not there before gets a level of its own.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.lookups import BROADCAST_LIMIT_BYTES
from wardline.operators.spatial import ZoneIndex, cell_directory, cut_pieces, fitting_levels, outline_extents, outline_shape
from wardline.session import stable
from wardline.sources.versions import current, new_version, publish

TABLES = ("outlines", "pieces", "directory", "touched", "meta")
MARK = "outline_mark"
_MARKED = "struct<mark0:bigint,mark1:bigint,n:bigint>"
_ENDS = "lo_x double, lo_y double, hi_x double, hi_y double"
_EDGES = f"array<struct<{_ENDS.replace(' double', ':double')}>>"
SCHEMAS = {
    "outlines": f"zone string, {MARK} {_MARKED}",
    "pieces": f"level int, cell bigint, zone string, shape {_MARKED}, {_ENDS}",
    "directory": f"level int, cell bigint, owner string, candidates array<struct<zone:string,always:int,edges:{_EDGES}>>",
    "touched": "number int, level int, cell bigint",
    "meta": "number int, quick bigint, vertices bigint, levels array<struct<level:int,width:double,height:double>>, small boolean",
}


def _vertex(zone: str, *seed: Column) -> Column:
    return F.xxhash64(zone, "part", "ring", "seq", "longitude", "latitude", *seed)


def outline_marks(vertices: DataFrame, zone: str) -> DataFrame:
    """``zone, shape, outline_mark`` of every outline: 128 bits over its vertices, whatever order they are read in."""
    halves = [F.bit_xor(_vertex(zone, F.lit(n))).alias(f"mark{n}") for n in range(2)]
    marks = vertices.groupBy(F.col(zone).cast("string").alias("zone"), outline_shape(vertices).alias("shape")).agg(*halves, F.count(F.lit(1)).alias("n"))
    return marks.select("zone", "shape", F.struct("mark0", "mark1", "n").alias(MARK))


def _quick(vertices: DataFrame, zone: str) -> tuple[int, int]:
    """One number over all vertices as they were landed; where it is the same, so is everything."""
    row = vertices.agg(F.bit_xor(_vertex(zone, outline_shape(vertices))), F.count(F.lit(1))).first()
    return row[0] or 0, row[1]


def _read(spark: SparkSession, folders: dict[str, str], name: str) -> DataFrame:
    # With its schema, so that no job looks for one.
    return spark.read.schema(SCHEMAS[name]).parquet(folders[name])


def _meta(spark: SparkSession, folders: dict[str, str]):
    try:
        return _read(spark, folders, "meta").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _opened(spark: SparkSession, folders: dict[str, str], meta, broadcast_limit: int) -> ZoneIndex:
    levels = {x["level"]: (x["width"], x["height"]) for x in meta["levels"]}
    directory = _read(spark, folders, "directory") if meta["small"] else None
    return ZoneIndex(levels, _read(spark, folders, "pieces"), directory, meta["number"], _read(spark, folders, "touched"), broadcast_limit)


def open_zone_index(
    spark: SparkSession, vertices: DataFrame, zone: str, store: str, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> ZoneIndex:
    """The index of the outlines below the folder ``store``, built or brought up to date where they differ.

    Outlines of one zone that are equal to the last digit count once. All tables of the index are replaced together;
    ``touched`` keeps the cells that each change has changed, for what else is kept by place (``zone_memo``).
    """
    folders = current(spark, store, *TABLES)
    meta = _meta(spark, folders)
    quick, count = _quick(vertices, zone)
    if meta is not None and (meta["quick"], meta["vertices"]) == (quick, count):
        return _opened(spark, folders, meta, broadcast_limit)

    marks = stable(outline_marks(vertices, zone).where("zone is not null"))
    now = marks.select("zone", MARK).distinct()
    if meta is None:
        fresh, kept, levels, number, touched = now, None, {}, 0, None
    else:
        number, touched = meta["number"] + 1, _read(spark, folders, "touched")
        before = _read(spark, folders, "outlines")
        fresh = stable(now.join(before, ["zone", MARK], "left_anti"))
        gone = stable(before.join(now, ["zone", MARK], "left_anti"))
        kept = _read(spark, folders, "pieces")
        if not gone.isEmpty():
            left = kept.join(gone.withColumnRenamed(MARK, "shape"), ["zone", "shape"], "left_semi")
            touched = touched.unionByName(left.select(F.lit(number).alias("number"), "level", "cell").distinct())
            kept = kept.join(gone.withColumnRenamed(MARK, "shape"), ["zone", "shape"], "left_anti")
        levels = {x["level"]: (x["width"], x["height"]) for x in meta["levels"]}

    # Of equal outlines one is cut.
    one = marks.join(fresh, ["zone", MARK], "left_semi").groupBy("zone", MARK).agg(F.min("shape").alias("_shape"))
    named = vertices.withColumn("_zone", F.col(zone).cast("string")).withColumn("_own", outline_shape(vertices))
    cut = named.join(one.withColumnRenamed("zone", "_z"), (F.col("_zone") == F.col("_z")) & (F.col("_own") == F.col("_shape")))
    cut = cut.select(F.col("_zone").alias(zone), MARK, "part", "ring", "seq", "longitude", "latitude")
    extents = stable(outline_extents(cut, zone))
    levels = fitting_levels(extents) | levels or {0: (1.0, 1.0)}
    pieces, _ = cut_pieces(cut, zone, extents, levels)
    pieces = stable(pieces)
    if kept is None:
        touched = spark.createDataFrame([], SCHEMAS["touched"])
    else:
        touched = touched.unionByName(pieces.select(F.lit(number).alias("number"), "level", "cell").distinct())
        pieces = kept.select(*pieces.columns).unionByName(pieces)

    paths = {name: new_version(name) for name in TABLES}
    pieces.write.parquet(f"{store}/{paths['pieces']}")
    written = spark.read.schema(pieces.schema).parquet(f"{store}/{paths['pieces']}")
    size = written.agg(F.sum(F.octet_length("zone") + F.lit(64))).first()[0] or 0
    small = size <= broadcast_limit
    directory = cell_directory(written)
    (directory if small else directory.limit(0)).write.parquet(f"{store}/{paths['directory']}")
    now.write.parquet(f"{store}/{paths['outlines']}")
    touched.write.parquet(f"{store}/{paths['touched']}")
    rows = F.array(*[F.struct(F.lit(n).alias("level"), F.lit(float(w)).alias("width"), F.lit(float(h)).alias("height")) for n, (w, h) in levels.items()])
    spark.range(1).select(
        F.lit(number).alias("number"), F.lit(quick).cast("bigint").alias("quick"), F.lit(count).cast("bigint").alias("vertices"), rows.alias("levels"), F.lit(small).alias("small")
    ).write.parquet(f"{store}/{paths['meta']}")
    folders = publish(spark, store, paths)
    return _opened(spark, folders, _meta(spark, folders), broadcast_limit)
