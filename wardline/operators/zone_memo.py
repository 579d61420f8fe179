"""The zones of coordinates, kept from run to run.

A run locates the coordinates that no run before it has met, and those in whose cells outlines have changed since. All
others are joined from the table of the runs before. Coordinates outside every zone are kept as well.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardline.operators.spatial import ZoneIndex, attach_zones, distinct_points, probed_cells, probed_index, zone_of_points
from wardline.session import stable
from wardline.sources.versions import current, new_version, publish

SCHEMA = "lon double, lat double, zone string"
_NUMBER = "number int"


def _kept(spark: SparkSession, store: str) -> tuple[DataFrame, int | None]:
    """The table and the number of the index that it agrees with; None before the first run."""
    folders = current(spark, store, "memo", "memo_meta")
    try:
        row = spark.read.schema(_NUMBER).parquet(folders["memo_meta"]).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA), None
    return spark.read.schema(SCHEMA).parquet(folders["memo"]), row["number"]


def _outdated(memo: DataFrame, index: ZoneIndex, number: int) -> DataFrame:
    """The kept coordinates that lie in cells which have changed after the index of that number."""
    cells = index.touched.where(F.col("number") > number).select("level", "cell").distinct()
    return probed_cells(memo.select("lon", "lat"), index).join(cells, ["level", "cell"], "left_semi").select("lon", "lat").distinct()


def locate_kept(df: DataFrame, index: ZoneIndex, points: Mapping[str, tuple[str, str]], store: str) -> tuple[DataFrame, int]:
    """Add one zone column per coordinate pair, NULL where no zone holds the point; and how many points were located.

    ``store`` is the folder of the kept index. The table of coordinates is replaced when all new ones are in it.
    """
    spark = df.sparkSession
    memo, number = _kept(spark, store)
    changed = number is not None and index.number > number
    if changed:
        memo = stable(memo.join(_outdated(memo, index, number), ["lon", "lat"], "left_anti"))
    asked = distinct_points(df, *points.values())
    new = asked.join(memo.select("lon", "lat"), ["lon", "lat"], "left_anti")
    counted = Observation()
    new = stable(new.observe(counted, F.count(F.lit(1)).alias("points")))
    located = counted.get["points"]
    if located or changed or number is None:
        near = index if index.directory is not None else probed_index(new, index)
        found = new.join(zone_of_points(new, near), ["lon", "lat"], "left").select("lon", "lat", "zone")
        names = {name: new_version(name) for name in ("memo", "memo_meta")}
        memo.unionByName(found).write.parquet(f"{store}/{names['memo']}")
        spark.range(1).select(F.lit(index.number).alias("number")).write.parquet(f"{store}/{names['memo_meta']}")
        memo = spark.read.schema(SCHEMA).parquet(publish(spark, store, names)["memo"])
    return attach_zones(df, memo.where("zone is not null"), points), located
