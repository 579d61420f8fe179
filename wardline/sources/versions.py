"""Tables that are replaced as a whole: a load writes beside what is there and then moves a pointer.

Below a root (a lake or a mart) every write of a table is a folder of its own, ``_versions/<table>/<number>-<id>``. The
pointer is ``_current``: text files that are only ever added to, one for each load, with a line for every table that the
load replaced. Readers take the line with the largest number. A load that fails leaves lines and folders as they were;
one that ends replaces all of its tables by one added file.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "_current"


def split_path(path: str) -> tuple[str, str]:
    """Root and name of a table given by its path."""
    root, _, name = path.rstrip("/").rpartition("/")
    return root, name


def pointer(spark: SparkSession, root: str) -> DataFrame:
    """``number, name, folder`` of every replacement there has been."""
    lines = spark.read.text(f"{root}/{POINTER}")
    parts = F.split("value", r"\|", 3)
    return lines.select(F.get(parts, F.lit(0)).cast("long").alias("number"), F.get(parts, F.lit(1)).alias("name"), F.get(parts, F.lit(2)).alias("folder"))


def _newest(spark: SparkSession, root: str, *names: str) -> dict[str, tuple[int, str]]:
    """Number and folder of the newest version of some tables, or of all."""
    try:
        rows = pointer(spark, root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    rows = rows.where(F.col("name").isin(*names)) if names else rows
    # One task reads the few lines there are, and nothing is shuffled.
    newest = rows.coalesce(1).groupBy("name").agg(F.max(F.struct("number", "folder")).alias("v"))
    return {r["name"]: (r["v"]["number"], r["v"]["folder"]) for r in newest.collect()}


def current(spark: SparkSession, root: str, *names: str) -> dict[str, str]:
    """The folder of each table as the last complete load left it; for one never replaced its plain folder."""
    newest = _newest(spark, root, *names)
    return {name: f"{root}/{newest[name][1]}" if name in newest else f"{root}/{name}" for name in names or newest}


def current_path(spark: SparkSession, path: str) -> str:
    root, name = split_path(path)
    return current(spark, root, name)[name]


def new_version(name: str) -> str:
    """Folder below the root for the next write of a table."""
    return f"_versions/{name}/{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, folders: Mapping[str, str]) -> dict[str, str]:
    """Make these folders the tables, all at once; returns their full paths."""
    number = max((n for n, _ in _newest(spark, root).values()), default=0) + 1
    lines = F.array(*[F.lit(f"{number:012d}|{name}|{folder}") for name, folder in folders.items()])
    spark.range(1).select(F.explode(lines).alias("value")).coalesce(1).write.mode("append").text(f"{root}/{POINTER}")
    return {name: f"{root}/{folder}" for name, folder in folders.items()}


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` versions of every table; call it while no load and no reader is at work."""
    rows = pointer(spark, root).collect()
    kept = {f for name in {r["name"] for r in rows} for _, f in sorted((r["number"], r["folder"]) for r in rows if r["name"] == name)[-keep:]}
    old = sorted({r["folder"] for r in rows} - kept)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for folder in old:
        path = hadoop.Path(f"{root}/{folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return old
