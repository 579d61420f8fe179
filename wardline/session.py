"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Anything the cluster already sets for
# sizing (shuffle partitions, memory, checkpoint folder) is left alone.
RUNTIME_SETTINGS = {
    # Timestamps with a zone are written and shown in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Strict paths cast and fail; lenient paths use try_cast.
    "spark.sql.ansi.enabled": "true",
    # Re-plan at run time: coalesce small partitions, split skewed join ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode. A stage whose
    # generated loop would be larger runs its operators one by one instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: Of tables that hold whole records as text: half the bytes of the usual codec, in no more time.
PACKED = {"compression": "zstd"}


def local_session(app: str = "wardline", cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine; ``memory`` is the heap of its only process."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        # No call-site capture for every column expression built in Python.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else started."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder is made once per session, but only if the executors are threads
    of this process. Anywhere else each machine would write to a disk of its own, so the setting is required there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {context.master} share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wardline-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder.

    It lies in a folder named after the application. Nothing in there outlives the application's own results: the
    owner of the shared folder may drop the folder of every application that has ended.
    """
    return f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def kept_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that is the same whenever the application asks for it."""
    return f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}/kept/{name}"


def stable(df: DataFrame, path: str | None = None, **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later steps start from the written table: nothing before it runs again when an
    executor is lost, and the optimizer knows the size of what it reads. ``path`` is
    for those who drop it again; ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "step")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete what :func:`stable` wrote to a scratch path, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
