"""The forecast kept up to date: stored daily counts take in the trips of a load, and only zones with trips in it are
forecast again.

Counts and forecast lie in buckets of zones. A load rewrites the buckets of its own zones beside the old ones and
replaces them all at once, together with its own name, so that a load that is repeated after a failure counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.forecast import daily_counts, rolling_forecast
from wardline.session import stable
from wardline.sources.versions import current, new_version, publish

BUCKETS = 64
_BUCKET = "zone_bucket"


def _bucket() -> Column:
    return F.pmod(F.xxhash64("zip"), F.lit(BUCKETS)).cast("int")


def _read(spark: SparkSession, folders: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _schemas(counts: DataFrame) -> tuple[str, str]:
    date = counts.schema["tripdate"].dataType.simpleString()
    plain = f"tripdate {date}, zip string, trips bigint"
    return plain, f"{plain}, pred_next_day double, pred_next_week double"


def add_trips(
    spark: SparkSession, trips: DataFrame, load: str, store: str, date: str = "tripdate", pickup: str = "pickup", dropoff: str = "dropoff"
) -> list[int]:
    """Take the trips of one load into the counts and the forecast below ``store``; returns the buckets it rewrote.

    ``load`` names the load; one that has been taken in before changes nothing.
    """
    known = current(spark, store)
    if f"load/{load}" in known:
        return []
    new = stable(daily_counts(trips, date, pickup, dropoff).withColumn("zip", F.col("zip").cast("string")).withColumn(_BUCKET, _bucket()))
    touched = sorted(r[0] for r in new.select(_BUCKET).distinct().collect())
    counts_schema, forecast_schema = _schemas(new)
    folders = {kind: new_version(kind) for kind in ("counts", "forecast")}

    def stored(kind: str, schema: str) -> DataFrame:
        return _read(spark, [known[f"{kind}/{n}"] for n in touched if f"{kind}/{n}" in known], schema)

    merged = stored("counts", counts_schema).unionByName(new.drop(_BUCKET)).groupBy("tripdate", "zip").agg(F.sum("trips").alias("trips"))
    merged.withColumn(_BUCKET, _bucket()).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{store}/{folders['counts']}")
    counts = spark.read.schema(f"{counts_schema}, {_BUCKET} int").parquet(f"{store}/{folders['counts']}").drop(_BUCKET)
    # Zones of the same buckets without a trip in this load keep the forecast they have.
    zones = new.select("zip").distinct()
    redone = rolling_forecast(counts.join(zones, "zip", "left_semi"))
    others = stored("forecast", forecast_schema).join(zones, "zip", "left_anti")
    both = redone.select(*others.columns).unionByName(others).withColumn(_BUCKET, _bucket())
    both.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{store}/{folders['forecast']}")
    names = {f"{kind}/{n}": f"{folders[kind]}/{_BUCKET}={n}" for kind in folders for n in touched}
    publish(spark, store, {**names, f"load/{load}": "-"})
    return touched


def kept_forecast(spark: SparkSession, store: str, date: str = "date") -> DataFrame:
    """``tripdate, zip, trips, pred_next_day, pred_next_week`` over all loads so far."""
    folders = [folder for name, folder in sorted(current(spark, store).items()) if name.startswith("forecast/")]
    schema = f"tripdate {date}, zip string, trips bigint, pred_next_day double, pred_next_week double"
    return _read(spark, folders, schema)
