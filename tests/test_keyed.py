import pytest
from pyspark.sql import functions as F

from wardline.operators.checks import accepted, cast_audit, flag_rejects, load_audit, rejected
from wardline.operators.indexing import with_row_index
from wardline.operators.keyed import DuplicateKeyError, duplicate_keys, keyed_first, keyed_rejects, require_unique
from wardline.sources.tables import mart_table, read_back, refresh, save_as_table


@pytest.fixture(scope="module")
def rows(spark):
    """Key 0 holds a third of all rows."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("seq"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"),
    )


def test_first_row_whatever_the_partitioning(rows):
    expected = {r["k"]: r["seq"] for r in rows.groupBy("k").agg(F.min("seq").alias("seq")).collect()}
    for parts in (1, 7, 40):
        got = keyed_first(rows.repartition(parts), ["k"], ["seq"]).collect()
        assert {r["k"]: r["seq"] for r in got} == expected and len(got) == len(expected)
        assert all(r["v"] == f"v{r['seq']}" for r in got)


def test_group_limit_before_the_shuffle(rows):
    plan = keyed_first(rows, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_rejects_are_the_rest(rows):
    kept, left = keyed_first(rows, ["k"], ["seq"]), keyed_rejects(rows, ["k"], "seq")
    assert kept.count() + left.count() == rows.count()
    assert kept.join(left, "seq").count() == 0


def test_duplicates(rows, spark):
    found = {r["k"]: r["copies"] for r in duplicate_keys(rows, ["k"]).collect()}
    assert found[0] >= 1000
    with pytest.raises(DuplicateKeyError):
        require_unique(rows, ["k"], "t")
    assert require_unique(rows, ["seq"], "t") is rows


def test_constraints(spark):
    df = spark.createDataFrame([("60601", 5), ("60601-1234", 5), ("60601", 2**40), ("1234567", 2**40), (None, 1)], "z string, n bigint")
    flagged = flag_rejects(df, {"zip": F.length("z") <= 6, "range": F.col("n") <= 2**31 - 1})
    assert accepted(flagged).count() == 2
    assert sorted(r["reject_reason"] for r in rejected(flagged).collect()) == ["range", "zip", "zip"]


def test_audits(rows, spark):
    audit = load_audit(rows.withColumn("v", F.when(F.col("seq") < 10, "").otherwise(F.col("v"))), "t", ["k"], ["v"]).first()
    keys = rows.select("k").distinct().count()
    assert tuple(audit) == ("t", 3000, keys, 3000 - keys, 10)
    empty = load_audit(rows.limit(0), "t", ["k"], ["v"]).first()
    assert tuple(empty) == ("t", 0, 0, 0, 0)
    casts = cast_audit(rows, {"a": F.when(F.col("seq") > 4, 1), "b": F.lit(1)}).collect()
    assert sorted(map(tuple, casts)) == [("a", 3000, 5), ("b", 3000, 0)]


def test_row_index(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), F.col("id").alias("b")).repartition(9)
    indexed = with_row_index(df, ["a", "b"]).orderBy("index").collect()
    assert [r["index"] for r in indexed] == list(range(5000))
    assert [(r["a"], r["b"]) for r in indexed] == sorted((r["a"], r["b"]) for r in indexed)


def test_refresh_replaces_and_conforms(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh(spark.createDataFrame([("1", "x", "left out")], "n string, s string, o string"), "s string, n int", path)
    refresh(spark.createDataFrame([("2", "y")], "n string, s string"), "s string, n int", path)
    back = mart_table(spark, str(tmp_path), "t")
    assert back.dtypes == [("s", "string"), ("n", "int")] and [tuple(r) for r in back.collect()] == [("y", 2)]
    assert read_back(back, "s") == ["y"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        refresh(spark.createDataFrame([("x", "y")], "n string, s string"), "s string, n int", path)


def test_catalog_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{tmp_path}/marts'")
    for value in ("1", "2"):
        save_as_table(spark.createDataFrame([(value,)], "n string"), "n int", "marts.t")
    assert [r[0] for r in spark.table("marts.t").collect()] == [2]
    spark.sql("DROP DATABASE marts CASCADE")
