from pyspark.sql import functions as F

from wardline.operators.lookups import broadcast_if_small, in_any, last_match, lookup_join, measured_bytes


def test_measured_size_grows_with_the_data(spark):
    small, large = (spark.range(n).select(F.lit("x" * 100).alias("s"), F.array("id").alias("a")) for n in (10, 1000))
    assert measured_bytes(large) == 100 * measured_bytes(small) or measured_bytes(large) > 90 * measured_bytes(small)
    assert measured_bytes(spark.range(0)) == 0


def test_only_small_sides_are_hinted(spark):
    df = spark.range(1000)
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, limit=100))


def test_last_match_wins(spark):
    dim = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 1)], "k int, v string, seq int")
    got = {r["k"]: r["v"] for r in last_match(dim, "k", F.col("seq")).collect()}
    assert got == {1: "b", 2: "d"}


def test_lookup_keeps_every_row_and_fills_defaults(spark):
    dim = spark.createDataFrame([(0, "zero"), (1, "one"), (None, "null")], "k int, v string")
    left = spark.createDataFrame([(i, k) for i, k in enumerate([0, 1, 1, 5, None])], "i int, k int")
    for side in (dim, broadcast_if_small(dim)):
        got = lookup_join(left, side, "k", "k", {"name": ("v", "")}, unknown=0).orderBy("i").collect()
        assert [r["name"] for r in got] == ["", "one", "one", "", ""]


def test_hot_key_without_broadcast(spark):
    """A third of the rows on one key, through the shuffled join."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("k"))
        dim = spark.range(50).select(F.col("id").cast("int").alias("d"), (F.col("id") * 2).alias("v"))
        joined = lookup_join(left, dim, "k", "d", {"v": ("v", 0)})
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 30000 and joined.filter("v <> k * 2").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_semi_join_does_not_multiply(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "z int")
    assert [r["k"] for r in in_any(left, "k", right, "z").collect()] == [1]
