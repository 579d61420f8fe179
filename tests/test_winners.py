import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wardline.operators.keyed import keyed_first
from wardline.session import scratch_path
from wardline.sources import tables, winners
from wardline.sources.tables import lake_rejects, lake_table, refresh_lake_table
from wardline.sources.winners import FIRST, first_of_keys, mark_rows, tell_first


@pytest.fixture(scope="module")
def parsed(spark):
    """Key ``a0`` has a third of the rows, some rows have none; files were landed in another order than they are read in."""
    file, n = F.floor(F.col("id") / 700), F.col("id")
    seq = F.struct(
        F.timestamp_seconds(5000 - F.floor(file / 2)).alias("landed"), F.when(file % 3 > 0, file).alias("page"),
        F.concat(F.lit("file-"), file.cast("string")).alias("file"), F.spark_partition_id().cast("bigint").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )
    key = F.when(n % 3 == 0, "a0").when(n % 101 != 7, F.concat(F.lit("a"), (n * 7919 % 1500).cast("string")))
    rows = spark.range(0, 9000, 1, 7).select(key.alias("k"), (n % 2).alias("k2"), seq.alias("ingest_seq"), n.cast("string").alias("v"))
    return rows.cache()


def rows_of(df):
    return sorted(map(repr, df.select("k", "k2", "ingest_seq", "v").collect()))


@pytest.mark.parametrize("few", [True, False])
def test_the_first_of_every_key_in_landing_order(spark, parsed, monkeypatch, few):
    """In one task, and dealt out with frequent keys apart and the splits ranked in parallel."""
    if not few:
        for name, value in {"FEW_ROWS": 500, "SAMPLE_ROWS": 3000, "OFTEN": 200, "FEW_SPLITS": 3}.items():
            monkeypatch.setattr(winners, name, value)
        assert len(winners._frequent(parsed, ["k", "k2"], 9000)) == 2
    chosen = first_of_keys(parsed, ["k", "k2"], 9000, task_rows=1000)
    want = keyed_first(parsed, ["k", "k2"], ["ingest_seq"])
    count = chosen.count()
    assert count == want.count() and len(chosen.columns) == 3
    told = mark_rows(parsed, chosen, count, limit=1 << 20 if few else 0, task_rows=1000)
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and ("BroadcastHashJoin" if few else "ShuffledHashJoin") in plan
    assert rows_of(told.where(FIRST)) == rows_of(want)
    assert told.count() == 9000 and rows_of(told.where(~F.col(FIRST))) == rows_of(parsed.join(want.select("ingest_seq"), "ingest_seq", "left_anti"))


def test_bits_beyond_one_bitmap(spark):
    seq = F.struct(F.lit("f").alias("file"), F.monotonically_increasing_id().alias("row"))
    rows = spark.range(0, 100_000, 1, 2).select(F.col("id").alias("n"), seq.alias("ingest_seq"))
    chosen = rows.where(F.col("n") * 31 % 7 < 2).select("ingest_seq.row")
    told = mark_rows(rows, chosen, chosen.count())
    assert told.where(F.col(FIRST) != (F.col("n") * 31 % 7 < 2)).count() == 0


def test_a_load_sends_no_whole_rows(spark, tmp_path, monkeypatch):
    """Most keys repeat: rows that stay and rows that do not are told apart where they lie."""
    for number in range(1, 5):
        rows = [{"trip_id": f"t{n}", "company": str(number)} for n in range(0, 400 * number)]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"page-{number}.json").write_text("\n".join(map(json.dumps, rows)))
    plans, refresh_plan = [], tables.observed

    def noted(df, counts):
        plans.append((list(counts), df._jdf.queryExecution().executedPlan().toString()))
        return refresh_plan(df, counts)

    monkeypatch.setattr(tables, "observed", noted)
    lake = str(tmp_path / "lake")
    refresh_lake_table(spark, "taxi_trips", str(tmp_path / "in"), lake, multiline=False)
    by_count = {counts[0]: plan for counts, plan in plans}
    for name in ("rows_kept", "duplicate_rows"):
        assert not any(step in by_count[name] for step in ("Sort", "Window", "hashpartitioning"))
    kept, left = lake_table(spark, lake, "taxi_trips"), lake_rejects(spark, lake, "taxi_trips")
    assert {r["company"]: r["count"] for r in kept.groupBy("company").count().collect()} == {"1": 400, "2": 400, "3": 400, "4": 400}
    assert {r["company"]: r["count"] for r in left.groupBy("company").count().collect()} == {"2": 400, "3": 800, "4": 1200}


@pytest.mark.parametrize("shared", [False, True])
@pytest.mark.parametrize("limits", [{"SELDOM": 1}, {"SELDOM": 1, "FEW_REPEATED": 5}, {"SELDOM": 1, "FEW_ROWS": 500, "SAMPLE_ROWS": 3000, "OFTEN": 200}, {}])
def test_keys_that_come_once_are_told_by_their_hash(spark, parsed, monkeypatch, limits, shared):
    """Few keys repeat, more than may be sent out, frequent ones apart; also where several keys share a hash."""
    for name, value in limits.items():
        monkeypatch.setattr(winners, name, value)
    few = [r["k"] for r in parsed.where("k IS NOT NULL").select("k").distinct().orderBy("k").limit(40).collect()]
    own = F.col("k").isNotNull() & ~F.col("k").isin(few)
    rows = parsed.withColumn("k", F.when(own, F.concat(F.lit("b"), "v")).otherwise(F.col("k"))).cache()
    hashed = F.xxhash64
    if shared:
        monkeypatch.setattr(F, "xxhash64", lambda *key: F.pmod(hashed(*key), F.lit(2500)))
    told, want = tell_first(rows, ["k", "k2"], 9000), keyed_first(rows, ["k", "k2"], ["ingest_seq"])
    assert rows_of(told.where(FIRST)) == rows_of(want)
    assert told.count() == 9000 and told.where(~F.col(FIRST)).count() == 9000 - want.count() > 3000
    once = rows.where(F.col("k").startswith("b")).cache()
    assert tell_first(once, ["k"], once.count()) is None and tell_first(once.limit(0), ["k"], 0) is None


def test_a_load_leaves_one_copy_of_its_rows(spark, tmp_path):
    """The table is all that is left, packed: no parsed rows, no list of the keys that stayed."""
    (tmp_path / "in").mkdir()
    for number in range(3):
        rows = [{"trip_id": f"t{number}-{n}", "company": "c"} for n in range(300)]
        (tmp_path / "in" / f"page-{number}.json").write_text("\n".join(map(json.dumps, rows)))
    scratch = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(scratch.rglob("*.parquet"))
    folder = refresh_lake_table(spark, "taxi_trips", str(tmp_path / "in"), str(tmp_path / "lake"), multiline=False)
    for file in set(scratch.rglob("*.parquet")) - before:
        assert "tripid" not in pq.ParquetFile(file).schema_arrow.names
    parts = [pq.ParquetFile(file).metadata for file in Path(folder).glob("*.parquet")]
    assert sum(m.num_rows for m in parts) == 900
    assert {m.row_group(0).column(0).compression for m in parts if m.num_row_groups} == {"ZSTD"}
