import itertools
import re
import time

from pyspark.sql import functions as F

from tests.llm.cases import DOCS, documents, spaced_words
from wardline.llm.common import PLACE, ascii_lower, between, match_places, pieces, running, unit, with_place, word_count


def places(df):
    return sorted((r["doc_id"], r[PLACE[0]], r[PLACE[1]]) for r in df.collect())


def test_places_of_a_file_do_not_depend_on_how_it_is_read(spark, tmp_path):
    spark.range(5000).select(F.col("id").alias("doc_id")).repartition(3).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    first = places(with_place(docs, ["doc_id"]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        assert places(with_place(spark.read.parquet(str(tmp_path / "t")), ["doc_id"])) == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({p[1:] for p in first}) == 5000


def test_places_tell_rows_apart_whatever_the_frame(spark, tmp_path):
    made = documents(spark)
    made.write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    doubled = docs.crossJoin(spark.range(2).withColumnRenamed("id", "n"))
    named = docs.withColumn("_metadata", F.lit("x"))
    for df, rows in ((made, 1), (docs.where("true"), 1), (doubled, 2), (docs.unionAll(docs), 2), (named, 1), (docs.limit(0), 0)):
        placed = with_place(df, ["doc_id", "text"])
        assert placed.columns == ["doc_id", "text", *PLACE]
        assert placed.count() == placed.select(*PLACE).distinct().count() == rows * len(DOCS)


def test_words_and_letters(spark):
    docs = documents(spark)
    got = docs.select("text", word_count(F.col("text")).alias("n")).collect()
    assert [r["n"] for r in got] == [len(spaced_words(r["text"])) for r in got]
    assert spark.range(1).select(ascii_lower(F.lit("AZÉİ[`{\u212a"))).first()[0] == "azÉİ[`{\u212a"


def test_units_lie_between_0_and_1(spark):
    low, high = spark.range(1).select(unit(F.lit(0).cast("long")), unit(F.lit(-1).cast("long"))).first()
    assert 0 < low < high < 1


def test_places_of_matches(spark):
    text = "𝒳aa é aa𝒳a aaa"
    got = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(match_places(F.col("t"), F.lit("a+"))).collect()
    assert [(m["start"], m["stop"], m["value"]) for m in got[0][0]] == [(1, 3, "aa"), (6, 8, "aa"), (9, 10, "a"), (11, 14, "aaa")]
    assert got[1][0] == [] and not got[2][0]


def test_running_sums_whatever_their_length(spark):
    for size in (0, 1, 63, 64, 65, 1000):
        values = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda x: x * 7 % 11) if size else F.array().cast("array<int>")
        sums = running(values, F.lit(0), lambda a, b: a + b, "int")
        most = running(values, F.lit(0), F.greatest, "int")
        got = spark.range(1).select(sums.alias("s"), most.alias("m")).first()
        plain = [n * 7 % 11 for n in range(1, size + 1)]
        assert got["s"] == list(itertools.accumulate(plain)) and got["m"] == list(itertools.accumulate(plain, max))


def test_pieces_of_a_text_by_place(spark):
    text = "".join(chr(0x1D4B3 + n % 7) if n % 3 else "ab\n"[n % 2] for n in range(50))
    cut = pieces(F.col("t"), 8)
    spots = [(a, b) for a in (0, 3, 7, 8, 9, 16, 49, 50) for b in (0, 5, 8, 15, 16, 24, 50) if b >= a]
    got = spark.createDataFrame([(text,)], "t string").select(*[between(cut, 8, F.lit(a), F.lit(b)) for a, b in spots]).first()
    assert list(got) == [text[a:b] for a, b in spots]


def test_a_hundred_thousand_matches_in_one_text(spark):
    text = "".join(f"{'x' * (n % 5)}a{'a' * (n % 3)}" for n in range(100_000))
    started = time.perf_counter()
    got = spark.createDataFrame([(text,)], "t string").select(match_places(F.col("t"), F.lit("a+"))).first()[0]
    assert time.perf_counter() - started < 60
    assert [(m["start"], m["stop"]) for m in got] == [m.span() for m in re.finditer("a+", text)]
