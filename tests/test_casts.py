import math
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wardline.functions import casts, dates, numbers, text


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, t {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_lenient_numbers(spark):
    texts = ["", None, "12.0", " 5 ", "abc", "5", "+7", "-3", "1.0d", "5\n", ".5", "5.", "1e3", "99999999999999999999",
             "-99999999999999999999"]
    assert column(spark, texts, casts.lenient_double) == [
        0.0, 0.0, 12.0, 0.0, 0.0, 5.0, 7.0, -3.0, 0.0, 0.0, 0.5, 5.0, 1000.0, 1e20, -1e20]
    assert column(spark, texts, casts.lenient_long) == [
        0, 0, 0, 0, 0, 5, 7, -3, 0, 0, 0, 0, 0, 2**63 - 1, -(2**63)]


def test_special_floats(spark):
    inf, minus, nan, huge, signed = column(spark, ["Inf", "-infinity", "nan", "1e999", "+nan"], casts.lenient_double)
    assert (inf, minus, huge, signed) == (math.inf, -math.inf, math.inf, 0.0) and math.isnan(nan)


def test_lenient_timestamp(spark):
    texts = ["2023-01-01T01:02:03.004", "2023-01-01T01:02:03", "2023-01-01T01:02:03.5", "2023-02-30T01:02:03.000", "", None,
             "2023-01-01 01:02:03.000", "2023-01-01T01:02:03.0000"]
    shown = column(spark, texts, lambda c: F.date_format(casts.lenient_timestamp(c), "yyyy-MM-dd HH:mm:ss.SSS"))
    assert shown == ["2023-01-01 01:02:03.004"] + ["0001-01-01 00:00:00.000"] * 7


def test_strict_casts(spark):
    assert column(spark, ["7", None, "-2"], lambda c: casts.strict(c, "int")) == [7, None, -2]
    assert column(spark, ["7.5", "1e2"], lambda c: casts.strict(c, "double")) == [7.5, 100.0]
    for bad, kind in [("", "int"), ("12.0", "int"), (" 5 ", "int"), ("99999999999", "int"), ("abc", "double"), ("1.0d", "double")]:
        with pytest.raises(PySparkException):
            column(spark, [bad], lambda c, kind=kind: casts.strict(c, kind))
    with pytest.raises(PySparkException):
        column(spark, ["x"], casts.strict_timestamp)


def test_strict_timestamp_has_no_zone(spark):
    assert column(spark, ["2023-01-01T01:02:03.000"], casts.strict_timestamp) == [datetime(2023, 1, 1, 1, 2, 3)]


def test_zip_text(spark):
    texts = ["60666-1234", "606661234", "60666", "6066", "abc", ""]
    assert column(spark, texts, casts.five_digit_zip) == ["60666", "60666", "60666", "6066", "abc", ""]


def test_rounding_ties(spark):
    values = [-87.6325, 87.6325, 0.0005, 41.8809, -0.0015, 2.5]
    assert column(spark, values, numbers.snap_half_away, "double")[:2] == [-87.633, 87.633]
    assert column(spark, values, numbers.snap_half_even, "double")[:2] == [-87.632, 87.632]
    assert column(spark, [-2.5, 2.5, 0.5, -0.4, 0.49999999999999994, 1e17], numbers.round_half_away, "double") == [
        -3.0, 3.0, 1.0, 0.0, 0.0, 1e17]


def test_round_matches_builtin(spark):
    df = spark.range(20000).select(((F.col("id") - 10000) / 8).alias("x"))
    assert df.filter(numbers.round_half_away(F.col("x")) != F.round("x")).count() == 0


def test_estimate(spark):
    df = spark.createDataFrame([(0.1, 25), (0.034, 500), (math.inf, 3)], "p double, n bigint")
    assert [r[0] for r in df.select(numbers.estimated_cases(F.col("p"), F.col("n"))).collect()] == [3, 17, None]


def test_number_text(spark):
    df = spark.createDataFrame([(41.881, -87.0)], "a double, b double")
    row = df.select(numbers.coordinate_key(F.col("a"), F.col("b")), numbers.six_decimals(F.col("b"))).first()
    assert list(row) == ["41.881,-87.0", "-87.000000"]


def test_dates_and_text(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 23:59:59' AS t, '' AS e, CAST(NULL AS STRING) AS n, 'a-b-' AS d")
    row = df.select(
        dates.trip_date(F.col("t")).cast("string"), dates.monday_based_weekday(F.col("t")),
        text.blank_to_null(F.col("e")), text.null_to_blank(F.col("n")), text.without_dashes(F.col("d")),
    ).first()
    assert list(row) == ["2024-01-01", 0, None, "", "ab"]
