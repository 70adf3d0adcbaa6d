import math

import pytest
from pyspark.sql import functions as F

from plumbline.functions import expressions as e
from plumbline.functions.moments import deviation, kurtosis, per_column, skewness


def values(df, expression):
    return [r[0] for r in df.select(expression.alias("v")).collect()]


def doubles(spark, *numbers):
    return spark.createDataFrame([(None if x is None else float(x),) for x in numbers], "x double")


def test_missing_has_one_form(spark):
    df = doubles(spark, 1.0, math.nan, math.inf, -math.inf, 3.0)
    assert values(df, e.finite(F.col("x"))) == [1.0, None, None, None, 3.0]
    assert df.select(F.avg(e.finite(F.col("x")))).first()[0] == 2.0


def test_text_to_number_never_fails(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("NaN",), ("",), (None,)], "x string")
    assert values(df, e.to_number(F.col("x"))) == [1.5, None, None, None, None]


def test_ratio_with_zero_denominator(spark):
    df = spark.createDataFrame([(6.0, 3.0), (6.0, 0.0), (None, 2.0)], "a double, b double")
    assert values(df, e.ratio(F.col("a"), F.col("b"))) == [2.0, None, None]
    assert values(df, e.percentage(F.col("a"), F.col("b"))) == [200.0, 0.0, 0.0]


def test_whole_number_tolerance(spark):
    df = doubles(spark, 400.0, 400.4, 60000.4, None)
    assert values(df, e.is_whole(F.col("x"))) == [True, False, True, None]
    assert values(df, e.is_whole(F.col("x"), strict=True)) == [True, False, False, None]


def test_bins_are_closed_on_the_right(spark):
    df = doubles(spark, 0.0, 1.5, 1.5001, 6.0, 6.1, -1.0, None)
    edges = [0.0, 1.5, 3.0, 4.5, 6.0, math.inf]
    assert values(df, e.right_closed_bin(F.col("x"), edges)) == [1, 1, 2, 4, 5, None, None]
    with pytest.raises(ValueError):
        e.right_closed_bin(F.col("x"), [1.0, 1.0])


def test_value_beyond_last_edge_has_no_bin(spark):
    assert values(doubles(spark, 3.0), e.right_closed_bin(F.col("x"), [0.0, 1.0, 2.0])) == [None]


def test_last_histogram_bin_holds_the_maximum(spark):
    df = doubles(spark, *range(11), None)
    assert values(df, e.equal_width_bin(F.col("x"), 0.0, 10.0, 5)) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 4, None]


def test_display_text_is_plain_decimal(spark):
    df = doubles(spark, 880.0, 8.3252, -122.23, 12345678.9, 0.0, None)
    assert values(df, e.display_text(df, "x")) == ["880.0", "8.3252", "-122.23", "12345678.9", "0.0", None]


def test_correlation_ignores_incomplete_pairs_and_constants(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 5.0), (2.0, None, 5.0), (3.0, 5.0, 5.0), (5.0, 4.0, 5.0)], "a double, b double, c double"
    )
    r = df.select(
        e.guarded_correlation(F.col("a"), F.col("b")), e.guarded_correlation(F.col("a"), F.col("c"))
    ).first()
    assert r[0] == pytest.approx(0.720576692122892, abs=1e-14)
    assert r[1] is None


def moments(df):
    x = F.col("x")
    return tuple(df.agg(skewness(x), kurtosis(x), deviation(x)).first())


def test_adjusted_moments(spark):
    skew, kurt, _ = moments(doubles(spark, 1.0, 2.0, 2.5, 7.0, 9.0, 30.0))
    assert skew == pytest.approx(2.0289490360731306, abs=1e-12)
    assert kurt == pytest.approx(4.3237120194686245, abs=1e-11)


def test_constant_column_has_zero_shape(spark):
    assert moments(doubles(spark, 1.0, 1.0, 1.0, 1.0)) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_short_columns(spark, n):
    skew, kurt, deviation = moments(doubles(spark, *[float(i * i) for i in range(n)]))
    assert (skew is None) == (n < 3)
    assert kurt is None
    assert (deviation is None) == (n < 2)


def test_many_columns_are_chunked(spark):
    df = spark.range(10).select(*[(F.col("id") + i).cast("double").alias(f"c{i}") for i in range(60)])
    table = per_column(df, df.columns, lambda n: {"mean": F.avg(n)}).orderBy("position").collect()
    assert [r["variable"] for r in table] == df.columns
    assert [r["mean"] for r in table] == [4.5 + i for i in range(60)]


@pytest.mark.parametrize("parts", [1, 3, 7, 8])
def test_constant_columns_stay_constant_over_partitions(spark, parts):
    """Merged partial moments round; constants must still be recognised."""
    df = spark.range(0, 49_999, 1, parts).select(F.lit(0.1).alias("x"), F.col("id").cast("double").alias("y"))
    assert moments(df) == (0.0, 0.0, 0.0)
    assert df.select(e.guarded_correlation(F.col("x"), F.col("y"))).first()[0] is None


def test_pair_that_is_constant_where_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (5.0, None)], "x double, y double")
    assert df.select(e.guarded_correlation(F.col("x"), F.col("y"))).first()[0] is None
