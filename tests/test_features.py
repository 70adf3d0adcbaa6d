import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import features, prep
from plumbline.schema import Ratio


def test_ratios_and_their_audit(spark):
    df = spark.createDataFrame([(6.0, 3), (1.0, 0), (None, 2), (4.0, None)], "a double, b int")
    ratios = [Ratio("a_per_b", "a", "b"), Ratio("absent", "a", "zzz")]
    made = features.ratio_features(df, ratios)
    assert [r["a_per_b"] for r in made.collect()] == [2.0, None, None, None] and "absent" not in made.columns
    audit = features.ratio_audit(df, ratios[:1]).first()
    assert (audit["zero_denominators"], audit["missing_denominators"]) == (1, 1)
    assert audit["note"].startswith("1 zero denominator")


def test_interactions(spark):
    df = spark.createDataFrame([(2.0, 3.0, "p"), (4.0, None, "q")], "a double, b double, c string")
    made = features.interaction_features(df, {"ab": ("a", "b")}, {"a_c": ("a", "c", ["p", "q"])}).collect()
    assert [(r["ab"], r["a_c_p"], r["a_c_q"]) for r in made] == [(6.0, 2.0, 0.0), (None, 0.0, 4.0)]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": np.arange(400), "x": rng.gamma(2.0, size=400), "z": rng.normal(size=400)})
    return pdf, spark.createDataFrame(pdf)


def column(df, name):
    return df.orderBy("k").select(F.col(f"`{name}`")).toPandas()[name].to_numpy()


def test_training_statistics_only(rows):
    pdf, df = rows
    train = df.where("k < 300")
    part = pdf["x"][:300]
    assert column(features.centered_features(df, train, ["x"]), "x_centered") == pytest.approx(pdf["x"] - part.mean())
    scaled = column(features.standardized_features(df, train, ["x"]), "x_standardized")
    assert scaled == pytest.approx((pdf["x"] - part.mean()) / part.std(ddof=0))
    index = column(features.composite_index(df, train, {"x": 0.5, "z": 2.0}), "composite_index")
    z = pdf["z"][:300]
    expected = 0.5 * (pdf["x"] - part.mean()) / part.std(ddof=0) + 2 * (pdf["z"] - z.mean()) / z.std(ddof=0)
    assert index == pytest.approx(expected)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "k long, x double")
    assert list(column(features.standardized_features(df, df, ["x"]), "x_standardized")) == [0.0, 0.0]


def test_polynomials(rows):
    pdf, df = rows
    made = features.polynomial_features(df, ["x", "z"], 3)
    assert set(made.columns) - set(df.columns) == {"x^2", "x*z", "z^2", "x^3", "x^2*z", "x*z^2", "z^3"}
    assert column(made, "x^2*z") == pytest.approx(pdf["x"] ** 2 * pdf["z"])
    assert column(features.squared_features(df, ["x"]), "x_squared") == pytest.approx(pdf["x"] ** 2)


def test_orthogonal_terms_are_uncorrelated_on_training_rows(rows):
    _, df = rows
    made = features.orthogonal_poly(df, df, ["x"])
    one, two = column(made, "x_poly_1"), column(made, "x_poly_2")
    assert one.mean() == pytest.approx(0, abs=1e-12) and two.mean() == pytest.approx(0, abs=1e-10)
    assert (one * two).mean() == pytest.approx(0, abs=1e-9)


def test_spline_is_linear_beyond_the_outer_knots(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x"))
    made = features.spline_features(df, df.where("k < 800"), ["x"])
    assert [c for c in made.columns if "spline" in c] == ["x_spline_1", "x_spline_2"]
    for name in ("x_spline_1", "x_spline_2"):
        values = column(made, name)
        assert np.abs(values[:40]).max() == 0.0
        assert np.abs(np.diff(values[800:], 2)).max() == pytest.approx(0, abs=1e-9)


def test_spline_keeps_missing_and_skips_flat_columns(spark):
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(50)] + [(50, None, 1.0)],
                               "k long, x double, flat double")
    made = features.spline_features(df, df, ["x", "flat"])
    assert made.where("k = 50").first()["x_spline_1"] is None and "flat_spline_1" not in made.columns


def test_category_groups(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    mapping = spark.createDataFrame([("a", "FIRST")], "level string, group_name string")
    assert [r[1] for r in features.category_groups(df, "c", mapping, "g").orderBy("c").collect()] == [
        "OTHER", "FIRST", "OTHER"]


def test_nearest_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 90.0), (None, 1.0)], "lat double, lon double")
    made = features.nearest_distance(df, "lat", "lon", [(0.0, 1.0), (0.0, 180.0)]).collect()
    degree = 6371.0088 * math.pi / 180
    assert made[0][2] == pytest.approx(degree) and made[1][2] == pytest.approx(89 * degree) and made[2][2] is None
    with pytest.raises(ValueError):
        features.nearest_distance(df, "lat", "lon", [])


def test_one_hot_baseline_comes_from_training(spark):
    train = spark.createDataFrame([("B", 1.0), ("A", 2.0), (None, 3.0)], "c string, x double")
    valid = spark.createDataFrame([("B", 1.0), ("C", 2.0), (None, 3.0)], "c string, x double")
    levels = prep.fit_levels(train, ["c"])
    assert levels == {"c": ["A", "B"]}
    made = prep.one_hot(valid, levels)
    assert made.columns == ["x", "c_B"] and [r["c_B"] for r in made.collect()] == [1.0, 0.0, 0.0]


def test_levels_beyond_the_cap_are_an_error(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="More than 5 levels in: c"):
        prep.fit_levels(df.withColumn("d", F.lit("x")), ["d", "c"], cap=5)


def test_any_number_of_levels_is_encoded_sparsely(spark):
    df = spark.range(3000).select(F.concat(F.lit("l"), F.col("id")).alias("c"))
    encoder = prep.sparse_encoder(df, ["c"])
    odd = spark.createDataFrame([("l7",), ("unseen",), (None,)], "c string")
    vectors = [r["c_levels"] for r in encoder.transform(odd).collect()]
    assert [v.size for v in vectors] == [3001] * 3
    assert [list(v.indices) for v in vectors[1:]] == [[3000], [3000]] and list(vectors[0].values) == [1.0]


def test_colliding_encoded_names_are_an_error(spark):
    df = spark.createDataFrame([("x", "x"), ("b_c", "c")], "a string, a_b string")
    levels = {"a": ["A", "b_c"], "a_b": ["A", "c"]}
    with pytest.raises(ValueError, match="a_b_c"):
        prep.one_hot(df, levels)


def test_odd_level_names(spark):
    df = spark.createDataFrame([("<1H OCEAN",), ("NEAR BAY",), ("IN.LAND",)], "c string")
    made = prep.one_hot(df, prep.fit_levels(df, ["c"]))
    assert made.columns == ["c_IN.LAND", "c_NEAR BAY"]
    assert made.select(F.sum("`c_NEAR BAY`")).first()[0] == 1.0


def test_imputation_uses_training_medians(spark):
    train = spark.createDataFrame([(1.0, None), (2.0, None), (10.0, None), (3.0, None)], "x double, e double")
    test = spark.createDataFrame([(None, None), (100.0, 1.0)], "x double, e double")
    medians = prep.fit_medians(train, ["x", "e"])
    assert medians == {"x": 2.5, "e": None}
    assert [tuple(r) for r in prep.median_impute(test, medians).collect()] == [(2.5, 0.0), (100.0, 1.0)]


def test_alignment(spark):
    df = spark.createDataFrame([(1, 2)], "a int, extra int")
    assert prep.align_columns(df, ["b", "a"]).collect()[0].asDict() == {"b": 0.0, "a": 1}
    with pytest.raises(KeyError):
        prep.align_strict(df, ["b", "a"])
    assert prep.align_strict(df, ["a"]).columns == ["a"]


def test_selection(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, y int")
    assert prep.selected_features(df, ["b", "y", "a"], "y").columns == ["b", "a", "y"]
    with pytest.raises(ValueError):
        prep.selected_features(df, [], "y")
    with pytest.raises(KeyError):
        prep.selected_features(df, ["nope"], "y")
    inputs, target = prep.separate_target(df, "y")
    assert inputs.columns == ["a", "b"] and target.first()[0] == 3.0


def test_preparation_is_fitted_on_training_rows(spark):
    data = [
        (1, "train", 1.0, "A", 10.0), (2, "train", 3.0, "B", 20.0), (3, "train", None, None, 30.0),
        (4, "train", 99.0, "Z", None), (5, "test", None, "B", 1.0), (6, "test", 7.0, "Q", 2.0),
    ]
    df = spark.createDataFrame(data, "k long, split string, x double, c string, y double")
    fitted = prep.fit_preparation(prep.training_rows(df).drop("split"), ["x", "c"], "y")
    assert fitted.layout == ["x", "c_B"] and fitted.medians == {"x": 2.0}
    made = prep.prepared_splits(df, fitted, ["k"]).orderBy("k")
    assert made.columns == ["k", "split", "x", "c_B", "y"]
    assert [(r["k"], r["x"], r["c_B"]) for r in made.collect()] == [
        (1, 1.0, 0.0), (2, 3.0, 1.0), (3, 2.0, 0.0), (5, 2.0, 1.0), (6, 7.0, 0.0)]
