from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import eda, figures, outliers


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 800
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.exponential(size=n)})
    pdf["y"] = 2 * pdf["a"] + pdf["b"] + rng.normal(size=n)
    pdf["k"] = np.arange(n)
    pdf["flat"] = 1.0
    pdf.loc[pdf["k"] % 9 == 0, "b"] = np.nan
    pdf["g"] = np.where(pdf["k"] % 5 == 0, "u", "v")
    pdf.loc[pdf["k"] % 50 == 0, "g"] = None
    frame = spark.createDataFrame(pdf.astype({"g": object}).where(pdf.notna(), None))
    return pdf, frame.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t == "double" else c
                               for c, t in frame.dtypes]).repartition(5)


def test_distribution_matches_pandas(table):
    pdf, df = table
    for row in eda.distribution_summary(df, ["a", "b", "y"]).collect():
        series = pdf[row["variable"]]
        assert row["observations"] == series.count() and row["missing_count"] == series.isna().sum()
        for name, value in {
            "mean": series.mean(), "median": series.median(), "standard_deviation": series.std(),
            "skewness": series.skew(), "kurtosis": series.kurt(), "minimum": series.min(), "maximum": series.max(),
        }.items():
            assert row[name] == pytest.approx(value, rel=1e-10), (row["variable"], name)
    shapes = {r["variable"]: r["distribution_shape"] for r in eda.distribution_summary(df, ["a", "b"]).collect()}
    assert shapes == {"a": "Approximately symmetric", "b": "Right-skewed"}


def test_correlation_matches_pandas(table):
    pdf, df = table
    names = ["a", "b", "y", "flat"]
    expected = pdf[names].corr()
    found = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in eda.correlation_matrix(df, names).collect()}
    assert len(found) == 16
    for pair, value in found.items():
        if "flat" in pair:
            assert value is None
        else:
            assert value == pytest.approx(expected.loc[pair], abs=1e-12)


def test_gram_matrices_equal_one_aggregation(table, monkeypatch):
    _, df = table
    whole = {(r[0], r[1]): r["correlation"] for r in eda.correlation_matrix(df, ["a", "b", "y", "flat"]).collect()}
    monkeypatch.setattr(eda, "PAIRS_PER_PASS", 2)
    parts = {(r[0], r[1]): r["correlation"] for r in eda.correlation_matrix(df, ["a", "b", "y", "flat"]).collect()}
    # Sums of doubles may differ in the last digit.
    assert parts == pytest.approx(whole, abs=1e-12, nan_ok=True)
    assert len(eda.correlation_pairs(df, ["a", "b", "y", "flat"]).collect()) == 6


@pytest.mark.parametrize(("tile", "strip"), [(1, 1), (2, 3), (3, 100), (512, 1024)])
def test_tiles_equal_numpy_with_gaps(spark, monkeypatch, tile, strip):
    monkeypatch.setattr(eda, "STRIP", strip)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 7)) @ rng.normal(size=(7, 7)) + 100
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 4] = 2.5
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"v{i}" for i in range(7)])).repartition(5)
    cells = eda._gram_cells(df, df.columns, [(0, 0)] * 28, tile)
    expected = pd.DataFrame(x).corr().to_numpy()
    found = {(r["position_1"], r["position_2"]): r["correlation"] for r in cells.collect()}
    assert set(found) == {(i, j) for i in range(7) for j in range(i, 7)}
    for (i, j), value in found.items():
        if 4 in (i, j):
            assert value is None
        else:
            assert value == pytest.approx(expected[i, j], abs=1e-9)


def test_gram_matrices_of_far_and_constant_columns(spark):
    df = spark.range(4000).repartition(6).select(
        (F.col("id") + 1e9).alias("far"), (F.col("id") % 7 * 1.0).alias("near"), F.lit(1e9).alias("flat"),
        F.when(F.col("id") % 3 == 0, F.col("id") * -1.0).alias("gaps"),
    )
    found = {(r[2], r[3]): r["correlation"] for r in eda._gram_cells(df, df.columns, [(0, 1)] * 99).collect()}
    few = {(r[2], r[3]): r["correlation"] for r in eda._cells(df, df.columns, [(0, 1), (0, 2), (0, 3), (1, 3), (2, 3)]).collect()}
    for pair, value in few.items():
        assert found[pair] == (None if value is None else pytest.approx(value, abs=1e-9))
    assert found["far", "gaps"] == pytest.approx(-1.0) and found["flat", "flat"] is None


@pytest.mark.parametrize("columns", [60, 500])
def test_many_columns_are_one_scan(spark, tmp_path, columns):
    wide = spark.range(50).select(*[(F.col("id") * (i + 1) % 17 * 1.0).alias(f"c{i}") for i in range(columns)])
    wide.write.parquet(f"{tmp_path}/wide")
    matrix = eda.correlation_matrix(spark.read.parquet(f"{tmp_path}/wide"))
    plan = matrix._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and matrix.count() == columns * columns


def test_target_correlations_are_ranked(table):
    _, df = table
    rows = eda.target_correlations(df, "y", ["a", "b", "flat", "y"]).collect()
    assert [r["feature"] for r in rows] == ["a", "b", "flat"] and rows[-1]["correlation_with_target"] is None


def test_association_strength(spark):
    df = spark.createDataFrame([(0.5,), (-0.2,), (0.1,), (0.05,), (None,)], "r double")
    words = [r[0].split()[0] for r in df.select(eda.association_strength(F.col("r"))).collect()]
    assert words == ["Strong", "Moderate", "Weak", "Very", "Not"]


def test_target_by_category_keeps_null_level(table):
    pdf, df = table
    rows = {r["category_level"]: r for r in eda.categorical_target_summary(df, ["g"], "y").collect()}
    assert set(rows) == {"u", "v", None}
    part = pdf[pdf["g"].isna()]["y"]
    assert rows[None]["observations"] == len(part)
    assert rows[None]["target_median"] == pytest.approx(part.median())
    assert rows["v"]["target_standard_deviation"] == pytest.approx(pdf[pdf["g"] == "v"]["y"].std())


def test_describe_and_target_statistics(table):
    pdf, df = table
    row = {r["variable"]: r for r in eda.describe_numeric(df, ["b"]).collect()}["b"]
    assert row["q75"] == pytest.approx(round(pdf["b"].quantile(0.75), 3))
    stats = {r["statistic"]: r["value"] for r in eda.target_statistics(df, "y").collect()}
    assert stats["Skewness"] == pytest.approx(round(pdf["y"].skew(), 3)) and len(stats) == 6


def test_outliers_against_definition(table):
    pdf, df = table
    rows = {r["variable"]: r for r in outliers.outlier_summary(df, ["a", "b"]).collect()}
    series = pdf["b"]
    q1, q3 = series.quantile(0.25), series.quantile(0.75)
    fence = (series < q1 - 1.5 * (q3 - q1)) | (series > q3 + 1.5 * (q3 - q1))
    mad = (series - series.median()).abs().median()
    robust = (0.6745 * (series - series.median()) / mad).abs() > 3.5
    assert rows["b"]["iqr_flag_count"] == fence.sum()
    assert rows["b"]["modified_z_flag_count"] == robust.sum()
    assert rows["b"]["combined_flag_percentage"] == pytest.approx((fence | robust).mean() * 100)
    flagged = outliers.outlier_observations(df, ["a", "b"]).where("outlier_variable = 'b'").collect()
    assert {r["k"] for r in flagged} == set(pdf.index[fence | robust])


def test_zero_deviation_gives_no_score(spark):
    df = spark.createDataFrame([(5.0,)] * 4 + [(100.0,)], "x double")
    row = outliers.outlier_summary(df, ["x"]).first()
    assert (row["iqr_flag_count"], row["modified_z_flag_count"], row["combined_flag_count"]) == (1, 0, 1)
    assert outliers.outlier_observations(df, ["x"]).first()["modified_z_score"] is None


def test_all_null_column_has_no_outliers(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    rows = {r["variable"]: r for r in outliers.outlier_summary(df, ["x", "y"]).collect()}
    assert rows["x"]["combined_flag_count"] == 0 and rows["x"]["q1"] is None


def test_outlier_result_does_not_depend_on_partitions(table):
    _, df = table
    one = outliers.outlier_summary(df.repartition(1), ["a", "b"]).collect()
    many = outliers.outlier_summary(df.repartition(32), ["a", "b"]).collect()
    assert one == many


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    rows = figures.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["frequency"] for r in rows] == [2, 2, 2, 2, 3] and rows[-1]["bin_high"] == 10.0
    single = figures.histogram(spark.createDataFrame([(5.0,)] * 3, "x double"), "x", 4).orderBy("bin").collect()
    assert [r["frequency"] for r in single] == [0, 0, 3, 0] and single[0]["bin_low"] == 4.5
    assert figures.histogram(spark.createDataFrame([(None,)], "x double"), "x", 4).count() == 0


def test_boxplot(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 100)], "x double")
    row = figures.boxplot_stats(df, ["x"]).first()
    assert (row["q1"], row["median"], row["q3"]) == (2.0, 3.0, 4.0)
    assert (row["whisker_low"], row["whisker_high"], row["flier_count"]) == (1.0, 4.0, 1)


def test_sample_is_stable(table):
    _, df = table
    one = figures.scatter_sample(df.repartition(1), "k", ["a"], 50).collect()
    many = figures.scatter_sample(df.repartition(16), "k", ["a"], 50).collect()
    assert {r["k"] for r in one} == {r["k"] for r in many} and len(one) == 50


def test_grid_map(spark):
    df = spark.createDataFrame([(-0.5, 0.5, 1.0), (-0.4, 0.6, 3.0), (0.5, 0.5, 5.0), (None, 1.0, 9.0)],
                               "x double, y double, v double")
    rows = {(r["cell_x"], r["cell_y"]): (r["observations"], r["mean_value"]) for r in
            figures.grid_map(df, "x", "y", "v", 1.0, 1.0).collect()}
    assert rows == {(-1, 0): (2, 2.0), (0, 0): (1, 5.0)}


def test_sums_of_pairs_are_compiled(spark, capsys):
    """Ten pairs in one aggregation have more fields than Spark compiles: each row was interpreted."""
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame(rng.normal(size=(200, 5)), columns=list("abcde"))
    pdf.loc[::9, "b"] = np.nan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame(pdf).replace(float("nan"), None)
        pairs = eda.correlation_pairs(df, list(pdf))
        pairs.explain()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    steps = [line for line in capsys.readouterr().out.splitlines() if "HashAggregate(" in line]
    assert steps and all("*(" in line.split("HashAggregate(")[0] for line in steps)
    found = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in pairs.collect()}
    exact = pdf.corr()
    assert list(found) == list(combinations(pdf, 2))
    assert found == pytest.approx({(a, b): exact.loc[a, b] for a, b in found}, rel=1e-9)
