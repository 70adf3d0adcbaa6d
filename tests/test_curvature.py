import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import curvature


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    n = 1500
    pdf = pd.DataFrame({"k": np.arange(n), "line": rng.normal(size=n), "bowl": rng.normal(size=n)})
    pdf["y"] = 3 * pdf["line"] + rng.normal(scale=0.5, size=n)
    pdf["z"] = 2 * pdf["bowl"] ** 2 + rng.normal(scale=0.2, size=n)
    pdf["flat"] = 1.0
    pdf["count"] = rng.integers(0, 6, n).astype(float)
    return spark.createDataFrame(pdf).repartition(6)


FEATURES = ["line", "bowl", "flat", "count"]


def as_dict(df, column):
    return {r["feature"]: r[column] for r in df.collect()}


def test_both_screens_agree_on_shape(table):
    smooth = as_dict(curvature.lowess_screen(table, ["line", "flat"], "y"), "automated_screen")
    binned = as_dict(curvature.binned_screen(table, ["line", "flat"], "y"), "automated_screen")
    assert smooth == binned == {"line": "Nearly linear", "flat": "Nearly linear"}
    smooth = as_dict(curvature.lowess_screen(table, ["bowl"], "z"), "automated_screen")
    binned = as_dict(curvature.binned_screen(table, ["bowl"], "z"), "automated_screen")
    assert smooth == binned == {"bowl": "Strong nonlinear pattern"}


def test_partitions_do_not_change_scores(table):
    one = as_dict(curvature.lowess_scores(table.repartition(1), FEATURES, "y"), "score")
    many = as_dict(curvature.lowess_scores(table.repartition(16), FEATURES, "y", bounded=100), "score")
    assert one == pytest.approx(many, abs=1e-9) and set(one) == set(FEATURES)


def test_small_sample_is_insufficient(table):
    few = table.where("k < 40")
    scores = as_dict(curvature.lowess_scores(few, ["line"], "y"), "score")
    assert scores == {"line": None}
    screen = curvature.screen_table(curvature.lowess_scores(few, ["line"], "y")).first()
    assert screen["automated_screen"] == "Insufficient data"
    assert as_dict(curvature.binned_scores(few, ["line"], "y"), "score") == {"line": None}


def test_line_fits_itself(spark):
    df = spark.range(400).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x"),
                                 (F.col("id") * 2.0 + 1).alias("y"))
    assert as_dict(curvature.lowess_scores(df, ["x"], "y"), "score")["x"] == pytest.approx(0, abs=1e-9)
    assert as_dict(curvature.binned_scores(df, ["x"], "y"), "score")["x"] == pytest.approx(0, abs=1e-9)


def test_local_fit_follows_a_local_regression_of_the_rows(spark):
    """Cells instead of rows cost little against weights over all points."""
    rng = np.random.default_rng(5)
    n = 4000
    x = np.sort(rng.normal(size=n))
    y = np.sin(2 * x) + rng.normal(scale=0.3, size=n)
    width, fitted = n // 4, np.empty(n)
    for i in range(n):
        distance = np.abs(x - x[i])
        near = np.argpartition(distance, width)[:width]
        w = (1 - (distance[near] / distance[near].max()) ** 3) ** 3
        d = x[near] - x[i]
        s, sd, sdd = w.sum(), (w * d).sum(), (w * d * d).sum()
        sy, sdy = (w * y[near]).sum(), (w * d * y[near]).sum()
        fitted[i] = (sy - (sdy - sd * sy / s) / (sdd - sd * sd / s) * sd) / s
    slope, intercept = np.polyfit(x, y, 1)
    expected = np.sqrt(np.mean((fitted - (intercept + slope * x)) ** 2)) / np.std(y, ddof=1)
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(n), "x": x, "y": y}))
    found = as_dict(curvature.lowess_scores(df, ["x"], "y"), "score")["x"]
    assert found == pytest.approx(expected, rel=0.02)


def robust_fit(x, y, rounds, span=0.25):
    """Local lines over all rows, reweighted by their residuals."""
    n, width, weight = len(x), int(len(x) * span), np.ones(len(x))
    for _ in range(rounds + 1):
        fitted = np.empty(n)
        for i in range(n):
            distance = np.abs(x - x[i])
            near = np.argpartition(distance, width)[:width]
            w = weight[near] * (1 - (distance[near] / distance[near].max()) ** 3) ** 3
            d = x[near] - x[i]
            s, sd, sdd, sy, sdy = w.sum(), (w * d).sum(), (w * d * d).sum(), (w * y[near]).sum(), (w * d * y[near]).sum()
            fitted[i] = (sy - (sdy - sd * sy / s) / (sdd - sd * sd / s) * sd) / s
        far = np.abs(y - fitted)
        weight = (1 - np.minimum(far / (6 * np.median(far)), 1) ** 2) ** 2
    return fitted


def test_robust_rounds_follow_a_regression_of_the_rows_and_ignore_outliers(spark):
    rng = np.random.default_rng(6)
    n = 3000
    x = np.sort(rng.normal(size=n))
    y = x + rng.normal(scale=0.3, size=n)
    spoiled = y.copy()
    # Outliers at one end only: they bend a curve that is not robust.
    spoiled[(x > 0.8) & (rng.random(n) < 0.15)] += 12.0
    slope, intercept = np.polyfit(x, spoiled, 1)
    line, spread = intercept + slope * x, np.std(spoiled, ddof=1)
    expected = np.sqrt(np.mean((robust_fit(x, spoiled, 2) - line) ** 2)) / spread
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": spoiled}))
    for bounded in (1_000_000, 200):
        found = as_dict(curvature.lowess_scores(df, ["x"], "y", rounds=2, bounded=bounded), "score")["x"]
        assert found == pytest.approx(expected, rel=0.02)
    # Without them the curve is a line, and so is the robust one with them.
    centre = robust_fit(x, y, 0)
    assert np.abs(robust_fit(x, spoiled, 3) - centre).max() < 0.5 < np.abs(robust_fit(x, spoiled, 0) - centre).max()


def test_planted_outliers_change_the_class_without_rounds_only(spark):
    rng = np.random.default_rng(7)
    n = 4000
    x = rng.uniform(-2, 2, size=n)
    y = 2 * x + rng.normal(scale=1.0, size=n)
    spiked = y + np.where((np.abs(x) < 0.5) & (rng.random(n) < 0.1), 30.0, 0.0)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y, "s": spiked}))
    clean = as_dict(curvature.robust_screen(df, ["x"], "y"), "automated_screen")
    assert clean == as_dict(curvature.lowess_screen(df, ["x"], "y"), "automated_screen") == {"x": "Nearly linear"}
    assert as_dict(curvature.lowess_screen(df, ["x"], "s"), "automated_screen") != clean
    # The straight line is moved by outliers as well, so the robust curve is compared with a lower one.
    robust = as_dict(curvature.lowess_scores(df, ["x"], "s", rounds=3), "score")["x"]
    plain = as_dict(curvature.lowess_scores(df, ["x"], "s"), "score")["x"]
    assert robust < plain


def test_robust_rounds_on_exact_lines_constant_columns_and_few_rows(spark):
    df = spark.range(400).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("y"), F.lit(1.0).alias("flat"))
    assert as_dict(curvature.lowess_scores(df, ["x", "flat"], "y", rounds=3), "score") == pytest.approx({"x": 0, "flat": 0}, abs=1e-9)
    assert as_dict(curvature.lowess_scores(df.limit(10), ["x"], "y", rounds=2), "score") == {"x": None}


def test_classes(spark):
    df = spark.createDataFrame([(0.0799,), (0.08,), (0.16,), (0.28,), (None,)], "s double")
    words = [r[0] for r in df.select(curvature.classify(F.col("s"))).collect()]
    assert words == ["Nearly linear", "Mild curvature", "Moderate curvature", "Strong nonlinear pattern",
                     "Insufficient data"]


def test_rows_find_their_bin_among_many_edges(spark):
    from plumbline.operators.curvature import _pair, _with_bins

    df = spark.createDataFrame([(None, 1.0), (0.5, 1.0), (1.0, 1.0), (7.0, None), (7.0, 2.0)], "`it's` double, y double")
    edges = {"it's": [float(e) for e in range(6)] + [None, 3.0], "y": [None]}
    rows = _with_bins(df, {n: _pair(df, n, "y") for n in edges}, edges).collect()
    assert sorted((r["x"], r["bin"]) for r in rows if r["feature"] == "it's") == [(0.5, 1), (1.0, 1), (7.0, 6)]
    assert [r["bin"] for r in rows if r["feature"] == "y"] == [0, 0, 0, 0]


def test_robust_rounds_write_each_row_once_and_keep_gaps(spark, monkeypatch):
    """A row per feature and row was written, and read seven times by each round."""
    written = []
    monkeypatch.setattr(curvature, "durable", lambda df: written.append((df.columns, df.count())) or df)
    monkeypatch.setattr(curvature, "forget", lambda *_: None)
    rng = np.random.default_rng(8)
    x, z = rng.normal(size=900), rng.integers(0, 3, 900).astype(float)
    y = x * x + rng.normal(scale=0.1, size=900)
    rows = [(a if i % 7 else None, c, b if i % 11 else None) for i, (a, c, b) in enumerate(zip(x.tolist(), z.tolist(), y.tolist()))]
    df = spark.createDataFrame([*rows, (None, None, None)], "x double, `z z` double, y double").repartition(3)
    found = [as_dict(curvature.lowess_scores(df, ["x", "z z"], "y", rounds=2, bounded=b), "score") for b in (1_000_000, 60)]
    assert found[0] == pytest.approx(found[1], rel=1e-12)
    whole = [r for r in rows if None not in r]
    alone = spark.createDataFrame(whole, "x double, `z z` double, y double")
    assert as_dict(curvature.lowess_scores(alone, ["x"], "y", rounds=2), "score")["x"] == pytest.approx(found[0]["x"], rel=1e-9)
    assert written[0] == (["x", "z z", "y"], 901) and {n for _, n in written} == {901, len(whole)}


def test_the_screen_query_runs_the_reweighting_rounds(spark, monkeypatch):
    """It left them out: outlying rows bent its curve."""
    from catalog import queries

    rng = np.random.default_rng(9)
    n = 600
    x = rng.uniform(-2, 2, size=n)
    y = 2 * x + rng.normal(size=n) + np.where((np.abs(x) < 0.5) & (rng.random(n) < 0.1), 30.0, 0.0)
    rows = {c: rng.permutation(x) for c in queries.b.NUMBERS[1:]} | {queries.b.NUMBERS[0]: x, queries.b.TARGET: y}
    df = spark.createDataFrame(pd.DataFrame(rows))
    monkeypatch.setattr(queries, "_block", lambda *_: df)
    found = as_dict(queries.lowess_screen(spark, "none"), "deviation_score")
    robust, plain = (as_dict(curvature.lowess_scores(df, queries.b.NUMBERS, queries.b.TARGET, rounds=r), "score") for r in (3, 0))
    assert found == pytest.approx(robust, abs=1e-5) and abs(found[queries.b.NUMBERS[0]] - plain[queries.b.NUMBERS[0]]) > 0.01
