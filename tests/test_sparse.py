"""Sparse model inputs against the dense encoding, and beyond the number of levels it takes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import joins
from plumbline.operators import models, prep, sparse


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(400):
        color = [None, "red", "blue", "green"][rng.integers(0, 4)]
        size = None if k % 50 == 0 else ["s", "m"][k % 2]
        x = None if k % 17 == 0 else float(rng.integers(0, 9))
        y = None if k % 41 == 0 else float(10 * k % 37 + (x or 0))
        rows.append((k, "train" if k % 4 else "test", x, color if k % 8 else "unseen", size, y))
    schema = "k long, split string, x double, color string, `si``ze` string, y double"
    return spark.createDataFrame(rows, schema).repartition(5)


def dense_of(rows, names):
    return {r["k"]: [r[n] for n in names] for r in rows.collect()}


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_equals_the_dense_encoding(spark, table, monkeypatch, broadcast):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", broadcast)
    table = table.withColumnRenamed("si`ze", "size")
    selected, train = ["x", "color", "size"], table.where("split = 'train'")
    dense = prep.fit_preparation(train.drop("split"), selected, "y")
    wide = sparse.fit_sparse_preparation(train.drop("split"), selected, "y")
    names = [r["feature"] for r in wide.layout.features().orderBy("place").collect()]
    assert names == dense.layout and wide.layout.size == len(names)
    made = wide.apply(table, ["k", "split"])
    expected = dense_of(prep.prepared_splits(table, dense, ["k"]), dense.layout)
    assert {r["k"]: list(r["features"].toArray()) for r in made.collect()} == expected
    rows = made.where("split = 'train'")
    fitted = sparse.fit_ridge(rows, "y")
    other = models.train_models(prep.training_rows(prep.prepared_splits(table, dense, ["k"])), names, "y", only=[models.RIDGE])
    assert list(fitted.coefficients.toArray()) == pytest.approx(list(other[models.RIDGE].stages[-1].coefficients.toArray()), abs=1e-6)
    score = sparse.score_rows(fitted, made, "y", by=["split"]).count()
    assert score == 2
    sparse.drop_rows(made)


def test_thousands_of_levels_by_descent_equal_normal_equations(spark, monkeypatch):
    rows = spark.range(6000).select(
        "id", F.concat(F.lit("level "), (F.col("id") % 1500).cast("string")).alias("c"), (F.col("id") * 7 % 13).cast("double").alias("x"),
        (F.col("id") % 1500 * 0.5 + F.col("id") * 7 % 13).alias("y"),
    )
    layout = sparse.fit_layout(rows, ["x"], ["c"])
    assert layout.size == 1500
    with pytest.raises(ValueError):
        prep.fit_levels(rows, ["c"])
    made = sparse.sparse_rows(rows, layout, ["id", "y"])
    exact = sparse.fit_ridge(made, "y")
    monkeypatch.setattr(sparse, "NORMAL_PLACES", 10)
    descent = sparse.fit_ridge(made, "y")
    assert np.abs(exact.coefficients.toArray() - descent.coefficients.toArray()).max() < 1e-5
    assert sparse.ridge_coefficients(descent, layout).count() == 1501


def test_no_categories_no_rows_and_no_levels(spark):
    rows = spark.createDataFrame([(1, 2.0, None), (2, 0.0, None)], "k long, x double, c string")
    plain = sparse.fit_layout(rows, ["x"], [])
    assert [r["features"].toArray().tolist() for r in sparse.sparse_rows(rows, plain, ["k"]).orderBy("k").collect()] == [[2.0], [0.0]]
    empty = sparse.fit_layout(rows, ["x"], ["c"])
    assert empty.size == 1 and empty.counts == (0,)
    assert sparse.level_numbers(rows, empty, ["k"]).where("c_level_number is null").count() == 2
    assert sparse.sparse_rows(rows.limit(0), empty, ["k"]).count() == 0


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_levels_of_the_widest_category_are_eliminated_without_descent(spark, monkeypatch, broadcast):
    rows = spark.range(4000).select(
        "id", F.when(F.col("id") % 11 != 0, F.concat(F.lit("level "), (F.col("id") % 700).cast("string"))).alias("c"),
        (F.col("id") * 7 % 13 + 1e6).cast("double").alias("x"), F.when(F.col("id") % 3 != 0, F.col("id") % 5).cast("string").alias("d"),
        F.when(F.col("id") % 19 != 0, F.col("id") % 700 * 0.5 + F.col("id") * 7 % 13).alias("y"),
    )
    layout = sparse.fit_layout(rows, ["x"], ["d", "c"])
    made = sparse.sparse_rows(rows, layout, ["id", "y"])
    present = made.where("y is not null")
    # The same ridge by dense normal equations around the means.
    held = {r["id"]: (r["features"].toArray(), r["y"]) for r in made.collect()}
    x, y = (np.array(side) for side in zip(*[v for v in held.values() if v[1] is not None]))
    xc, yc = x - x.mean(axis=0), y - y.mean()
    expected = np.linalg.solve(xc.T @ xc + np.eye(layout.size), xc.T @ yc)
    intercept = y.mean() - x.mean(axis=0) @ expected
    monkeypatch.setattr(sparse, "NORMAL_PLACES", 10)
    monkeypatch.setattr(sparse, "DESCENT_STEPS", 0)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", broadcast)
    levelled = sparse.fit_ridge(present, "y", layout=layout)
    weights = {r["place"]: r["coefficient"] for r in sparse.ridge_coefficients(levelled, layout).collect()}
    assert [weights.pop(i) for i in range(layout.size)] == pytest.approx(list(expected), abs=1e-9)
    assert weights == pytest.approx({-1: intercept}, rel=1e-9)
    found = {r["id"]: r["prediction"] for r in sparse.predict_rows(levelled, made, ["id"]).collect()}
    assert found == pytest.approx({k: intercept + v[0] @ expected for k, v in held.items()}, abs=1e-6)
    levelled.forget()
