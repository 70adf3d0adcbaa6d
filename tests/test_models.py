import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import models, split
from plumbline.plans import workflow
from plumbline.schema import ColumnRule, Ratio, SemanticSchema
from plumbline.sources import fingerprint, tables

QUICK = models.ModelSettings(trees=5, forest_depth=5, stages=5)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3)) * [1.0, 5.0, 0.2] + [0.0, 3.0, 1.0]
    y = x @ [2.0, -1.0, 4.0] + 7 + rng.normal(size=500)
    return x, y, spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=["a", "b", "c", "y"]))


@pytest.mark.parametrize("alpha", [1.0, 50.0])
def test_ridge_equals_closed_form(table, alpha):
    x, y, df = table
    fitted = models.train_models(df, ["a", "b", "c"], "y", models.ModelSettings(alpha=alpha), only=[models.RIDGE])
    rows = models.ridge_coefficients(fitted[models.RIDGE], ["a", "b", "c"], df).collect()
    centred, shifted = x - x.mean(0), y - y.mean()
    beta = np.linalg.solve(centred.T @ centred + alpha * np.eye(3), centred.T @ shifted)
    assert [r["coefficient"] for r in rows[1:]] == pytest.approx(list(beta), rel=1e-9)
    assert rows[0]["coefficient"] == pytest.approx(y.mean() - x.mean(0) @ beta, rel=1e-9)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0), (None, 1.0)], "a double, p double")
    row = models.regression_metrics(df, "a", "p").first()
    assert row["rmse"] == pytest.approx((5 / 3) ** 0.5) and row["mae"] == 1.0 and row["r2"] == -1.5
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "a double, p double")
    assert models.regression_metrics(flat, "a", "p").first()["r2"] is None


def test_comparison_and_best(table, tmp_path):
    _, _, df = table
    layout = ["a", "b", "c"]
    fitted = models.train_models(df, layout, "y", QUICK)
    comparison = models.model_comparison(fitted, df, layout, "y")
    rows = comparison.collect()
    assert {r["Model"] for r in rows} == {models.RIDGE, models.FOREST, models.BOOSTING}
    assert [r["Val_RMSE"] for r in rows] == sorted(r["Val_RMSE"] for r in rows) and rows[0]["Features"] == 3
    assert models.best_model(comparison).first() == rows[0]
    models.save_model(fitted[models.RIDGE], str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    before = models.test_metrics(fitted[models.RIDGE], df, layout, "y").first()
    assert models.test_metrics(again, df, layout, "y").first() == before
    weights = models.feature_importance(fitted[models.FOREST], layout, df).collect()
    assert sum(r["importance"] for r in weights) == pytest.approx(1.0)


def test_best_model_ties_go_to_the_earlier_model(spark):
    rows = [("Gradient_Boosting", 5.0), ("Ridge_Baseline", 5.0), ("Random_Forest", None)]
    comparison = spark.createDataFrame(rows, "Model string, Val_RMSE double")
    assert models.best_model(comparison).first()["Model"] == "Ridge_Baseline"


def test_scoring_needs_every_column(table):
    _, _, df = table
    fitted = models.train_models(df, ["a", "b"], "y", QUICK, only=[models.RIDGE])
    with pytest.raises(KeyError):
        models.predict(fitted[models.RIDGE], df.drop("b"), ["a", "b"], ["y"])
    with pytest.raises(ValueError):
        models.predict(fitted[models.RIDGE], df, ["a", "b", "c"], ["y"])


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.createDataFrame([(1, 1.5, "a"), (2, None, "b"), (2, None, "b")], "i int, x double, s string")
    first = fingerprint.dataset_fingerprint(df).first()
    assert fingerprint.dataset_fingerprint(df.orderBy(F.desc("i")).repartition(4)).first() == first
    assert fingerprint.dataset_fingerprint(df.distinct()).first()["fingerprint"] != first["fingerprint"]
    blank = df.fillna({"s": ""}).withColumn("s", F.when(F.col("s") != "b", F.col("s")))
    assert fingerprint.dataset_fingerprint(blank).first()["fingerprint"] != first["fingerprint"]
    assert fingerprint.dataset_fingerprint(df.limit(0)).first()["row_total"] == 0


def test_reading_and_writing(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5), (2, float("nan"))], "k long, x double")
    tables.write_table(df, str(tmp_path / "t.csv"), fmt="csv", row_key=["k"])
    back = tables.read_csv(spark, str(tmp_path / "t.csv"), "k long, x double")
    assert sorted(tuple(r) for r in back.collect()) == [(1, 0.5), (2, None)]
    found = tables.read_first(spark, [str(tmp_path / "none"), str(tmp_path / "t.csv")],
                              lambda s, p: tables.read_csv(s, p, "k long, x double"))
    assert found.count() == 2
    with pytest.raises(FileNotFoundError):
        tables.read_first(spark, [str(tmp_path / "none")])
    assert tables.land_raw(df, str(tmp_path / "raw")).count() == 2
    names = tables.feature_name_table(spark, ["b", "a"])
    tables.write_table(names, str(tmp_path / "names"))
    assert tables.read_feature_names(spark, str(tmp_path / "names")) == ["b", "a"]
    empty = df.limit(0)
    assert tables.given_or(empty, lambda: df).count() == 2 and tables.given_or(names, lambda: df) is names


def test_fingerprint_tells_tables_apart(spark):
    def of(rows, fields):
        return fingerprint.dataset_fingerprint(spark.createDataFrame(rows, fields)).first()["fingerprint"]

    assert of([("a|=b", "c")], "x string, y string") != of([("a", "b|=c")], "x string, y string")
    doubles = [of([(x,)], "x double") for x in (1e25, 5e30, None, 1e-9, 2e-8, 0.1 + 0.2, 0.3)]
    assert len(set(doubles)) == len(doubles)
    assert of([(1,)], "x long") != of([(1,)], "y long") != of([(1,)], "y int")


def test_end_to_end_run(spark, tmp_path):
    rng = np.random.default_rng(2)
    n = 900
    pdf = pd.DataFrame({
        "row_key": np.arange(n), "rooms": rng.integers(1, 40, n).astype(float),
        "homes": rng.integers(0, 9, n).astype(float), "income": rng.uniform(0, 9, n),
        "place": rng.choice(["IN LAND", "<1H SEA", "BAY"], n),
    })
    pdf["price"] = 10 * pdf["income"] + pdf["rooms"] + rng.normal(size=n)
    pdf.loc[pdf["row_key"] % 30 == 0, "rooms"] = np.nan
    raw = tables.with_missing_as_null(spark.createDataFrame(pdf))
    schema = SemanticSchema((
        ColumnRule("rooms", "count", nullable=True, minimum=0.0, whole_number=True),
        ColumnRule("homes", "count", minimum=0.0, whole_number=True),
        ColumnRule("income", "continuous_numeric", minimum=0.0),
        ColumnRule("price", "continuous_numeric", role="target", group="target"),
        ColumnRule("place", "nominal_categorical", storage="string", group="categorical"),
    ))
    plan = workflow.RunPlan(
        schema, "row_key", "income", [0.0, 1.5, 3.0, 4.5, 6.0, float("inf")],
        ["income", "rooms", "homes", "place", "rooms_per_home"],
        [Ratio("rooms_per_home", "rooms", "homes")], "Homes", "generated", QUICK,
    )
    result = workflow.run(raw, plan, str(tmp_path))
    assert result.status == "PASSED WITH WARNINGS"
    assert result.splits.where(F.col("split") == split.TRAIN).count() == 630
    assert result.preparation.layout == [
        "income", "rooms", "homes", "rooms_per_home", "place_BAY", "place_IN LAND"]
    assert result.best == models.RIDGE and result.test.first()["Test_R2"] > 0.9
    assert result.predictions.count() == 135
    test_keys = result.splits.where("split = 'test'").select("row_key")
    assert result.predictions.select("row_key").exceptAll(test_keys).isEmpty()
    record = spark.read.json(f"{tmp_path}/registry").first()
    assert record["model_registry"]["best_model"] == models.RIDGE
    assert len(record["model_registry"]["comparison_results"]) == 3
    assert record["data_registry"]["rows"] == n and record["feature_store"]["feature_count"] == 5
    assert models.load_model(f"{tmp_path}/model").stages[-1] is not None
    written = {p.name for p in tmp_path.iterdir()}
    assert set(result.explored.tables) | {"splits", "prepared", "predictions", "registry", "model"} <= written
    assert spark.read.parquet(f"{tmp_path}/notes").count() >= 5


def test_exploration_leaves_no_scratch_tables(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"key": np.arange(400), "x": rng.uniform(0, 9, 400), "y": rng.uniform(0, 9, 400),
                        "c": rng.choice(["a", "b"], 400)})
    pdf["z"] = pdf["x"] + pdf["y"]
    schema = SemanticSchema((ColumnRule("x", "continuous_numeric", minimum=0.0), ColumnRule(
        "z", "continuous_numeric"), ColumnRule("c", "nominal_categorical", storage="string", group="categorical"), ColumnRule(
        "y", "continuous_numeric", role="target", group="target")))
    plan = workflow.RunPlan(schema, "key", "x", [0.0, 5.0, float("inf")], ["x"])
    runs = [workflow.explore(spark.createDataFrame(pdf).repartition(n), plan) for n in (1, 32)]
    first, second = ({n: t.toPandas().round(9).sort_values(list(t.columns)).to_csv(index=False)
                      for n, t in run.tables.items()} for run in runs)
    assert first == second
    for run in runs:
        run.forget()
        with pytest.raises(Exception):
            run.splits.count()
