"""Regressors, their comparison, and scoring."""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.durable import shared_folder
from plumbline.functions.expressions import to_number
from plumbline.functions.moments import is_constant
from plumbline.operators.binned import fit_forest
from plumbline.operators.figures import COLUMN_BINS, histogram
from plumbline.operators.prep import align_strict
from plumbline.schema import quoted, require_rows

# Settings of the three regressors.
RIDGE_ALPHA = 1.0
FOREST_TREES = 100
FOREST_DEPTH = 12
BOOST_STAGES = 100
BOOST_RATE = 0.1
BOOST_DEPTH = 3
SEED = 42
RIDGE, FOREST, BOOSTING = "Ridge_Baseline", "Random_Forest", "Gradient_Boosting"


@dataclass(frozen=True)
class ModelSettings:
    """Sizes of the tree models; the defaults are the reference settings."""

    trees: int = FOREST_TREES
    forest_depth: int = FOREST_DEPTH
    stages: int = BOOST_STAGES
    boost_depth: int = BOOST_DEPTH
    seed: int = SEED
    alpha: float = RIDGE_ALPHA
    # Engine limits: trees are at most 30 deep, and splits are tried at so many quantiles.
    max_bins: int = 32
    checkpoint_interval: int = 10
    # Split statistics a task may hold, in MB: fewer passes over the rows per tree level.
    statistics_mb: int = 1024
    parallel_fits: int = 3


def regression_measures(actual: Column, predicted: Column) -> dict[str, Column]:
    """RMSE, MAE and R-squared as aggregates; R-squared is NULL for a constant target."""
    a, p = actual.cast("double"), predicted.cast("double")
    both = a.isNotNull() & p.isNotNull()
    error = F.when(both, a - p)
    present = F.when(both, a)
    total = F.when(~is_constant(present), F.var_pop(present) * F.count(present))
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "r2": F.lit(1.0) - F.sum(error * error) / total,
    }


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Metrics of any two numeric columns, optionally per group, in one aggregation."""
    measures = regression_measures(quoted(actual), quoted(predicted))
    return df.groupBy(*[quoted(n) for n in by]).agg(*[m.alias(n) for n, m in measures.items()])


def _assembler(layout: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(layout), outputCol="features", handleInvalid="error")


def ridge_estimator(train: DataFrame, target: str, alpha: float = RIDGE_ALPHA) -> LinearRegression:
    """L2-penalised least squares with the penalty on the raw scale.

    The normal solver scales the label by its population deviation and averages the
    loss over rows, so the raw penalty is ``alpha * deviation / rows``.
    """
    rows, spread = train.agg(F.count(quoted(target)), F.stddev_pop(quoted(target).cast("double"))).first()
    penalty = alpha * (spread or 0.0) / rows
    return LinearRegression(
        featuresCol="features", labelCol=target, elasticNetParam=0.0, regParam=penalty,
        standardization=False, solver="normal",
    )


def estimators(train: DataFrame, target: str, settings: ModelSettings = ModelSettings()) -> dict:
    """The three regressors by name, in their fixed order."""
    return {
        RIDGE: ridge_estimator(train, target, settings.alpha),
        FOREST: RandomForestRegressor(
            featuresCol="features", labelCol=target, numTrees=settings.trees, maxDepth=settings.forest_depth,
            featureSubsetStrategy="all", seed=settings.seed, maxBins=settings.max_bins,
            checkpointInterval=settings.checkpoint_interval, maxMemoryInMB=settings.statistics_mb,
            cacheNodeIds=True,
        ),
        BOOSTING: GBTRegressor(
            featuresCol="features", labelCol=target, maxIter=settings.stages, stepSize=BOOST_RATE,
            maxDepth=settings.boost_depth, seed=settings.seed, maxBins=settings.max_bins,
            checkpointInterval=settings.checkpoint_interval,
        ),
    }


def train_models(
    train: DataFrame,
    layout: Sequence[str],
    target: str,
    settings: ModelSettings = ModelSettings(),
    only: Sequence[str] | None = None,
    seconds: dict[str, float] | None = None,
) -> dict[str, PipelineModel]:
    """Fit each regressor on the same rows; ``seconds`` receives how long each took.

    The model matrix is built and kept once for all of them; training itself
    aggregates split statistics on the executors. Blocks of the forest are written to the
    shared folder and boosting residuals checkpointed there at intervals, so a lost executor
    does not restart a long lineage.
    """
    require_rows(train, "training")
    context = train.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(train.sparkSession))
    assembled = _assembler(layout).transform(train).select("features", quoted(target)).persist()
    try:
        chosen = {n: e for n, e in estimators(train, target, settings).items() if only is None or n in only}
        assembled.count()
        # The regressors are independent: the many short jobs of boosting run beside the
        # long ones of the forest instead of after them.
        def fit(name: str):
            started = time.perf_counter()
            made = fit_forest(chosen[name], assembled) if name == FOREST else chosen[name].fit(assembled)
            if seconds is not None:
                seconds[name] = time.perf_counter() - started
            return made

        with ThreadPoolExecutor(max_workers=settings.parallel_fits) as pool:
            waiting = {
                n: pool.submit(inheritable_thread_target(train.sparkSession)(lambda n=n: fit(n))) for n in chosen
            }
            return {n: PipelineModel([_assembler(layout), job.result()]) for n, job in waiting.items()}
    finally:
        assembled.unpersist()


def predict(model: PipelineModel, df: DataFrame, layout: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep...`` and ``prediction``; the key travels with its row, nothing is paired by position."""
    aligned = align_strict(df, layout, keep)
    expected = len(model.stages[0].getInputCols())
    if expected != len(layout):
        raise ValueError(f"The model expects {expected} features, the data have {len(layout)}.")
    numbers = aligned.withColumns({n: to_number(quoted(n)) for n in layout})
    return model.transform(numbers).select(*[quoted(n) for n in keep], "prediction")


def predictions(model: PipelineModel, df: DataFrame, layout: Sequence[str], row_key: str, target: str) -> DataFrame:
    """Row key and predicted target."""
    return predict(model, df, layout, [row_key]).select(quoted(row_key), F.col("prediction").alias(target))


def model_comparison(
    models: dict[str, PipelineModel], validation: DataFrame, layout: Sequence[str], target: str
) -> DataFrame:
    """Validation metrics of each model, best first, from one pass over the rows.

    The rows are assembled once and every model adds its own prediction column.
    """
    aligned = align_strict(validation, layout, [target])
    scored = _assembler(layout).transform(aligned.withColumns({n: to_number(quoted(n)) for n in layout}))
    for i, model in enumerate(models.values()):
        stage = model.stages[-1]
        scored = stage.copy({stage.predictionCol: f"_p{i}"}).transform(scored)
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("Model"),
            *[m.alias(n) for n, m in regression_measures(quoted(target), F.col(f"_p{i}")).items()],
        )
        for i, name in enumerate(models)
    ]
    return scored.agg(F.array(*rows).alias("all")).select(F.inline("all")).select(
        "position",
        "Model",
        F.round("rmse", 2).alias("Val_RMSE"),
        F.round("mae", 2).alias("Val_MAE"),
        F.round("r2", 4).alias("Val_R2"),
        F.lit(len(layout)).alias("Features"),
    ).orderBy("Val_RMSE", "position").drop("position")


def best_model(comparison: DataFrame, order: Sequence[str] = (RIDGE, FOREST, BOOSTING)) -> DataFrame:
    """The row with the lowest RMSE; the earlier model wins a tie, rows without RMSE never win."""
    chosen = F.struct(*[F.col(c) for c in comparison.columns])
    place = F.array_position(F.array(*[F.lit(n) for n in order]), F.col("Model"))
    found = comparison.where(F.col("Val_RMSE").isNotNull()).agg(
        F.min_by(chosen, F.struct(F.col("Val_RMSE"), place)).alias("best")
    )
    return found.select("best.*")


def test_metrics(model: PipelineModel, test: DataFrame, layout: Sequence[str], target: str) -> DataFrame:
    """Metrics of the selected model on held-out rows prepared with training statistics."""
    require_rows(test, "test evaluation")
    scored = predict(model, test, layout, [target])
    return regression_metrics(scored, target, "prediction").select(
        F.round("rmse", 2).alias("Test_RMSE"),
        F.round("mae", 2).alias("Test_MAE"),
        F.round("r2", 4).alias("Test_R2"),
    )


test_metrics.__test__ = False


def residuals(
    model: PipelineModel, df: DataFrame, layout: Sequence[str], row_key: str, target: str
) -> DataFrame:
    """Actual, predicted and residual per row."""
    scored = predict(model, df, layout, [row_key, target])
    return scored.select(
        quoted(row_key),
        quoted(target).alias("actual"),
        F.col("prediction").alias("predicted"),
        (quoted(target) - F.col("prediction")).alias("residual"),
    )


def residual_histogram(table: DataFrame, bins: int = COLUMN_BINS) -> DataFrame:
    return histogram(table, "residual", bins)


def feature_importance(model: PipelineModel, layout: Sequence[str], df: DataFrame) -> DataFrame:
    """Normalised importances, largest first; one row per model column."""
    weights = model.stages[-1].featureImportances.toArray()
    total = float(weights.sum()) or 1.0
    rows = [(name, float(w) / total) for name, w in zip(layout, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def ridge_coefficients(model: PipelineModel, layout: Sequence[str], df: DataFrame) -> DataFrame:
    """Intercept and coefficients of the linear model."""
    fitted = model.stages[-1]
    rows = [("(intercept)", float(fitted.intercept))]
    rows += [(name, float(w)) for name, w in zip(layout, fitted.coefficients.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def ridge_normal_equations(
    model: PipelineModel, train: DataFrame, layout: Sequence[str], target: str, alpha: float = RIDGE_ALPHA
) -> DataFrame:
    """``feature, gap``: X'(y - Xb) - alpha b per coefficient, as a share of X'|y|, from one pass.

    All gaps are 0 if and only if the coefficients minimise the penalised squares.
    """
    fitted = model.stages[-1]
    x = [quoted(name).cast("double") for name in layout]
    y, weights = quoted(target).cast("double"), [float(w) for w in fitted.coefficients.toArray()]
    residual = y - F.lit(float(fitted.intercept))
    for column, weight in zip(x, weights, strict=True):
        residual = residual - column * F.lit(weight)
    cells = [F.struct(F.lit("(intercept)").alias("feature"), (F.sum("_r") / F.sum(F.abs("_y"))).alias("gap"))]
    for i, (name, weight) in enumerate(zip(layout, weights, strict=True)):
        gap = (F.sum(F.col(f"_x{i}") * F.col("_r")) - F.lit(alpha * weight)) / F.sum(F.abs(F.col(f"_x{i}") * F.col("_y")))
        cells.append(F.struct(F.lit(name).alias("feature"), gap.alias("gap")))
    rows = train.select(residual.alias("_r"), y.alias("_y"), *[c.alias(f"_x{i}") for i, c in enumerate(x)])
    return rows.agg(F.array(*cells).alias("all")).select(F.inline("all"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


