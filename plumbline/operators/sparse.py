"""Model inputs of any number of levels: a sparse row layout with a table of its places.

Numbers come first, then one place for each training level beyond the first of every
categorical column, as in the dense encoding of ``prep``. Where that has a column for each
level, here a row holds the places of its levels only, and the layout is a table (column
number, level, place), not a list in the driver. Levels are numbered over ranges of their
order and looked up by one join for each categorical column, broadcast up to a counted size
and dealt beyond. Only the number of levels of each column reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.durable import durable, forget
from plumbline.functions.joins import attach, numbered
from plumbline.functions.quantiles import BOUNDED_GROUP
from plumbline.operators.features import ratio_features
from plumbline.operators.models import RIDGE_ALPHA, regression_metrics, ridge_estimator
from plumbline.operators.prep import coerce_numeric, drop_null_target, fit_medians, median_impute, selected_features
from plumbline.schema import Ratio, quoted, require_columns, require_rows, string_columns

#: Places up to which normal equations are solved in the driver; more are fitted by descent.
NORMAL_PLACES = 4096
#: Places beside the widest category up to which its levels are eliminated exactly instead.
REST_PLACES = 32
#: Steps and tolerance of the descent.
DESCENT_STEPS, DESCENT_TOLERANCE = 1000, 1e-13


@dataclass(frozen=True)
class SparseLayout:
    """Places of the numbers and of the levels; ``levels``: category, level, level_number (from 0), place.

    The first level of a category is its baseline: level number 0, no place.
    """

    numbers: tuple[str, ...]
    categories: tuple[str, ...]
    counts: tuple[int, ...]
    levels: DataFrame

    @property
    def size(self) -> int:
        return len(self.numbers) + sum(max(0, n - 1) for n in self.counts)

    def starts(self) -> list[int]:
        """Place of the first level beyond the baseline, for each category."""
        places, at = [], len(self.numbers)
        for count in self.counts:
            places.append(at)
            at += max(0, count - 1)
        return places

    def features(self) -> DataFrame:
        """``place, feature``: names as the dense encoding makes them."""
        spark = self.levels.sparkSession
        plain = spark.createDataFrame(list(enumerate(self.numbers)), "place long, feature string")
        named = F.element_at(F.array(*[F.lit(c) for c in self.categories] or [F.lit("")]), F.col("category") + 1)
        made = self.levels.where("place is not null").select("place", F.concat_ws("_", named, "level").alias("feature"))
        return plain.unionByName(made)


def fit_layout(train: DataFrame, numbers: Sequence[str], categories: Sequence[str]) -> SparseLayout:
    """Number the training levels of each categorical column in their order; NULL is no level."""
    require_columns(train, [*numbers, *categories], "sparse layout")
    cells = [F.struct(F.lit(i).alias("category"), quoted(c).cast("string").alias("level")) for i, c in enumerate(categories)]
    if not cells:
        none = train.sparkSession.createDataFrame([], "category int, level string, level_number long, place long")
        return SparseLayout(tuple(numbers), (), (), none)
    pairs = train.select(F.inline(F.array(*cells))).where(F.col("level").isNotNull()).distinct()
    levels = numbered(pairs, ["category"], ["level"], "level_number")
    sizes = {r["category"]: r["count"] for r in levels.groupBy("category").count().collect()}
    counts = tuple(sizes.get(i, 0) for i in range(len(categories)))
    layout = SparseLayout(tuple(numbers), tuple(categories), counts, levels)
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in layout.starts()]), F.col("category") + 1)
    placed = levels.withColumn("place", F.when(F.col("level_number") > 0, start + F.col("level_number") - 1))
    return SparseLayout(layout.numbers, layout.categories, counts, placed)


def level_numbers(df: DataFrame, layout: SparseLayout, keep: Sequence[str] = ()) -> DataFrame:
    """``keep...`` and for each category ``<name>_level_number``, NULL for an unseen level and for NULL."""
    found = _looked_up(df.select(*map(quoted, keep), *map(quoted, layout.categories)), layout, "level_number")
    return found.select(*map(quoted, keep), *[F.col(f"_p{i}").alias(f"{c}_level_number") for i, c in enumerate(layout.categories)])


def _looked_up(df: DataFrame, layout: SparseLayout, value: str) -> DataFrame:
    """The rows with ``_p<i>``: what the layout says of the level of category i."""
    rows = df
    # A hash of the whole row deals the rows of a frequent level.
    deal = [quoted(c) for c in df.columns]
    for i, name in enumerate(layout.categories):
        side = layout.levels.where(F.col("category") == i).select(F.col("level").alias(f"_l{i}"), F.col(value).alias(f"_p{i}"))
        rows = rows.withColumn(f"_l{i}", quoted(name).cast("string"))
        rows = attach(rows, side, [f"_l{i}"], deal, layout.counts[i]).drop(f"_l{i}")
    return rows


def sparse_rows(df: DataFrame, layout: SparseLayout, keep: Sequence[str] = ()) -> DataFrame:
    """``keep...`` and ``features``, a sparse vector of the layout, written once for the passes that follow.

    Numbers must be present (imputed); the baseline, unseen levels and NULL have no entry.
    """
    require_columns(df, [*keep, *layout.numbers, *layout.categories], "sparse encoding")
    held = df.select(*map(quoted, dict.fromkeys([*keep, *layout.numbers, *layout.categories])))
    rows = _looked_up(held, layout, "place")
    cells = [
        F.struct(F.lit(i).alias("place"), quoted(n).cast("double").alias("value")) for i, n in enumerate(layout.numbers)
    ] + [F.struct(F.col(f"_p{i}").cast("int").alias("place"), F.lit(1.0).alias("value")) for i in range(len(layout.categories))]
    kept = F.filter(F.array(*cells), lambda x: x["place"].isNotNull() & (x["value"] != 0))
    rows = rows.withColumn("_cells", kept)
    # The fields of a sparse vector; read back under its type, so no row passes through Python.
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(layout.size).alias("size"),
        F.transform("_cells", lambda x: x["place"]).alias("indices"), F.transform("_cells", lambda x: x["value"]).alias("values"),
    )
    written = durable(rows.select(*map(quoted, keep), vector.alias("features")))
    kinds = [T.StructField(f.name, f.dataType) for f in written.schema.fields if f.name != "features"]
    schema = T.StructType([*kinds, T.StructField("features", VectorUDT())])
    folder = written.inputFiles()[0].rsplit("/", 1)[0] if written.inputFiles() else None
    if folder is None:
        return written.sparkSession.createDataFrame([], schema)
    return written.sparkSession.read.schema(schema).parquet(folder)


@dataclass(frozen=True)
class SparsePreparation:
    """What `prep.Preparation` learns, with the sparse layout instead of one column per level."""

    selected: tuple[str, ...]
    target: str
    ratios: tuple[Ratio, ...]
    layout: SparseLayout
    medians: dict[str, float | None]

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep...``, ``features`` and the target of the rows that have one."""
        shaped = selected_features(ratio_features(df, self.ratios), self.selected, self.target, keep)
        shaped = drop_null_target(coerce_numeric(shaped, [self.target]), self.target)
        shaped = median_impute(coerce_numeric(shaped, self.layout.numbers), self.medians)
        return sparse_rows(shaped, self.layout, [*keep, self.target])


def fit_sparse_preparation(
    train: DataFrame, selected: Sequence[str], target: str, ratios: Sequence[Ratio] = (), bounded: int = BOUNDED_GROUP
) -> SparsePreparation:
    """Learn levels and medians from the training rows that have a target; any number of levels."""
    chosen = selected_features(ratio_features(train, ratios), selected, target)
    chosen = drop_null_target(coerce_numeric(chosen, [target]), target)
    categories = [n for n in string_columns(chosen) if n != target]
    numbers = [n for n in selected if n not in categories and n != target]
    layout = fit_layout(chosen, numbers, categories)
    medians = fit_medians(coerce_numeric(chosen, numbers), numbers, bounded)
    return SparsePreparation(tuple(n for n in selected if n != target), target, tuple(ratios), layout, medians)


@dataclass(frozen=True)
class LevelledRidge:
    """Ridge of one wide category beside a few places: ``levels`` (place, coefficient) is a written table of ``count`` rows.

    Places without a training row are not in the table; their coefficient is 0.
    """

    intercept: float
    rest: tuple[tuple[int, float], ...]
    span: tuple[int, int]
    levels: DataFrame
    count: int

    def forget(self) -> None:
        """Delete the table of a model that is not needed any more."""
        forget(self.levels)


def _widest(layout: SparseLayout) -> tuple[int, int]:
    """First place of the category with most levels, and the place after its last."""
    return max(((s, s + max(0, n - 1)) for s, n in zip(layout.starts(), layout.counts)), key=lambda s: s[1] - s[0], default=(0, 0))


def _opened(span: tuple[int, int], rest: Sequence[int]) -> tuple[Column, list[Column]]:
    """Of a sparse row the place within the span, or NULL, and the values at the other places."""
    cells = F.unwrap_udt("features")
    level = F.get(F.filter(cells["indices"], lambda i: (i >= span[0]) & (i < span[1])), F.lit(0))
    held = F.map_from_arrays(cells["indices"], cells["values"])
    return level, [F.coalesce(F.get(F.map_values(F.map_filter(held, lambda k, _: k == p)), F.lit(0)), F.lit(0.0)) for p in rest]


def _gram(df: DataFrame, weight: Column, columns: Sequence[Column]) -> np.ndarray:
    """Weighted products of all pairs of a few columns, added up by tasks."""
    width = len(columns)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            w, *x = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            x = np.array(x)
            total += (x * w) @ x.T
        i, j = np.indices((width, width), dtype=np.int32)
        yield pa.RecordBatch.from_arrays([i.ravel(), j.ravel(), total.ravel()], names=["i", "j", "v"])

    named = [weight.cast("double").alias("_w"), *[c.cast("double").alias(f"_{i}") for i, c in enumerate(columns)]]
    found = np.zeros((width, width))
    for r in df.select(*named).mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        found[r["i"], r["j"]] = r["v"]
    return found


def _fit_levelled(rows: DataFrame, target: str, alpha: float, size: int, span: tuple[int, int]) -> LevelledRidge:
    """Normal equations without the levels of the span, which follow from what is left.

    A level of n rows has the coefficient (sum of y - sums of the other columns times their
    coefficients) / (n + alpha). Put into the equations of the intercept and the other places, a
    system of their number remains, which one pass over the rows and one over the levels build.
    """
    rest = [p for p in range(size) if not span[0] <= p < span[1]]
    level, values = _opened(span, rest)
    y = quoted(target).cast("double")
    plain = rows.where(y.isNotNull()).select(level.alias("_level"), y.alias("_y"), *[v.alias(f"_z{i}") for i, v in enumerate(values)])
    # Values are counted from their means: products of far-off values would lose their last digits.
    names = ["_y", *[f"_z{i}" for i in range(len(rest))]]
    means = [float(m) for m in plain.agg(*[F.avg(n) for n in names]).first()]
    moved = plain.select("_level", *[(F.col(n) - F.lit(m)).alias(n) for n, m in zip(names, means)])
    sums = moved.where("_level IS NOT NULL").groupBy("_level")
    levels = durable(sums.agg(F.count(F.lit(1)).cast("double").alias("_one"), *[F.sum(n).alias(n) for n in names]))
    order = ["_one", *names[1:], "_y"]
    whole = _gram(moved.withColumn("_one", F.lit(1.0)), F.lit(1.0), [F.col(n) for n in order])
    left = whole - _gram(levels, 1.0 / (F.col("_one") + F.lit(float(alpha))), [F.col(n) for n in order])
    left[range(1, len(rest) + 1), range(1, len(rest) + 1)] += alpha
    solved = np.linalg.lstsq(left[:-1, :-1], left[:-1, -1], rcond=None)[0]
    known = F.lit(0.0)
    for n, weight in zip(order, solved):
        known = known + F.col(n) * F.lit(float(weight))
    weight = (F.col("_y") - known) / (F.col("_one") + F.lit(float(alpha)))
    table = durable(levels.select(F.col("_level").cast("long").alias("place"), weight.alias("coefficient")))
    count = table.count()
    forget(levels)
    intercept = float(solved[0]) + means[0] - float(np.dot(solved[1:], means[1:]))
    return LevelledRidge(intercept, tuple(zip(rest, map(float, solved[1:]))), span, table, count)


def fit_ridge(
    rows: DataFrame, target: str, alpha: float = RIDGE_ALPHA, layout: SparseLayout | None = None
) -> LinearRegressionModel | LevelledRidge:
    """Ridge on sparse rows, the penalty on the raw scale as in the dense fit.

    Up to a few thousand places by normal equations. Beyond, where the ``layout`` is given and has
    few places beside its widest category, the levels of that are eliminated, and their
    coefficients are a table. All else goes by descent, which moves one dense vector of
    coefficients between tasks and driver and scales the label by its sample deviation.
    """
    require_rows(rows, "training")
    size = len(rows.select("features").first()[0])
    if layout is not None and size > NORMAL_PLACES:
        span = _widest(layout)
        if alpha > 0 and size - (span[1] - span[0]) <= REST_PLACES:
            return _fit_levelled(rows, target, alpha, size, span)
    estimator: LinearRegression = ridge_estimator(rows, target, alpha)
    if size > NORMAL_PLACES:
        count, spread = rows.agg(F.count(quoted(target)), F.stddev_samp(quoted(target).cast("double"))).first()
        estimator = estimator.setSolver("l-bfgs").setMaxIter(DESCENT_STEPS).setTol(DESCENT_TOLERANCE)
        estimator = estimator.setRegParam(alpha * (spread or 0.0) / count)
    return estimator.fit(rows)


def predict_rows(model: LinearRegressionModel | LevelledRidge, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep...`` and ``prediction`` of sparse rows."""
    if not isinstance(model, LevelledRidge):
        return model.transform(rows).select(*map(quoted, keep), "prediction")
    level, values = _opened(model.span, [p for p, _ in model.rest])
    known = F.lit(model.intercept)
    for value, (_, weight) in zip(values, model.rest):
        known = known + value * F.lit(weight)
    opened = rows.select(*map(quoted, keep), known.alias("_known"), level.cast("long").alias("_place"))
    side = model.levels.select(F.col("place").alias("_place"), F.col("coefficient").alias("_weight"))
    found = attach(opened, side, ["_place"], [*map(quoted, keep), F.col("_known")], model.count)
    return found.select(*map(quoted, keep), (F.col("_known") + F.coalesce("_weight", F.lit(0.0))).alias("prediction"))


def ridge_coefficients(model: LinearRegressionModel | LevelledRidge, layout: SparseLayout) -> DataFrame:
    """``place, feature, coefficient``, the intercept at place -1."""
    spark = layout.levels.sparkSession
    schema = "place long, coefficient double"
    if isinstance(model, LevelledRidge):
        held = model.levels.unionByName(spark.createDataFrame(list(model.rest), schema))
        named = layout.features().join(held, "place", "left").withColumn("coefficient", F.coalesce("coefficient", F.lit(0.0)))
    else:
        # One vector of the model's size.
        weights = [(i, float(w)) for i, w in enumerate(model.coefficients.toArray())]
        named = layout.features().join(spark.createDataFrame(weights, schema), "place")
    return named.unionByName(
        spark.createDataFrame([(-1, "(intercept)", float(model.intercept))], "place long, feature string, coefficient double")
    )


def score_rows(model: LinearRegressionModel | LevelledRidge, rows: DataFrame, target: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R-squared of sparse rows, optionally per group."""
    scored = predict_rows(model, rows, [*by, target])
    return regression_metrics(scored, target, "prediction", by)


def drop_rows(rows: DataFrame) -> None:
    """Delete the table written by `sparse_rows`."""
    forget(rows)
