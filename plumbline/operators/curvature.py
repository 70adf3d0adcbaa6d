"""How far the relation of each predictor to the target departs from a straight line."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.durable import SMALL_ROWS, durable, forget, kept
from plumbline.functions.moments import as_numbers, is_constant, per_column
from plumbline.functions.quantiles import BOUNDED_GROUP, counted_quantiles, fit_quantiles
from plumbline.schema import quoted

# Smoothing span, least rows and class limits.
LOWESS_SPAN = 0.25
LEAST_ROWS = 50
CLASSES = ((0.08, "Nearly linear"), (0.16, "Mild curvature"), (0.28, "Moderate curvature"))
STRONGEST = "Strong nonlinear pattern"
CURVED = ("Moderate curvature", "Strong nonlinear pattern")
UNKNOWN = "Insufficient data"
#: Cells of the local regression; rounds of its robust form, and median residuals at which a row's weight ends.
SMOOTH_CELLS = 100
ROBUST_ROUNDS, ROBUST_REACH = 3, 6.0

IMPLICATIONS = {
    "Nearly linear": "Start with a straight line.",
    "Mild curvature": "Start with a straight line and look at one smooth alternative.",
    "Moderate curvature": "Compare polynomial and spline terms.",
    "Strong nonlinear pattern": "A single slope misleads; compare polynomial and spline terms.",
    "Insufficient data": "Too few rows to tell.",
}
SCREEN_CAUTION = "The screen is a first look; validation rows decide."


def classify(score: Column) -> Column:
    chain = F.when(score.isNull() | F.isnan(score), UNKNOWN)
    for limit, label in CLASSES:
        chain = chain.when(score < limit, label)
    return chain.otherwise(STRONGEST)


def implication(label: Column) -> Column:
    chain = F.lit(None).cast("string")
    for name, text in IMPLICATIONS.items():
        chain = F.when(label == name, F.lit(text)).otherwise(chain)
    return chain


def screen_table(scores: DataFrame) -> DataFrame:
    """``feature, score`` turned into the governed screen, strongest curvature first."""
    label = classify(F.col("score"))
    return scores.select(
        "feature",
        F.col("score").alias("deviation_score"),
        label.alias("automated_screen"),
        F.lit("Bin means against the fitted line").alias("visual_evidence"),
        F.lit("Not reviewed").alias("analyst_decision"),
        implication(label).alias("provisional_model_implication"),
        F.lit(SCREEN_CAUTION).alias("caution"),
        label.alias("exploratory_pattern"),
    ).orderBy(F.desc_nulls_last("deviation_score"), "feature")


def _pair(df: DataFrame, feature: str, target: str) -> tuple[Column, Column]:
    x, y = quoted(feature).cast("double"), quoted(target).cast("double")
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def _lines_and_bins(
    df: DataFrame, features: Sequence[str], target: str, bins: int, bounded: int
) -> tuple[DataFrame, DataFrame, dict[str, list[float | None]]]:
    """Straight line of each feature, rows and means of the bins between its exact quantiles, and these."""
    pairs = {f: _pair(df, f, target) for f in features}

    def line(name: str) -> dict[str, Column]:
        x, y = pairs[name]
        slope = F.regr_sxy(y, x) / F.nullif(F.regr_sxx(y, x), F.lit(0.0))
        return {
            "n": F.count(x),
            "flat": is_constant(x) | is_constant(y),
            "deviation_y": F.stddev_samp(y),
            "slope": slope,
            "intercept": F.avg(y) - slope * F.avg(x),
        }

    # One row per feature, read twice below.
    lines = kept(per_column(df, list(features), line, label="feature").drop("position"))
    largest = lines.agg(F.max("n")).first()[0]
    steps = [j / bins for j in range(1, bins)]
    edges = fit_quantiles(df, {f: x for f, (x, _) in pairs.items()}, steps, largest, bounded)
    binned = _with_bins(df, pairs, edges).groupBy("feature", "bin").agg(
        F.count("x").alias("rows_in_bin"), F.avg("x").alias("mean_x"), F.avg("y").alias("mean_y")
    )
    return lines, binned, edges


def _gap_scores(lines: DataFrame, binned: DataFrame, curve: Column) -> DataFrame:
    """RMS gap between the curve at the bins and the straight line, in target deviations."""
    gap = curve - (F.col("intercept") + F.col("slope") * F.col("mean_x"))
    mean_square = (
        binned.join(F.broadcast(lines), "feature")
        .groupBy("feature")
        .agg((F.sum(F.col("rows_in_bin") * gap * gap) / F.sum("rows_in_bin")).alias("mean_square"))
    )
    score = (
        F.when(F.col("n") < LEAST_ROWS, None)
        .when(F.col("flat"), F.lit(0.0))
        .otherwise(F.sqrt("mean_square") / F.nullif(F.col("deviation_y"), F.lit(0.0)))
    )
    return lines.join(mean_square, "feature", "left").select("feature", score.alias("score"))


def binned_scores(
    df: DataFrame, features: Sequence[str], target: str, bins: int = 20, bounded: int = BOUNDED_GROUP
) -> DataFrame:
    """``feature, score`` over all rows.

    The smooth curve is the mean of the target in equal-count bins of the feature;
    the score is the row-weighted RMS gap between it and the fitted line, in target
    deviations. Bin edges are exact quantiles; the rest is two aggregations, the
    second grouped by (feature, bin).
    """
    lines, binned, _ = _lines_and_bins(df, features, target, bins, bounded)
    return _gap_scores(lines, binned, F.col("mean_y"))


def _known(edges: dict[str, list[float | None]], features: Sequence[str]) -> list[np.ndarray]:
    """The edges of each feature, in order and once."""
    return [np.array(sorted({e for e in edges[f] if e is not None})) for f in features]


def _with_bins(
    df: DataFrame, pairs: dict[str, tuple[Column, Column]], edges: dict[str, list[float | None]]
) -> DataFrame:
    """``feature, x, y, bin``: complete pairs with the number of edges below ``x``, found by binary search."""
    known = _known(edges, list(pairs))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, steps in enumerate(known):
                # Both are there or both are NULL.
                x, y = batch.column(2 * i).drop_null(), batch.column(2 * i + 1).drop_null()
                bins = np.searchsorted(steps, x.to_numpy(zero_copy_only=False))
                number = pa.array(np.full(len(x), i), pa.int32())
                yield pa.RecordBatch.from_arrays([number, x, y, pa.array(bins, pa.int32())], names=["number", "x", "y", "bin"])

    sides = [c.alias(f"_{i}_{side}") for i, pair in enumerate(pairs.values()) for side, c in zip("xy", pair)]
    rows = df.select(*sides).mapInArrow(placed, "number int, x double, y double, bin int")
    named = F.get(F.array(*[F.lit(f) for f in pairs]), F.col("number"))
    return rows.select(named.alias("feature"), "x", "y", "bin")


def binned_screen(df: DataFrame, features: Sequence[str], target: str, bins: int = 20) -> DataFrame:
    """Curvature screen over all rows."""
    return screen_table(binned_scores(df, features, target, bins))


def _local_lines(cells: DataFrame, span: float) -> DataFrame:
    """``feature, bin, curve, bend``: value and slope, at the mean of each cell, of the line through the cells around it.

    ``rows_in_bin, mean_x`` place the cells, and the cells around that hold ``span`` of the rows
    count by the tricube of their distance; ``mass, fit_x, fit_y`` are what the line is fitted to.
    """
    # At most (cells + 1)^2 pairs of cells per feature, whatever the number of rows.
    here = cells.select("feature", F.col("bin").alias("place"), F.col("mean_x").alias("x0"))
    pairs = here.join(cells, "feature").withColumn("distance", F.abs(F.col("mean_x") - F.col("x0")))
    nearest = Window.partitionBy("feature", "place").orderBy("distance")
    everything = Window.partitionBy("feature", "place")
    n = F.col("rows_in_bin")
    pairs = pairs.withColumns({"_upto": F.sum(n).over(nearest), "_all": F.sum(n).over(everything)})
    enough = F.when(F.col("_upto") >= F.lit(span) * F.col("_all"), F.col("distance"))
    pairs = pairs.withColumn("reach", F.min(enough).over(everything)).where("distance <= reach")
    near = F.coalesce(F.col("distance") / F.nullif(F.col("reach"), F.lit(0.0)), F.lit(0.0))
    w = F.col("mass") * F.pow(F.lit(1.0) - F.pow(near, F.lit(3.0)), F.lit(3.0))
    d, y = F.col("fit_x") - F.col("x0"), F.col("fit_y")
    sums = {"w": w, "wd": w * d, "wdd": w * d * d, "wy": w * y, "wdy": w * d * y}
    fitted = pairs.where("mass > 0").groupBy("feature", "place").agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    fitted = fitted.withColumn("w", F.nullif("w", F.lit(0.0)))
    spread = F.col("wdd") - F.col("wd") * F.col("wd") / F.col("w")
    slope = (F.col("wdy") - F.col("wd") * F.col("wy") / F.col("w")) / F.nullif(spread, F.lit(0.0))
    flat = spread <= F.lit(1e-12) * F.col("wdd")
    value = F.when(flat, F.col("wy") / F.col("w")).otherwise((F.col("wy") - slope * F.col("wd")) / F.col("w"))
    bend = F.when(flat, F.lit(0.0)).otherwise(slope)
    return fitted.select("feature", F.col("place").alias("bin"), value.alias("curve"), bend.alias("bend"))


def _far(sides: Sequence[np.ndarray], steps: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cell, ``x``, ``y`` of the rows whose cell has a line, and their distance to it.

    ``line`` has for each cell whether it has one, its ``mean_x``, ``curve`` and ``bend``.
    """
    x, y = sides
    cell = np.searchsorted(steps, x)
    there = line[0, cell] > 0
    x, y, cell = x[there], y[there], cell[there]
    _, mean, curve, bend = line[:, cell]
    return cell, x, y, np.abs(y - curve - bend * (x - mean))


def _sides(batch: pa.RecordBatch, feature: int) -> list[np.ndarray]:
    """Both are there or both are NULL."""
    return [batch.column(f"_{feature}_{side}").drop_null().to_numpy(zero_copy_only=False) for side in "xy"]


def _cell_lines(curve: DataFrame, features: Sequence[str], known: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The lines of the cells of each feature, for `_far`."""
    lines = [np.full((4, len(steps) + 1), np.nan) for steps in known]
    for line in lines:
        line[0] = 0.0
    place = {f: i for i, f in enumerate(features)}
    for r in curve.select("feature", "bin", "mean_x", "curve", "bend").collect():
        found = [np.nan if r[c] is None else r[c] for c in ("mean_x", "curve", "bend")]
        lines[place[r["feature"]]][:, r["bin"]] = [1.0, *found]
    return lines


def _reweighted(
    df: DataFrame,
    pairs: dict[str, tuple[Column, Column]],
    known: Sequence[np.ndarray],
    curve: DataFrame,
    sizes: dict[str, int],
    bounded: int,
) -> DataFrame:
    """``feature, bin, mass, fit_x, fit_y``: what cells weigh once rows far from the curve count less.

    A row's residual is its distance to the line of its cell, the scale six times the exact
    median of the residuals' sizes; the weight falls to 0 there (bisquare). Residuals are made
    again by each scan from the lines, a few numbers per cell; sums of cells are shuffled.
    """
    lines = _cell_lines(curve, list(pairs), known)
    inputs = [{f"_{i}_{side}": c for side, c in zip("xy", pair)} for i, pair in enumerate(pairs.values())]

    def read(batch: pa.RecordBatch, i: int) -> np.ndarray:
        far = _far(_sides(batch, i), known[i], lines[i])[-1]
        return far[np.isfinite(far)]

    middles = counted_quantiles(df, inputs, [sizes[f] for f in pairs], [0.5], bounded, read)
    scales = [None if m is None else m[0] * ROBUST_REACH for m in middles]

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((4, len(steps) + 1)) for steps in known]
        for batch in batches:
            for i, scale in enumerate(scales):
                if scale is None:
                    continue
                cell, x, y, far = _far(_sides(batch, i), known[i], lines[i])
                # A missing distance counts as one beyond the scale.
                w = (1.0 - np.fmin(far / scale, 1.0) ** 2) ** 2 if scale > 0 else np.ones(len(x))
                for place, weight in enumerate((None, w, w * x, w * y)):
                    sums[i][place] += np.bincount(cell, weight, sums[i].shape[1])
        for i, found in enumerate(sums):
            held = np.flatnonzero(found[0])
            yield pa.RecordBatch.from_pydict({
                "number": pa.array(np.full(len(held), i), pa.int32()), "bin": pa.array(held, pa.int32()),
                "w": found[1, held], "sx": found[2, held], "sy": found[3, held],
            })

    named = {name: c for sides in inputs for name, c in sides.items()}
    parts = df.select(*[c.alias(name) for name, c in named.items()]).mapInArrow(weighed, "number int, bin int, w double, sx double, sy double")
    feature = F.get(F.array(*[F.lit(f) for f in pairs]), F.col("number")).alias("feature")
    sums = parts.groupBy("number", "bin").agg(F.sum("w").alias("mass"), F.sum("sx").alias("sx"), F.sum("sy").alias("sy"))
    mass = F.nullif("mass", F.lit(0.0))
    return sums.select(feature, "bin", "mass", (F.col("sx") / mass).alias("fit_x"), (F.col("sy") / mass).alias("fit_y"))


def lowess_scores(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    cells: int = SMOOTH_CELLS,
    span: float = LOWESS_SPAN,
    bounded: int = BOUNDED_GROUP,
    rounds: int = 0,
) -> DataFrame:
    """``feature, score`` from a local regression over all rows.

    Rows meet in cells between exact quantiles of the feature, whose counts and means are one
    aggregation. At the mean of each cell a line is fitted to the cells around it that hold
    ``span`` of the rows, with tricube weights by distance times their rows; the curve is the
    value of that line there. The score is the row-weighted RMS gap to the straight line, in
    target deviations, as for the bin means.

    With ``rounds`` the regression is robust: in each round rows are weighed by their distance
    to the curve, cells are summed anew with these weights, and the curve is fitted again. A
    round is an exact median and the sums of the cells, over the columns as numbers, which are
    written once: their rows are read as they are, and a cell is found again by each scan.
    """
    if rounds:
        df = durable(as_numbers(df, list(dict.fromkeys([*features, target]))))
    lines, binned, edges = _lines_and_bins(df, features, target, cells, bounded)
    # A row per cell, read several times.
    small = max(SMALL_ROWS, cells * len(features))
    binned = kept(binned, small)
    plain = binned.withColumns({"mass": F.col("rows_in_bin").cast("double"), "fit_x": F.col("mean_x"), "fit_y": F.col("mean_y")})
    curve = binned.join(_local_lines(plain, span), ["feature", "bin"])
    if not rounds:
        return _gap_scores(lines, curve, F.col("curve"))
    curve, pairs = kept(curve, small), {f: _pair(df, f, target) for f in features}
    sizes, known = {r["feature"]: r["n"] for r in lines.collect()}, _known(edges, features)
    for _ in range(rounds):
        again = kept(binned.join(_reweighted(df, pairs, known, curve, sizes, bounded), ["feature", "bin"]), small)
        found = _local_lines(again, span)
        # Where no row around counts any more, the curve stays.
        earlier = curve.withColumnsRenamed({"curve": "_curve", "bend": "_bend"})
        curve = kept(
            earlier.join(found, ["feature", "bin"], "left").select(
                *binned.columns, F.coalesce("curve", "_curve").alias("curve"),
                F.when(F.col("curve").isNull(), F.col("_bend")).otherwise(F.col("bend")).alias("bend"),
            ),
            small,
        )
    forget(df)
    return _gap_scores(lines, curve, F.col("curve"))


def lowess_screen(df: DataFrame, features: Sequence[str], target: str, **options) -> DataFrame:
    """Curvature screen from the local regression."""
    return screen_table(lowess_scores(df, features, target, **options))


def robust_screen(df: DataFrame, features: Sequence[str], target: str, rounds: int = ROBUST_ROUNDS, **options) -> DataFrame:
    """Curvature screen from the local regression with reweighting rounds."""
    return screen_table(lowess_scores(df, features, target, rounds=rounds, **options))
