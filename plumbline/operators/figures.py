"""The tables behind charts. Nothing is drawn here."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.expressions import equal_width_bin, seeded_hash
from plumbline.functions.moments import per_column
from plumbline.operators.eda import correlation_matrix
from plumbline.operators.outliers import Fence, fit_fences
from plumbline.schema import numeric_columns, quoted

TARGET_BINS = 50
COLUMN_BINS = 40


def histogram(df: DataFrame, column: str, bins: int = TARGET_BINS) -> DataFrame:
    """Equal-width counts, empty bins included; the last bin is closed on the right.

    A single distinct value gets a range of width 1 centred on it. Two passes over
    one column: the extremes, then counts that are combined before the shuffle.
    """
    value = quoted(column).cast("double")
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_low double, bin_high double, frequency long")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    counts = (
        df.where(value.isNotNull())
        .groupBy(equal_width_bin(value, low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_high"),
        F.coalesce("frequency", F.lit(0)).alias("frequency"),
    )


def boxplot_stats(
    df: DataFrame, columns: Sequence[str] | None = None, fences: dict[str, Fence] | None = None
) -> DataFrame:
    """Quartiles, whiskers (most extreme values inside the fences) and outside count."""
    names = list(columns or numeric_columns(df))
    fences = fences or fit_fences(df, names, robust=False)

    def measures(name: str) -> dict[str, Column]:
        fence, c = fences[name], quoted(name).cast("double")
        inside = F.when(c.isNotNull() & ~fence.outside(c), c)
        return {
            "q1": F.lit(fence.q1).cast("double"),
            "median": F.lit(fence.median).cast("double"),
            "q3": F.lit(fence.q3).cast("double"),
            # A whisker never ends inside the box, even when all values beyond it are outside.
            "whisker_low": F.least(F.min(inside), F.lit(fence.q1).cast("double")),
            "whisker_high": F.greatest(F.max(inside), F.lit(fence.q3).cast("double")),
            "flier_count": F.count_if(fence.outside(c)),
        }

    return per_column(df, names, measures).drop("position")


def heatmap_cells(df: DataFrame, columns: Sequence[str] | None = None, places: int = 3) -> DataFrame:
    """Cells of the correlation heatmap with their place, rounded for display."""
    names = list(columns or numeric_columns(df))
    listed = F.array(*[F.lit(n) for n in names])
    return correlation_matrix(df, names).select(
        F.array_position(listed, F.col("feature_1")).alias("row_index"),
        F.array_position(listed, F.col("feature_2")).alias("column_index"),
        "feature_1",
        "feature_2",
        F.round("correlation", places).alias("correlation"),
    )


def scatter_sample(
    df: DataFrame, row_key: str, columns: Sequence[str], size: int = 5000, seed: int = 42
) -> DataFrame:
    """A repeatable sample for plotting: the ``size`` rows with the smallest seeded key hashes.

    Sampling is the feature. Of a large table a hash threshold lets about four times ``size``
    rows through before the sort; if ever fewer than ``size`` pass it, the next threshold is
    four times as high, so the result never depends on it.
    """
    hashed = seeded_hash(quoted(row_key), seed)
    rows, share = df.count(), 1.0
    if rows > 8 * size:
        share = 4 * size / rows
        while share < 1.0 and df.where(hashed < F.lit(_threshold(share))).count() < size:
            share *= 4
    few = df if share >= 1.0 else df.where(hashed < F.lit(_threshold(share)))
    return few.select(quoted(row_key), *[quoted(c) for c in columns]).orderBy(hashed, quoted(row_key)).limit(size)


def _threshold(share: float) -> str:
    """Hashes below it are about that share of all."""
    return f"{math.ceil(share * 16**12):012x}"


def target_scatter(
    df: DataFrame, row_key: str, target: str, correlations: DataFrame, top: int = 5, size: int = 5000
) -> DataFrame:
    """Sampled points of the target against its most correlated columns."""
    leading = [
        row["feature"]
        for row in correlations.orderBy(F.desc_nulls_last("absolute_correlation"), "feature").limit(top).collect()
    ]
    return scatter_sample(df, row_key, [*leading, target], size)


def grid_map(df: DataFrame, x: str, y: str, value: str, step_x: float, step_y: float) -> DataFrame:
    """Row count and mean value per grid cell: a map whose size depends on the area only."""

    def cell(name: str, step: float) -> Column:
        return F.floor(quoted(name).cast("double") / F.lit(float(step))).cast("int")

    both = quoted(x).isNotNull() & quoted(y).isNotNull()
    return (
        df.where(both)
        .groupBy(cell(x, step_x).alias("cell_x"), cell(y, step_y).alias("cell_y"))
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.avg(quoted(value).cast("double")).alias("mean_value"),
        )
    )
