"""Outlier fences, robust scores and the rows they flag."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.expressions import percentage
from plumbline.functions.moments import per_column
from plumbline.functions.quantiles import BOUNDED_GROUP, fit_quantiles
from plumbline.schema import numeric_columns, quoted

# Fixed values of the two outlier rules.
FENCE = 1.5
MAD_SCALE = 0.6745
ROBUST_LIMIT = 3.5


@dataclass(frozen=True)
class Fence:
    """Thresholds of one column, learned once and applied as literals."""

    q1: float | None
    median: float | None
    q3: float | None
    mad: float | None = None

    @property
    def iqr(self) -> float | None:
        return None if self.q1 is None else self.q3 - self.q1

    @property
    def lower(self) -> float | None:
        return None if self.q1 is None else self.q1 - FENCE * self.iqr

    @property
    def upper(self) -> float | None:
        return None if self.q1 is None else self.q3 + FENCE * self.iqr

    def outside(self, value: Column) -> Column:
        if self.q1 is None:
            return F.lit(False)
        beyond = (value < F.lit(self.lower)) | (value > F.lit(self.upper))
        return F.coalesce(beyond, F.lit(False))

    def score(self, value: Column) -> Column:
        """Modified z-score; NULL where the median deviation is 0 or unknown."""
        if not self.mad:
            return F.lit(None).cast("double")
        return F.lit(MAD_SCALE) * (value - F.lit(self.median)) / F.lit(self.mad)

    def extreme(self, value: Column) -> Column:
        return F.coalesce(F.abs(self.score(value)) > ROBUST_LIMIT, F.lit(False))


def fit_fences(
    df: DataFrame, columns: Sequence[str], robust: bool = True, bounded: int = BOUNDED_GROUP
) -> dict[str, Fence]:
    """Quartiles and, if ``robust``, the median absolute deviation of each column.

    Two quantile fits over the columns at once; the driver gets a few numbers per
    column.
    """
    sized = df.agg(*[F.count(quoted(n)).alias(n) for n in columns]).first()
    largest = max(sized) if sized else 0
    quartiles = fit_quantiles(df, list(columns), [0.25, 0.5, 0.75], largest, bounded)
    if not robust:
        return {n: Fence(*q) for n, q in quartiles.items()}
    centred = {
        n: F.abs(quoted(n).cast("double") - F.lit(q[1])) for n, q in quartiles.items() if q[1] is not None
    }
    spreads = fit_quantiles(df, centred, [0.5], largest, bounded) if centred else {}
    return {n: Fence(*q, spreads.get(n, [None])[0]) for n, q in quartiles.items()}


def outlier_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    fences: dict[str, Fence] | None = None,
    robust: bool = True,
) -> DataFrame:
    """Flag counts per column as a share of all rows, most affected first.

    The counting pass is a single aggregation with literal thresholds.
    """
    names = list(columns or numeric_columns(df))
    fences = fences or fit_fences(df, names, robust)

    def measures(name: str) -> dict[str, Column]:
        fence, c = fences[name], quoted(name).cast("double")
        number = lambda x: F.lit(x).cast("double")
        by_fence, by_score = fence.outside(c), fence.extreme(c)
        found = {
            "q1": number(fence.q1),
            "q3": number(fence.q3),
            "iqr": number(fence.iqr),
            "iqr_lower_bound": number(fence.lower),
            "iqr_upper_bound": number(fence.upper),
            "iqr_flag_count": F.count_if(by_fence),
        }
        if robust:
            found["modified_z_flag_count"] = F.count_if(by_score)
        found["combined_flag_count"] = F.count_if(by_fence | by_score) if robust else F.count_if(by_fence)
        found["row_total"] = F.count(F.lit(1))
        return found

    counted = per_column(df, names, measures)
    share = percentage(F.col("combined_flag_count"), F.col("row_total"))
    return (
        counted.withColumn("combined_flag_percentage", share)
        .drop("position", "row_total")
        .orderBy(F.desc("combined_flag_percentage"), "variable")
    )


def outlier_iqr_only(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fence rule alone: count and share per column."""
    return outlier_summary(df, columns, robust=False).select(
        "variable", "combined_flag_count", "combined_flag_percentage"
    )


def outlier_observations(
    df: DataFrame, columns: Sequence[str] | None = None, fences: dict[str, Fence] | None = None
) -> DataFrame:
    """Every flagged (row, column) with flags, score and the whole row, in one scan."""
    names = list(columns or numeric_columns(df))
    fences = fences or fit_fences(df, names)
    cells = []
    for name in names:
        fence, c = fences[name], quoted(name).cast("double")
        by_fence, by_score = fence.outside(c), fence.extreme(c)
        cells.append(
            F.when(
                by_fence | by_score,
                F.struct(
                    F.lit(name).alias("outlier_variable"),
                    by_fence.alias("iqr_flag"),
                    by_score.alias("modified_z_flag"),
                    fence.score(c).alias("modified_z_score"),
                ),
            )
        )
    flagged = df.select(F.array_compact(F.array(*cells)).alias("_flags"), *[quoted(c) for c in df.columns])
    return flagged.where(F.size("_flags") > 0).select(F.inline("_flags"), *[quoted(c) for c in df.columns])
