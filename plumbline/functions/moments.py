"""Single-pass moments.

Sample skewness and excess kurtosis are the bias-adjusted forms; Spark's built-ins
are the population forms, so they are rescaled here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.schema import quoted

COLUMNS_PER_PASS = 50


def is_constant(value: Column) -> Column:
    """All present values are equal.

    Decided on the extremes: merging partial moments rounds the mean, so the variance
    of a constant column is often a tiny number instead of 0.
    """
    return F.min(value) == F.max(value)


def skewness(value: Column) -> Column:
    """Adjusted skewness; 0 for a constant column, NULL below three values."""
    n = F.count(value).cast("double")
    adjusted = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)) * F.skewness(value)
    return F.when(n < 3, None).when(is_constant(value), F.lit(0.0)).otherwise(adjusted)


def kurtosis(value: Column) -> Column:
    """Adjusted excess kurtosis; 0 for a constant column, NULL below four values."""
    n = F.count(value).cast("double")
    scale = (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0))
    adjusted = scale * ((n + 1) * F.kurtosis(value) + 6)
    return F.when(n < 4, None).when(is_constant(value), F.lit(0.0)).otherwise(adjusted)


def deviation(value: Column) -> Column:
    """Sample standard deviation, NULL below two values."""
    return F.when(is_constant(value) & (F.count(value) > 1), F.lit(0.0)).otherwise(F.stddev_samp(value))


def per_column(
    df: DataFrame,
    columns: Sequence[str],
    measures: Callable[[str], Mapping[str, Column]],
    label: str = "variable",
) -> DataFrame:
    """One row per column from one aggregation over the table.

    ``measures(name)`` gives the aggregates of a column; all columns must give the
    same measure names and types. The aggregate is a single row of structs, turned
    into rows afterwards, so the table is read once per ``COLUMNS_PER_PASS`` columns
    and only partial aggregates are shuffled.
    """
    parts = []
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        chunk = list(columns[start:start + COLUMNS_PER_PASS])
        packed = [
            F.struct(
                F.lit(start + i).alias("position"),
                F.lit(name).alias(label),
                *[measure.alias(key) for key, measure in measures(name).items()],
            )
            for i, name in enumerate(chunk, start=1)
        ]
        parts.append(df.agg(F.array(*packed).alias("all")).select(F.inline("all")))
    if not parts:
        raise ValueError("No columns to aggregate.")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def as_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, as doubles, so that the scan reads nothing else."""
    return df.select(*[quoted(name).cast("double").alias(name) for name in columns])
