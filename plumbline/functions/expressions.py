"""Scalar expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.schema import quoted

INFINITY = float("inf")

# Relative and absolute tolerance of the whole-number test.
WHOLE_RELATIVE = 1e-5
WHOLE_ABSOLUTE = 1e-8


def finite(value: Column) -> Column:
    """NaN and both infinities become NULL (NaN compares above every number)."""
    return F.when(F.abs(value) < F.lit(INFINITY), value)


def to_number(value: Column) -> Column:
    """Number or NULL; text that is no number never fails the job."""
    return finite(value.try_cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is 0 or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 for an empty whole."""
    return F.coalesce(ratio(part, whole) * 100.0, F.lit(0.0))


def is_whole(value: Column, strict: bool = False) -> Column:
    """Whole number within tolerance; NULL stays NULL."""
    number = value.cast("double")
    allowed = F.lit(WHOLE_ABSOLUTE)
    if not strict:
        allowed = allowed + F.lit(WHOLE_RELATIVE) * F.abs(F.rint(number))
    return F.abs(number - F.rint(number)) <= allowed


def right_closed_bin(value: Column, edges: Sequence[float]) -> Column:
    """1-based bin of (e0, e1], (e1, e2], ...; the lowest edge belongs to bin 1.

    Values below the first or above the last edge get NULL.
    """
    if len(edges) < 2 or list(edges) != sorted(set(edges)):
        raise ValueError("Bin edges must be at least two strictly rising numbers.")
    chain = F.when(value.isNull() | F.isnan(value.cast("double")) | (value < F.lit(edges[0])), None)
    for position, upper in enumerate(edges[1:], start=1):
        if upper == INFINITY:
            return chain.otherwise(F.lit(position))
        chain = chain.when(value <= F.lit(upper), F.lit(position))
    return chain


def equal_width_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based equal-width bin; the last bin is closed on the right, NULL has none."""
    width = (high - low) / bins
    place = F.floor((value.cast("double") - F.lit(low)) / F.lit(width)).cast("int")
    return F.when(value.isNotNull(), F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1)))


def seeded_hash(key: Column, seed: int) -> Column:
    """32 hex digits that order rows pseudo-randomly and never change with partitioning."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))


def number_text(number: Column) -> Column:
    """A double as text with all digits that tell it apart, in plain notation such as ``880.0``."""
    full = number.cast("string")
    digits = F.rtrim(full.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    in_range = (F.abs(number) >= F.lit(1e-4)) & (F.abs(number) < F.lit(1e16))
    return F.when(in_range, plain).otherwise(full)


def display_text(df: DataFrame, name: str) -> Column:
    """A value as text."""
    column = quoted(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return number_text(column.cast("double"))
    return column.cast("string")


def guarded_correlation(left: Column, right: Column) -> Column:
    """Pearson r over the rows where both are present; NULL if either is constant there.

    A constant side is recognised by its extremes, because its sum of squares may come
    out as a tiny number instead of 0 when partial sums are merged.
    """
    both = left.isNotNull() & right.isNotNull()
    x, y = F.when(both, left), F.when(both, right)
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    spread = F.sqrt(F.regr_sxx(left, right) * F.regr_syy(left, right))
    return F.when(varies, F.regr_sxy(left, right) / F.nullif(spread, F.lit(0.0)))


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every floating column; turns -0.0 into 0.0. For presentation only."""
    return df.select(
        *[
            (F.round(quoted(f.name), places) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )
