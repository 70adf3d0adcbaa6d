"""Exploratory statistics: distribution, association, target by category."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.expressions import finite, guarded_correlation, percentage
from plumbline.functions.moments import deviation, kurtosis, per_column, skewness
from plumbline.functions.quantiles import grouped_quantiles, quantile_table
from plumbline.operators.profile import distinct_with_examples
from plumbline.schema import SemanticSchema, numeric_columns, quoted

# Fixed values of the shape and association classes.
SYMMETRIC_SKEW = 0.5
HIGH_PAIRWISE = 0.80
STRENGTHS = (
    (0.50, "Strong marginal linear association"),
    (0.20, "Moderate marginal linear association"),
    (0.10, "Weak marginal linear association"),
)
WEAKEST = "Very weak marginal linear association"

#: Pairs that are summed by aggregations; rows whose means are the shifts; rounding left by a constant column.
PAIRS_PER_PASS, SHIFT_ROWS, CONSTANT_SHARE = 120, 1000, 1e-12
#: Pairs of one aggregation: each has 14 partial sums, and Spark compiles a step of at most 100 fields.
PAIRS_AT_ONCE = 5
#: Columns of a tile of a Gram matrix and of what it is multiplied with in one read; rows multiplied at once.
TILE, STRIP, GRAM_ROWS = 512, 1024, 1024


def distribution_shape(skew: Column) -> Column:
    return (
        F.when(F.abs(skew) < SYMMETRIC_SKEW, "Approximately symmetric")
        .when(skew > 0, "Right-skewed")
        .otherwise("Left-skewed")
    )


def moment_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts and moments of each column from one pass."""

    def measures(name: str) -> dict[str, Column]:
        c = quoted(name).cast("double")
        return {
            "row_total": F.count(F.lit(1)),
            "observations": F.count(c),
            "mean": F.avg(c),
            "standard_deviation": deviation(c),
            "minimum": F.min(c),
            "maximum": F.max(c),
            "skewness": skewness(c),
            "kurtosis": kurtosis(c),
        }

    return per_column(df, columns, measures)


def distribution_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Location, spread and shape of each numeric column."""
    names = list(columns or numeric_columns(df))
    medians = quantile_table(df, names, {"median": 0.5})
    return moment_table(df, names).join(F.broadcast(medians), "variable", "left").select(
        "variable",
        "observations",
        (F.col("row_total") - F.col("observations")).alias("missing_count"),
        "mean",
        "median",
        "standard_deviation",
        "minimum",
        "maximum",
        "skewness",
        "kurtosis",
        distribution_shape(F.col("skewness")).alias("distribution_shape"),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, places: int = 3) -> DataFrame:
    """Count, mean, quartiles, extremes and gaps, rounded."""
    names = list(columns or numeric_columns(df))
    quartiles = quantile_table(df, names, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    joined = moment_table(df, names).join(F.broadcast(quartiles), "variable", "left")
    shown = [
        F.col("observations").alias("value_count"),
        F.col("mean"),
        F.col("median"),
        F.col("standard_deviation").alias("std"),
        F.col("minimum").alias("min"),
        F.col("q25"),
        F.col("median").alias("q50"),
        F.col("q75"),
        F.col("maximum").alias("max"),
    ]
    picked = joined.select("variable", *shown, (F.col("row_total") - F.col("observations")).alias("missing"))
    numbers = ["mean", "median", "std", "min", "q25", "q50", "q75", "max"]
    return picked.withColumns({n: F.round(n, places) for n in numbers})


def target_statistics(df: DataFrame, target: str, places: int = 3) -> DataFrame:
    """Six statistics of the target, one per row."""
    medians = quantile_table(df, [target], {"median": 0.5})
    wide = moment_table(df, [target]).join(F.broadcast(medians), "variable", "left")
    named = {
        "Mean": "mean", "Median": "median", "Standard Deviation": "standard_deviation",
        "Minimum": "minimum", "Maximum": "maximum", "Skewness": "skewness",
    }
    rows = F.array(
        *[F.struct(F.lit(k).alias("statistic"), F.round(v, places).alias("value")) for k, v in named.items()]
    )
    return wide.select(F.inline(rows))


def variable_summary(df: DataFrame, schema: SemanticSchema, row_key: str) -> DataFrame:
    """Role, meaning, counts, examples and moments of every schema column of the table."""
    names = [n for n in df.columns if n in schema]
    numeric = [n for n in names if n in set(numeric_columns(df))]
    declared = schema.to_frame(df.sparkSession).select("column_name", "role", "semantic_type")
    counted = per_column(
        df,
        names,
        lambda n: {
            "observed_type": F.lit(df.schema[n].dataType.simpleString()),
            "observations": F.count(F.lit(1)),
            "non_missing_count": F.count(quoted(n)),
        },
        label="column_name",
    )
    moments = distribution_summary(df, numeric).select(
        F.col("variable").alias("column_name"),
        "minimum", "maximum", "mean", "median", "standard_deviation", "skewness", "kurtosis",
    )
    missing = F.col("observations") - F.col("non_missing_count")
    return (
        # Every table joined here has one row per column of the schema.
        counted.join(F.broadcast(declared), "column_name", "left")
        .join(F.broadcast(distinct_with_examples(df, row_key, names)), "column_name", "left")
        .join(F.broadcast(moments), "column_name", "left")
        .select(
            "column_name", "role", "semantic_type", "observed_type", "observations", "non_missing_count",
            missing.alias("missing_count"),
            percentage(missing, F.col("observations")).alias("missing_percentage"),
            F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
            F.coalesce("example_values", F.lit("")).alias("example_values"),
            "minimum", "maximum", "mean", "median", "standard_deviation", "skewness", "kurtosis",
        )
    )


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``feature_1, feature_2, correlation`` for each pair in column order, NULL pairs left out.

    Only sums are shuffled.
    """
    names = list(columns or numeric_columns(df))
    if len(names) < 2:
        raise ValueError("Correlation needs at least two numeric columns.")
    return _cells(df, names, list(combinations(range(len(names)), 2)))


def _cells(df: DataFrame, names: list[str], pairs: list[tuple[int, int]], tile: int | None = None) -> DataFrame:
    """Correlation of the given index pairs; a column with itself gives 1, or NULL if constant.

    Few pairs are sums of small aggregations, each with its scan; many are tiles of Gram matrices.
    """
    if len(pairs) > PAIRS_PER_PASS:
        return _gram_cells(df, names, pairs, tile)
    cells = []
    for a, b in pairs:
        left, right = quoted(names[a]).cast("double"), quoted(names[b]).cast("double")
        value = guarded_correlation(left, right) if a != b else F.when(F.min(left) < F.max(left), F.lit(1.0))
        cells.append(
            F.struct(
                F.lit(a).alias("position_1"),
                F.lit(b).alias("position_2"),
                F.lit(names[a]).alias("feature_1"),
                F.lit(names[b]).alias("feature_2"),
                value.alias("correlation"),
            )
        )
    parts = [df.agg(F.array(*cells[at:at + PAIRS_AT_ONCE]).alias("all")) for at in range(0, len(cells), PAIRS_AT_ONCE)]
    return reduce(DataFrame.unionByName, parts).select(F.inline("all"))


def _gram_cells(df: DataFrame, names: list[str], pairs: list[tuple[int, int]], tile: int | None = None) -> DataFrame:
    """Correlations from tiles of Gram matrices that tasks build of their rows and that are added up by cell.

    Columns are cut into tiles. A read of the table covers one row of tiles: the columns of one
    tile against themselves and the later columns, so it scans those columns only. Where they
    are more than a strip, each strip of them is a read of its own. A task holds six sums of
    tile x strip cells and a batch of tile + strip columns, whatever the number of columns.
    Up to a tile of columns the table is read once, up to a strip once for each tile.
    Each read is made by as many tasks as there are cores, which bounds the partial sums that
    are shuffled, whatever the size of the table.

    A column is shifted by its mean over the first rows, so that sums of squares keep their
    digits; the shift cancels out. Gaps count pairwise: a masked value is 0 in the products,
    and the mask enters the counts.
    """
    tile = tile or TILE
    columns = [finite(quoted(n).cast("double")).alias(f"c{i}") for i, n in enumerate(names)]
    numbers = df.select(*columns)
    shift = _first_means(numbers)
    tasks = max(1, df.sparkSession.sparkContext.defaultParallelism)

    def gram(left: range, right: range):
        def build(batches):
            import numpy as np
            import pyarrow as pa

            wide, size = len(left), len(right)
            own = np.array([shift[i] for i in dict.fromkeys([*left, *right])])
            totals = np.zeros((6, wide, size))
            for rows in (batch.slice(at, GRAM_ROWS) for batch in batches for at in range(0, batch.num_rows, GRAM_ROWS)):
                held = [np.asarray(c.to_numpy(zero_copy_only=False), dtype=float) for c in rows.columns]
                x = np.column_stack(held) - own
                known = ~np.isnan(x)
                x, m = np.where(known, x, 0.0), known.astype(float)
                a, here, b, there = x[:, :wide].T, m[:, :wide].T, x[:, -size:], m[:, -size:]
                # n, sum of a, sum of b, sum of a^2, sum of b^2, sum of a*b over the rows that have both.
                totals[0] += here @ there
                totals[1] += a @ there
                totals[2] += here @ b
                totals[3] += (a * a) @ there
                totals[4] += here @ (b * b)
                totals[5] += a @ b
            for row, i in enumerate(left):
                first = max(i, right.start)
                yield pa.record_batch(
                    [
                        pa.array(np.full(right.stop - first, i, np.int32)),
                        pa.array(np.arange(first, right.stop, dtype=np.int32)),
                        *[pa.array(total[row, first - right.start :]) for total in totals],
                    ],
                    names=["i", "j", "n", "sa", "sb", "saa", "sbb", "sab"],
                )

        return build

    schema = "i int, j int, n double, sa double, sb double, saa double, sbb double, sab double"
    parts = None
    for start in range(0, len(names), tile):
        left = range(start, min(start + tile, len(names)))
        for other in range(start, len(names), max(STRIP, tile)):
            right = range(other, min(other + max(STRIP, tile), len(names)))
            columns = [f"c{i}" for i in dict.fromkeys([*left, *right])]
            made = numbers.select(*columns).coalesce(tasks).mapInArrow(gram(left, right), schema)
            parts = made if parts is None else parts.unionByName(made)
    added = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    n = F.nullif(F.col("n"), F.lit(0.0))
    aa, bb = F.col("saa") - F.col("sa") * F.col("sa") / n, F.col("sbb") - F.col("sb") * F.col("sb") / n
    ab = F.col("sab") - F.col("sa") * F.col("sb") / n
    # A constant column leaves rounding only.
    varies = (aa > CONSTANT_SHARE * F.col("saa")) & (bb > CONSTANT_SHARE * F.col("sbb"))
    value = F.when(varies, F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(ab / F.sqrt(aa * bb)))
    listed = F.array(*[F.lit(name) for name in names])
    wanted = added if len(pairs) > len(names) * (len(names) - 1) // 2 else added.where("i < j")
    return wanted.select(
        F.col("i").alias("position_1"),
        F.col("j").alias("position_2"),
        F.element_at(listed, F.col("i") + 1).alias("feature_1"),
        F.element_at(listed, F.col("j") + 1).alias("feature_2"),
        value.alias("correlation"),
    )


def _first_means(numbers: DataFrame) -> list[float]:
    """Mean of each column over the first rows, 0 where they have none."""
    import numpy as np

    first = numbers.limit(SHIFT_ROWS).toArrow()
    means = []
    for column in first.columns:
        values = np.asarray(column.to_numpy(zero_copy_only=False), dtype=float)
        values = values[~np.isnan(values)]
        means.append(float(values.mean()) if len(values) else 0.0)
    return means


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, tile: int | None = None) -> DataFrame:
    """Every ordered pair in long form; the diagonal is 1, or NULL for a constant column."""
    names = list(columns or numeric_columns(df))
    upper = _cells(df, names, list(combinations_with_replacement(range(len(names)), 2)), tile)
    # Each cell above the diagonal also yields its mirror image, without a second scan.
    sides = F.array(
        F.struct("feature_1", "feature_2"),
        F.when(
            F.col("position_1") != F.col("position_2"),
            F.struct(F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2")),
        ),
    )
    return upper.select(F.inline(F.array_compact(sides)), "correlation")


def target_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation of each numeric column with the target, strongest first."""
    names = [n for n in (columns or numeric_columns(df)) if n != target]
    t = quoted(target).cast("double")
    table = per_column(
        df, names, lambda n: {"correlation_with_target": guarded_correlation(quoted(n).cast("double"), t)}, "feature"
    )
    strength = F.abs("correlation_with_target")
    return table.select(
        "feature", "correlation_with_target", strength.alias("absolute_correlation")
    ).orderBy(F.desc_nulls_last("absolute_correlation"), "feature")


def association_strength(correlation: Column) -> Column:
    """Verbal strength of a correlation; the caller decides what a missing one means."""
    size = F.abs(correlation)
    chain = F.when(size.isNull(), "Not applicable")
    for limit, label in STRENGTHS:
        chain = chain.when(size >= limit, label)
    return chain.otherwise(WEAKEST)


def correlation_screen(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, threshold: float = HIGH_PAIRWISE
) -> DataFrame:
    """Predictor pairs whose correlation reaches the threshold, with what that implies."""
    predictors = [n for n in (columns or numeric_columns(df)) if n != target]
    pairs = correlation_pairs(df, predictors).where(F.abs("correlation") >= threshold)
    # Wording of the screen.
    return pairs.select(
        "feature_1",
        "feature_2",
        "correlation",
        F.abs("correlation").alias("absolute_correlation"),
        F.lit("High pairwise association").alias("eda_interpretation"),
        F.lit(
            "Retain initially. Predictive models may use both variables if validation performance benefits."
        ).alias("machine_learning_implication"),
        F.lit(
            "Do not remove at EDA stage. Assess VIF, condition number, estimability, "
            "and theory before coefficient interpretation."
        ).alias("inferential_implication"),
    )


def categorical_target_summary(df: DataFrame, categories: Sequence[str], target: str) -> DataFrame:
    """Target count, mean, median and deviation per category level; NULL is a level.

    All categorical columns are handled in one scan of (column, level, target) rows.
    """
    cells = [
        F.struct(F.lit(c).alias("categorical_variable"), quoted(c).cast("string").alias("category_level"))
        for c in categories
    ]
    rows = df.select(quoted(target).cast("double").alias("_t"), F.inline(F.array(*cells)))
    keys = ["categorical_variable", "category_level"]
    means = rows.groupBy(*keys).agg(
        F.count("_t").alias("observations"),
        F.avg("_t").alias("target_mean"),
        deviation(F.col("_t")).alias("target_standard_deviation"),
    )
    medians = grouped_quantiles(rows, keys, F.col("_t"), [0.5])
    same = [F.col(f"m.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys]
    return means.alias("m").join(medians.alias("q"), same, "left").select(
        *[F.col(f"m.{k}").alias(k) for k in keys],
        "observations",
        "target_mean",
        F.get("quantiles", F.lit(0)).alias("target_median"),
        "target_standard_deviation",
    )
