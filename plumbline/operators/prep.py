"""Leakage-free model inputs: selection, alignment, encoding, imputation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.durable import durable, forget
from plumbline.functions.expressions import to_number
from plumbline.functions.quantiles import BOUNDED_GROUP, fit_quantiles
from plumbline.schema import Ratio, quoted, require_columns, string_columns
from plumbline.operators.features import ratio_features
from plumbline.operators.split import TRAIN

MAX_LEVELS = 1000


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Make the columns numbers; text that is no number, NaN and infinities become NULL."""
    return df.withColumns({n: to_number(quoted(n)) for n in columns})


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """Keep rows whose target is present; a filter the scan can apply."""
    return df.where(quoted(target).isNotNull())


def separate_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features, and the numeric target, of the same rows."""
    return df.drop(target), df.select(to_number(quoted(target)).alias(target))


def selected_features(
    df: DataFrame, selected: Sequence[str], target: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Exactly the selected columns, in that order, then the target."""
    names = [n for n in selected if n != target]
    if not names:
        raise ValueError("Select at least one feature.")
    require_columns(df, [*keep, *names, target], "feature selection")
    return df.select(*[quoted(n) for n in [*keep, *names, target]])


def align_columns(df: DataFrame, layout: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The training layout: absent columns become 0, extra ones are dropped."""
    return df.select(
        *[quoted(n) for n in keep],
        *[quoted(n) if n in df.columns else F.lit(0.0).alias(n) for n in layout],
    )


def align_strict(df: DataFrame, layout: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The training layout for scoring: an absent column is an error."""
    require_columns(df, [*keep, *layout], "scoring")
    return df.select(*[quoted(n) for n in [*keep, *layout]])


def fit_levels(train: DataFrame, columns: Sequence[str], cap: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted training levels of each categorical column.

    Levels become dense columns, so more than ``cap`` of them is an error that names the
    columns; the layout of `operators.sparse` takes any number.
    """
    if not columns:
        return {}
    cells = [F.struct(F.lit(n).alias("c"), quoted(n).cast("string").alias("l")) for n in columns]
    pairs = durable(train.select(F.inline(F.array(*cells))).where(F.col("l").isNotNull()).distinct())
    wide = [r["c"] for r in pairs.groupBy("c").count().where(F.col("count") > cap).orderBy("c").collect()]
    if wide:
        raise ValueError(f"More than {cap} levels in: {', '.join(wide)}. Group them or use the sparse layout (operators.sparse).")
    levels: dict[str, list[str]] = {n: [] for n in columns}
    for row in pairs.orderBy("c", "l").collect():
        levels[row["c"]].append(row["l"])
    forget(pairs)
    return levels


def sparse_encoder(train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Encoder of any number of levels: a sparse vector ``<column>_levels`` per column.

    Levels are those of the training rows; an unseen level and NULL share the last place.
    """
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_index" for c in columns], handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_levels" for c in columns], dropLast=False
    )
    return Pipeline(stages=[indexer, encoder]).fit(train)


def encoded_names(columns: Sequence[str], levels: dict[str, list[str]]) -> list[str]:
    """Model columns: untouched ones first, then one per level beyond the first.

    Two levels of different columns that would make the same name are an error.
    """
    plain = [n for n in columns if n not in levels]
    names = plain + [f"{n}_{level}" for n in columns if n in levels for level in levels[n][1:]]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"Encoding makes these column names twice: {', '.join(twice)}. Rename a column.")
    return names


def one_hot(df: DataFrame, levels: dict[str, list[str]], keep: Sequence[str] = ()) -> DataFrame:
    """0/1 columns for every training level but the first.

    The first training level, unseen levels and NULL are all 0 in every split.
    """
    plain = [n for n in df.columns if n not in levels and n not in keep]
    encoded_names(df.columns, levels)
    made = []
    for name in df.columns:
        for level in levels.get(name, [])[1:]:
            hit = F.when(quoted(name) == F.lit(level), F.lit(1.0)).otherwise(F.lit(0.0))
            made.append(hit.alias(f"{name}_{level}"))
    return df.select(*[quoted(n) for n in [*keep, *plain]], *made)


def fit_medians(
    train: DataFrame, columns: Sequence[str], bounded: int = BOUNDED_GROUP
) -> dict[str, float | None]:
    """Exact training medians."""
    return {n: q[0] for n, q in fit_quantiles(train, list(columns), [0.5], bounded=bounded).items()}


def median_impute(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Fill gaps with the training median, or 0 where the training column was empty."""
    filled: dict[str, Column] = {
        n: F.coalesce(quoted(n).cast("double"), F.lit(0.0 if m is None else float(m)))
        for n, m in medians.items()
    }
    return df.withColumns(filled)


@dataclass(frozen=True)
class Preparation:
    """Everything learned on the training rows, applied to any rows as projections."""

    selected: tuple[str, ...]
    target: str
    ratios: tuple[Ratio, ...]
    levels: dict[str, list[str]]
    medians: dict[str, float | None]

    @property
    def layout(self) -> list[str]:
        return encoded_names(self.selected, self.levels)

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Ratios, selection, target filter, encoding and imputation in one projection."""
        shaped = selected_features(ratio_features(df, self.ratios), self.selected, self.target, keep)
        shaped = drop_null_target(coerce_numeric(shaped, [self.target]), self.target)
        numbers = [n for n in self.selected if n not in self.levels]
        shaped = coerce_numeric(shaped, numbers)
        encoded = one_hot(shaped, self.levels, [*keep, self.target])
        return median_impute(encoded, self.medians).select(
            *[quoted(n) for n in keep], *[quoted(n) for n in self.layout], quoted(self.target)
        )


def fit_preparation(
    train: DataFrame,
    selected: Sequence[str],
    target: str,
    ratios: Sequence[Ratio] = (),
    bounded: int = BOUNDED_GROUP,
) -> Preparation:
    """Learn levels and medians from the training rows that have a target."""
    chosen = selected_features(ratio_features(train, ratios), selected, target)
    chosen = drop_null_target(coerce_numeric(chosen, [target]), target)
    categories = [n for n in string_columns(chosen) if n != target]
    levels = fit_levels(chosen, categories)
    numbers = [n for n in selected if n not in categories and n != target]
    medians = fit_medians(coerce_numeric(chosen, numbers), numbers, bounded)
    return Preparation(tuple(n for n in selected if n != target), target, tuple(ratios), levels, medians)


def prepared_splits(split: DataFrame, preparation: Preparation, keep: Sequence[str] = ()) -> DataFrame:
    """Model-ready rows of all splits in one table, with their ``split`` column."""
    return preparation.apply(split, [*keep, "split"])


def training_rows(split: DataFrame) -> DataFrame:
    return split.where(F.col("split") == TRAIN)
