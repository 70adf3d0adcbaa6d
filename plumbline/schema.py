"""Semantic schema: what each column of a table means and which values it may hold.

A schema is always a parameter of the operators, never a module constant, so the
same code serves any table. It describes columns only; its size does not depend
on the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnRule:
    """Declared meaning and limits of one column."""

    name: str
    semantic_type: str
    role: str = "predictor"
    storage: str = "numeric"
    nullable: bool = False
    minimum: float | None = None
    maximum: float | None = None
    whole_number: bool = False
    allowed_values: tuple[str, ...] | None = None
    group: str = "numerical"
    missing_treatment: str = ""


@dataclass(frozen=True)
class CrossRule:
    """A row-level SQL condition over several columns that should not hold."""

    name: str
    violated: str
    description: str
    columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Ratio:
    """A derived column ``numerator / denominator``; NULL where the denominator is 0."""

    name: str
    numerator: str
    denominator: str
    meaning: str = ""


@dataclass(frozen=True)
class SemanticSchema:
    """Ordered column rules of one table."""

    rules: tuple[ColumnRule, ...]
    cross_rules: tuple[CrossRule, ...] = ()

    def __post_init__(self) -> None:
        names = [rule.name for rule in self.rules]
        repeated = sorted({name for name in names if names.count(name) > 1})
        if repeated:
            raise ValueError(f"Columns declared more than once: {', '.join(repeated)}")

    @property
    def names(self) -> list[str]:
        return [rule.name for rule in self.rules]

    def __contains__(self, name: str) -> bool:
        return any(rule.name == name for rule in self.rules)

    def rule(self, name: str) -> ColumnRule | None:
        return next((rule for rule in self.rules if rule.name == name), None)

    def in_group(self, group: str) -> list[str]:
        return [rule.name for rule in self.rules if rule.group == group]

    @property
    def target(self) -> str:
        for rule in self.rules:
            if rule.role == "target":
                return rule.name
        raise ValueError("The schema declares no target column.")

    @property
    def numerical(self) -> list[str]:
        return self.in_group("numerical")

    @property
    def categorical(self) -> list[str]:
        return self.in_group("categorical")

    @property
    def non_negative(self) -> list[str]:
        return [rule.name for rule in self.rules if rule.minimum == 0.0]

    @property
    def whole_number(self) -> list[str]:
        return [rule.name for rule in self.rules if rule.whole_number]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The schema as a table of one row per column, for joins with results."""
        fields = "position int, column_name string, role string, semantic_type string, " \
                 "nullable_in_schema boolean, documented_treatment string"
        return spark.createDataFrame(
            [
                (i, r.name, r.role, r.semantic_type, r.nullable, r.missing_treatment)
                for i, r in enumerate(self.rules, start=1)
            ],
            fields,
        )


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    """Names of the text columns, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def require_columns(df: DataFrame, names: list[str], purpose: str = "this step") -> None:
    """Fail before any job starts when a needed column is absent."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise KeyError(f"Columns missing for {purpose}: {', '.join(absent)}")


def require_rows(df: DataFrame, purpose: str = "this step") -> None:
    """Fail when the table is empty; reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"No rows available for {purpose}.")


def quoted(name: str) -> Column:
    """A column by its exact name, also when it holds spaces, dots or signs."""
    return F.col("`" + name.replace("`", "``") + "`")
