"""Validation of rows against a semantic schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.expressions import is_whole
from plumbline.operators.profile import duplicate_rows
from plumbline.schema import ColumnRule, SemanticSchema, numeric_columns, quoted
from plumbline.sources.tables import aligned

ISSUE_FIELDS = "severity string, rule string, column string, affected_count long, message string"


class ValidationFailed(RuntimeError):
    """The data break an ERROR rule of the schema."""


@dataclass(frozen=True)
class RowCheck:
    """A condition on single rows of one column."""

    rule: str
    column: str
    severity: str
    violated: Column
    message: str
    lists_values: bool = False


def row_checks(df: DataFrame, schema: SemanticSchema) -> list[RowCheck]:
    """The schema compiled to row conditions, in schema order."""
    numeric = set(numeric_columns(df))
    checks: list[RowCheck] = []
    for rule in schema.rules:
        if rule.name in df.columns:
            checks += _checks_of(rule, quoted(rule.name), rule.name in numeric)
    return checks


def _checks_of(rule: ColumnRule, c: Column, numeric: bool) -> list[RowCheck]:
    found = []
    if rule.nullable:
        found.append(RowCheck("missing_values", rule.name, "WARNING", c.isNull(),
                              "Missing values allowed with documented treatment."))
    else:
        found.append(RowCheck("missing_values", rule.name, "ERROR", c.isNull(),
                              "Missing values found in non-nullable column."))
    if numeric and rule.minimum is not None:
        found.append(RowCheck("minimum_bound", rule.name, "ERROR", c < F.lit(rule.minimum),
                              f"Values below minimum {rule.minimum}."))
    if numeric and rule.maximum is not None:
        found.append(RowCheck("maximum_bound", rule.name, "ERROR", c > F.lit(rule.maximum),
                              f"Values above maximum {rule.maximum}."))
    if numeric and rule.whole_number:
        found.append(RowCheck("whole_number_requirement", rule.name, "ERROR", ~is_whole(c),
                              "Non-whole-number values detected."))
    if rule.allowed_values:
        outside = ~c.cast("string").isin(list(rule.allowed_values))
        found.append(RowCheck("allowed_values", rule.name, "ERROR", outside, "Values outside the allowed list", True))
    return found


def _storage_matches(rule: ColumnRule, kind: T.DataType) -> bool:
    if rule.storage == "numeric":
        return isinstance(kind, T.NumericType)
    return isinstance(kind, T.StringType)


def validation_issues(df: DataFrame, schema: SemanticSchema) -> DataFrame:
    """One row per broken rule.

    Every row rule is one counter of a single aggregation over the table; only the
    one-row result reaches the driver, and duplicates are one further shuffle. Values
    outside an allow-list are counted separately, and only when there are any; the table
    `unexpected_values` holds them all.
    """
    return _issues(df, schema)[0]


def _issues(df: DataFrame, schema: SemanticSchema) -> tuple[DataFrame, int, int]:
    """The issues, and the numbers of rows and of missing values that the same pass has seen."""
    spark, issues = df.sparkSession, []
    absent = [n for n in schema.names if n not in df.columns]
    extra = [n for n in df.columns if n not in schema]
    if absent:
        issues.append(("ERROR", "required_columns", "", len(absent), "Missing columns: " + ", ".join(absent)))
    if extra:
        issues.append(
            ("WARNING", "unexpected_columns", "", len(extra), "Unexpected columns: " + ", ".join(extra))
        )
    checks = row_checks(df, schema)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(check.violated).alias(f"_c{i}") for i, check in enumerate(checks)],
        *[F.count_if(quoted(name).isNull()).alias(f"_n{i}") for i, name in enumerate(df.columns)],
    ).first()
    listed = [c for i, c in enumerate(checks) if c.lists_values and counted[f"_c{i}"]]
    distinct = _distinct_unexpected(df, listed)
    for rule in schema.rules:
        if rule.name not in df.columns:
            continue
        kind = df.schema[rule.name].dataType
        if not _storage_matches(rule, kind):
            message = f"Expected {rule.storage}; observed {kind.simpleString()}."
            issues.append(("ERROR", "storage_type", rule.name, counted["_rows"], message))
        for i, check in enumerate(checks):
            if check.column == rule.name and counted[f"_c{i}"]:
                message = check.message
                if check.lists_values:
                    message += f": {distinct[check.column]} distinct."
                issues.append((check.severity, check.rule, check.column, counted[f"_c{i}"], message))
    repeated = duplicate_rows(df).first()[0]
    if repeated:
        issues.append(("WARNING", "duplicate_rows", "", repeated, "Duplicate rows detected."))
    gaps = sum(counted[f"_n{i}"] for i in range(len(df.columns)))
    return spark.createDataFrame(issues, ISSUE_FIELDS), counted["_rows"], gaps


def _unexpected(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    cells = [
        F.when(c.violated, F.struct(F.lit(c.column).alias("column"), quoted(c.column).cast("string").alias("value")))
        for c in checks
    ]
    return df.select(F.inline(F.array_compact(F.array(*cells)))).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("affected_count")
    )


def unexpected_values(df: DataFrame, schema: SemanticSchema) -> DataFrame:
    """``column, value, affected_count`` of every value outside its allow-list, in one pass."""
    checks = [c for c in row_checks(df, schema) if c.lists_values]
    if not checks:
        return df.sparkSession.createDataFrame([], "column string, value string, affected_count long")
    return _unexpected(df, checks)


def _distinct_unexpected(df: DataFrame, checks: Sequence[RowCheck]) -> dict[str, int]:
    if not checks:
        return {}
    return {r["column"]: r["count"] for r in _unexpected(df, checks).groupBy("column").count().collect()}


def validation_observations(
    df: DataFrame, schema: SemanticSchema, rules: Sequence[str] | None = ("minimum_bound",)
) -> DataFrame:
    """The rows that break a rule, once per broken rule, with all their columns.

    One scan: each row carries the list of what it breaks and is repeated by it, so
    there is no shuffle and no second pass. ``rules=None`` captures every row rule.
    """
    chosen = [c for c in row_checks(df, schema) if rules is None or c.rule in rules]
    if not chosen:
        raise ValueError("No rule to capture.")
    broken = F.array_compact(
        F.array(
            *[
                F.when(c.violated, F.struct(F.lit(c.rule).alias("validation_rule"),
                                            F.lit(c.column).alias("validation_column")))
                for c in chosen
            ]
        )
    )
    flagged = df.select(broken.alias("_broken"), *[quoted(c) for c in df.columns])
    return flagged.where(F.size("_broken") > 0).select(
        F.inline("_broken"), *[quoted(c) for c in df.columns]
    )


def validation_summary(df: DataFrame, schema: SemanticSchema) -> DataFrame:
    """Counts and overall status in one row, from one pass over the rows and the search for duplicates."""
    issues, rows, gaps = _issues(df, schema)
    return summary_of(issues, rows, gaps, len(df.columns))


def summary_of(issues: DataFrame, rows: int, gaps: int, columns: int) -> DataFrame:
    counts = issues.agg(
        F.count_if(F.col("severity") == "ERROR").alias("validation_errors"),
        F.count_if(F.col("severity") == "WARNING").alias("validation_warnings"),
        F.coalesce(F.max(F.when(F.col("rule") == "duplicate_rows", F.col("affected_count"))), F.lit(0)).alias(
            "duplicate_rows"
        ),
    )
    return counts.select(
        F.lit(rows).cast("long").alias("observations"),
        F.lit(columns).alias("columns"),
        "validation_errors",
        "validation_warnings",
        "duplicate_rows",
        F.lit(gaps).cast("long").alias("total_missing_values"),
        F.when(F.col("validation_errors") > 0, "FAILED")
        .when(F.col("validation_warnings") > 0, "PASSED WITH WARNINGS")
        .otherwise("PASSED")
        .alias("status"),
    )


def validated(df: DataFrame, schema: SemanticSchema) -> tuple[DataFrame, DataFrame]:
    """Issues and summary together."""
    issues, rows, gaps = _issues(df, schema)
    return issues, summary_of(issues, rows, gaps, len(df.columns))


def require_valid(summary: DataFrame) -> str:
    """The gate: raises when the status is FAILED, returns it otherwise."""
    status = summary.first()["status"]
    if status == "FAILED":
        raise ValidationFailed("Validation failed. Review the validation issues.")
    return status


def logical_checks(df: DataFrame, schema: SemanticSchema) -> DataFrame:
    """Cross-column and single-column checks, one row per check even when nothing breaks it."""
    named: list[tuple[str, Column, str]] = [
        (r.name, F.expr(r.violated), r.description)
        for r in schema.cross_rules
        if all(c in df.columns for c in r.columns)
    ]
    wording = {
        "minimum_bound": ("below_minimum", lambda r: f"Values below schema minimum {r.minimum}."),
        "maximum_bound": ("above_maximum", lambda r: f"Values above schema maximum {r.maximum}."),
        "whole_number_requirement": ("non_whole_values", lambda r: "Checks the whole-number requirement."),
    }
    for check in row_checks(df, schema):
        if check.rule in wording:
            suffix, describe = wording[check.rule]
            named.append((f"{check.column}_{suffix}", check.violated, describe(schema.rule(check.column))))
    if not named:
        raise ValueError("The schema holds no checks for this table.")
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.count_if(violated).alias("affected_observations"),
            F.lit(description).alias("description"),
        )
        for name, violated, description in named
    ]
    return df.agg(F.array(*rows).alias("all")).select(F.inline("all")).select(
        "check_name",
        "affected_observations",
        F.when(F.col("affected_observations") == 0, "PASS").otherwise("REVIEW").alias("status"),
        "description",
    )


def preprocessing_audit(df: DataFrame, schema: SemanticSchema, cleaned: DataFrame, status: str) -> DataFrame:
    """What schema cleaning did, one row per step."""
    extra = [n for n in df.columns if n not in schema]
    changed = []
    for rule in schema.rules:
        before = quoted(rule.name)
        if rule.storage == "string":
            changed.append((F.count_if(F.trim(before.cast("string")) != before.cast("string"))))
        else:
            changed.append(F.count_if(before.isNotNull() & aligned(rule, before).isNull()))
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[c.alias(f"_c{i}") for i, c in enumerate(changed)]
    ).first()
    after = cleaned.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(quoted(n).isNull()).alias(f"_m{i}") for i, n in enumerate(schema.names)],
    ).first()
    audit = [
        ("semantic_validation_gate", "", 0, status,
         "Preprocessing proceeded only after semantic-schema validation."),
        ("schema_column_selection", "", len(extra), "SCHEMA COLUMNS RETAINED",
         "Unexpected columns excluded: " + (", ".join(extra) if extra else "none")),
    ]
    kinds = dict(cleaned.dtypes)
    for i, rule in enumerate(schema.rules):
        affected = 0 if rule.storage == "string" else counted[f"_c{i}"]
        audit.append(("dtype_alignment", rule.name, affected, kinds[rule.name],
                      "Storage type aligned with the semantic schema."))
    for i, rule in enumerate(schema.rules):
        if rule.storage == "string":
            audit.append(("categorical_text_standardisation", rule.name, counted[f"_c{i}"], "WHITESPACE TRIMMED",
                          "Leading and trailing whitespace removed from non-missing category values."))
    gaps = sum(after[f"_m{i}"] for i in range(len(schema.names)))
    audit.append(("missing_value_treatment", "", gaps, "PRESERVED",
                  "Allowed missing values were retained. Model-specific imputation must be "
                  "fitted using training data only."))
    lost = counted["rows"] - after["rows"]
    audit.append(("row_count_check", "", lost, "NO ROWS REMOVED" if lost == 0 else "ROWS REMOVED",
                  f"Raw rows={counted['rows']}; processed rows={after['rows']}."))
    return df.sparkSession.createDataFrame(
        audit, "operation string, column string, affected_observations long, decision string, description string"
    )
