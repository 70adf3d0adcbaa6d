import pytest
from pyspark.sql import functions as F

from plumbline.operators import validate
from plumbline.schema import ColumnRule, CrossRule, SemanticSchema
from plumbline.sources.tables import schema_clean


def schema():
    return SemanticSchema(
        (
            ColumnRule("n", "count", minimum=0.0, maximum=10.0, whole_number=True),
            ColumnRule("m", "continuous_numeric", nullable=True, role="target", group="target"),
            ColumnRule("c", "nominal_categorical", storage="string", allowed_values=("A", "B"), group="categorical"),
        ),
        (CrossRule("n_above_m", "n > m", "n should not exceed m.", ("n", "m")),),
    )


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1.0, 5.0, "A"), (-1.0, None, "Z"), (2.5, 1.0, "Y"), (11.0, 3.0, None), (1.0, 5.0, "A")]
    return spark.createDataFrame(data, "n double, m double, c string")


def issues(df, s):
    return {(r["rule"], r["column"]): r for r in validate.validation_issues(df, s).collect()}


def test_issues(rows):
    found = issues(rows, schema())
    assert found["minimum_bound", "n"]["affected_count"] == 1
    assert found["maximum_bound", "n"]["message"] == "Values above maximum 10.0."
    assert found["whole_number_requirement", "n"]["affected_count"] == 1
    assert found["missing_values", "m"]["severity"] == "WARNING"
    assert found["missing_values", "c"]["severity"] == "ERROR"
    assert found["allowed_values", "c"]["message"] == "Values outside the allowed list: 2 distinct."
    assert found["duplicate_rows", ""]["affected_count"] == 1
    assert len(found) == 7


def test_column_set_and_storage_issues(rows):
    changed = rows.drop("m").withColumn("n", F.lit("text")).withColumn("extra", F.lit(1))
    found = issues(changed, schema())
    assert found["required_columns", ""]["message"] == "Missing columns: m"
    assert found["unexpected_columns", ""]["severity"] == "WARNING"
    assert found["storage_type", "n"]["affected_count"] == 5
    assert ("minimum_bound", "n") not in found


def test_all_bad_values_are_listed(spark):
    df = spark.range(200).select(F.lit(1.0).alias("n"), F.lit(1.0).alias("m"), F.col("id").cast("string").alias("c"))
    issue = issues(df, schema())["allowed_values", "c"]
    assert issue["affected_count"] == 200 and issue["message"].endswith(": 200 distinct.")
    listed = validate.unexpected_values(df, schema()).collect()
    assert {r["value"] for r in listed} == {str(i) for i in range(200)}


def test_observations_repeat_a_row_per_rule(rows):
    captured = validate.validation_observations(rows, schema(), rules=None).collect()
    assert sorted((r["validation_rule"], r["validation_column"]) for r in captured) == [
        ("allowed_values", "c"), ("allowed_values", "c"), ("maximum_bound", "n"), ("minimum_bound", "n"),
        ("missing_values", "c"), ("missing_values", "m"), ("whole_number_requirement", "n"),
    ]
    only = validate.validation_observations(rows, schema()).collect()
    assert [(r["validation_rule"], r["n"]) for r in only] == [("minimum_bound", -1.0)]


def test_status_and_gate(rows):
    summary = validate.validation_summary(rows, schema())
    assert summary.first()["status"] == "FAILED"
    with pytest.raises(validate.ValidationFailed):
        validate.require_valid(summary)
    fine = rows.where("c = 'A'")
    assert validate.validation_summary(fine, schema()).first()["status"] == "PASSED WITH WARNINGS"
    assert validate.require_valid(validate.validation_summary(fine.distinct(), schema())) == "PASSED"


def test_logical_checks_list_every_rule(rows):
    checks = {r["check_name"]: r for r in validate.logical_checks(rows, schema()).collect()}
    assert checks["n_above_m"]["affected_observations"] == 2
    assert checks["n_below_minimum"]["status"] == "REVIEW"
    assert list(checks) == ["n_above_m", "n_below_minimum", "n_above_maximum", "n_non_whole_values"]


def test_clean_and_audit(spark):
    raw = spark.createDataFrame([("7", "1.5", " A "), ("x", None, "B")], "n string, m string, c string")
    raw = raw.withColumn("extra", F.lit(0))
    cleaned = schema_clean(raw, schema())
    assert dict(cleaned.dtypes) == {"n": "bigint", "m": "double", "c": "string"}
    assert [tuple(r) for r in cleaned.collect()] == [(7, 1.5, "A"), (None, None, "B")]
    audit = {(r["operation"], r["column"]): r for r in
             validate.preprocessing_audit(raw, schema(), cleaned, "PASSED").collect()}
    assert audit["dtype_alignment", "n"]["affected_observations"] == 1
    assert audit["schema_column_selection", ""]["description"] == "Unexpected columns excluded: extra"
    assert audit["categorical_text_standardisation", "c"]["affected_observations"] == 1
    assert audit["row_count_check", ""]["decision"] == "NO ROWS REMOVED"


def test_schema_rejects_repeated_columns():
    with pytest.raises(ValueError):
        SemanticSchema((ColumnRule("a", "count"), ColumnRule("a", "count")))
