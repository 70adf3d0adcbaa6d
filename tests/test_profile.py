import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.operators import profile
from plumbline.schema import ColumnRule, SemanticSchema, numeric_columns, require_columns, require_rows, string_columns


@pytest.fixture(scope="module")
def small(spark):
    rows = [
        (1, "b", 2.0, True, dt.date(2024, 1, 1), "2024-01-05"),
        (2, "a", 4.0, False, dt.date(2024, 1, 2), "2024-02-05"),
        (3, None, 4.0, True, dt.date(2024, 1, 2), "2024-03-05"),
        (4, "a", None, True, dt.date(2024, 1, 3), None),
    ]
    return spark.createDataFrame(rows, "k long, g string, x double, f boolean, d date, t string").repartition(3)


def by_name(df):
    return {r["column_name"]: r for r in df.collect()}


def test_column_profile(small):
    rows = by_name(profile.column_profile(small, "k"))
    assert len(rows["x"].asDict()) == 22
    assert rows["x"]["inferred_structural_type"] == "Integer-valued numeric"
    assert rows["k"]["inferred_structural_type"] == "Integer numeric"
    assert rows["f"]["inferred_structural_type"] == "Boolean"
    assert rows["d"]["inferred_structural_type"] == "Datetime"
    assert rows["t"]["inferred_structural_type"] == "Datetime candidate"
    assert rows["g"]["inferred_structural_type"] == "String / categorical candidate"
    assert rows["g"]["missing_count"] == 1 and rows["g"]["missing_percentage"] == 25.0
    assert rows["g"]["binary_candidate"] and not rows["g"]["identifier_candidate"]
    assert rows["k"]["identifier_candidate"]
    assert rows["x"]["median"] == 4.0 and rows["x"]["zero_count"] == 0.0
    assert rows["g"]["mean"] is None and rows["g"]["zero_count"] is None


def test_examples_follow_row_order(small):
    rows = by_name(profile.column_profile(small, "k"))
    assert rows["g"]["example_values"] == "b | a"
    assert rows["x"]["example_values"] == "2.0 | 4.0"
    assert rows["k"]["example_values"] == "1 | 2 | 3 | 4"


def test_empty_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k long, x double")
    row = by_name(profile.column_profile(df, "k"))["x"]
    assert row["unique_count"] == 0 and row["median"] is None and row["example_values"] == ""
    assert not row["low_cardinality_candidate"] and not row["integer_valued_candidate"]


def test_datetime_candidate_looks_at_all_values(spark):
    df = spark.range(300).select(
        F.col("id").alias("k"),
        F.when(F.col("id") < 95, "2024-01-01").otherwise("none").alias("t"),
    )
    assert not by_name(profile.datetime_candidates(df))["t"]["datetime_candidate"]
    assert by_name(profile.column_profile(df, "k"))["t"]["inferred_structural_type"].startswith("String")
    dated = df.where("k < 95")
    assert by_name(profile.column_profile(dated, "k"))["t"]["inferred_structural_type"] == "Datetime candidate"


def test_doubles_are_counted_by_value(spark):
    values = [0.1 + 0.2, 0.3, 0.1234567890123456, 0.1234567890123457, 0.0, -0.0, 1e-20, 2e-20, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "k int, x double")
    row = by_name(profile.column_profile(df, "k"))["x"]
    assert row["unique_count"] == 7
    assert row["example_values"].startswith("0.30000000000000004 | 0.3 | 0.1234567890123456 | 0.1234567890123457 | 0.0")
    counted = profile.value_frequencies(df.select("x")).collect()
    assert {r["observed_value"]: r["frequency"] for r in counted}["0.0"] == 2
    flags = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert {r["observed_value"] for r in profile.value_frequencies(flags).collect()} == {"true", "false", None}


@pytest.mark.parametrize("by_hash", [True, False, None])
def test_duplicates_treat_null_as_equal(spark, by_hash):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (None, "y"), (None, "y")], "a int, b string")
    assert profile.duplicate_rows(df, by_hash).first()[0] == 2


def test_duplicates_of_a_hot_row(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"))
    wide = hot.withColumn("b", F.repeat(F.lit("z"), 50))
    assert profile.duplicate_rows(wide, True).first()[0] == 9_999
    assert profile.duplicate_rows(wide, False).first()[0] == 9_999


def test_duplicates_of_empty_table(spark):
    assert profile.duplicate_rows(spark.createDataFrame([], "a int")).first()[0] == 0


def test_categorical_candidates_name_the_gap(small):
    rows = profile.categorical_candidates(small).where("column_name = 'g'").collect()
    assert {(r["observed_value"], r["frequency"], r["percentage"]) for r in rows} == {
        ("a", 2, 50.0), ("b", 1, 25.0), ("<MISSING>", 1, 25.0),
    }


def test_value_counts_and_structure(small):
    counts = profile.value_counts(small, "g").collect()
    assert [(r["value"], r["value_count"], r["percentage"]) for r in counts] == [
        ("a", 2, 50.0), (None, 1, 25.0), ("b", 1, 25.0),
    ]
    structure = by_name(profile.structure_table(small))
    assert structure["g"]["unique_values"] == 2 and structure["g"]["data_type"] == "string"


def test_missing_tables_and_dataset_summary(small):
    schema = SemanticSchema(
        (
            ColumnRule("g", "nominal_categorical", storage="string", group="categorical"),
            ColumnRule("x", "continuous_numeric", role="target", group="target", nullable=True,
                       missing_treatment="median"),
        )
    )
    gaps = by_name(profile.missing_summary(small, schema))
    assert gaps["x"]["documented_treatment"] == "median" and gaps["x"]["nullable_in_schema"]
    assert gaps["t"]["documented_treatment"] == "" and set(gaps) == {"g", "x", "t"}
    first = profile.missing_table(small).first()
    assert first["missing_count"] == 1 and first["feature"] == "g"
    summary = profile.dataset_summary(small, schema).first()
    assert summary["observations"] == 4 and summary["total_missing_values"] == 3
    assert summary["variables_with_missing_values"] == 3 and summary["duplicate_percentage"] == 0.0


def test_guards(small, spark):
    with pytest.raises(KeyError, match="nope"):
        require_columns(small, ["nope"])
    with pytest.raises(ValueError):
        require_rows(spark.createDataFrame([], "a int"))
    assert numeric_columns(small) == ["k", "x"] and string_columns(small) == ["g", "t"]


def test_preview(small):
    assert [r["k"] for r in profile.preview(small, ["k"], 2).collect()] == [1, 2]


@pytest.mark.parametrize("broadcast", [500_000, 3, 0])
def test_unique_counts_of_texts_that_repeat_in_part(spark, monkeypatch, broadcast):
    monkeypatch.setattr(profile, "BROADCAST_ROWS", broadcast)
    n = 3000
    k = F.col("id")
    df = spark.range(n).repartition(5).select(
        k.alias("k"), F.concat(F.lit("text "), k.cast("string")).alias("own"), F.concat(F.lit("x"), (k % 7).cast("string")).alias("few"),
        F.when(k % 2 == 0, F.concat(F.lit("y"), (k % 1000).cast("string"))).otherwise(k.cast("string")).alias("some"),
        F.when(k > 5, F.lit(None)).otherwise(k.cast("string")).alias("gaps"), F.lit(None).cast("string").alias("none"),
        F.when(k % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("zero"), (k % 2 == 0).alias("flag"),
        F.date_add(F.lit("2020-01-01").cast("date"), (k % 11).cast("int")).alias("day"), (k / 7).alias("number"),
    )
    found = {r["column_name"]: r["unique_count"] for r in profile.unique_counts(df).collect()}
    assert found == {
        "k": n, "own": n, "few": 7, "some": 500 + n // 2, "gaps": 6, "none": 0, "zero": 1, "flag": 2, "day": 11, "number": n,
    }
    assert {r["column_name"]: r["unique_count"] for r in profile.unique_counts(df, ["few"]).collect()} == {"few": 7}


def test_first_examples_equal_those_of_whole_columns(spark, monkeypatch):
    monkeypatch.setattr(profile, "EXAMPLE_ROWS", 20)
    k = F.col("id")
    df = spark.range(400).repartition(7).select(
        k.alias("k"), k.cast("string").alias("own"), (k % 3).alias("few"), F.floor(k / 30).alias("slow"),
        F.when(k > 350, k * 0.5).alias("late"), F.lit(None).cast("string").alias("none"),
    )
    whole = {r["column_name"]: r["example_values"] for r in profile.example_values(profile.value_frequencies(df, row_key="k")).collect()}
    found = {r["column_name"]: r["example_values"] for r in profile.first_examples(df, "k").collect()}
    assert found == whole and found["slow"] == "0 | 1 | 2 | 3 | 4" and found["late"].startswith("175.5 | 176.0")


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_duplicates_by_digest(spark, limit):
    rows = [("a", "b", 1.5, None)] * 3 + [("ab", "", 1.5, None), ("a", "b", 1.5, 0), ("a", "b", 0.0, None), ("a", "b", -0.0, None)]
    rows += [("1:a", "~", None, 2), ("1:a", None, None, 2)] * 2
    df = spark.createDataFrame(rows, "p string, q string, x double, n long")
    assert profile.duplicate_rows(df, True, limit).first()[0] == 5
    plan = profile.duplicate_rows(df, True, limit)._jdf.queryExecution().toString()
    assert "hashpartitioning(p" not in plan
