import pytest
from pyspark.sql import functions as F

from plumbline.operators import findings, governance
from plumbline.operators.curvature import classify
from plumbline.plans import housing, rules

# Published curvature scores and statistics of the housing table.
SCORES = {
    "longitude": 0.3952588987313943, "latitude": 0.35990416222598387, "total_rooms": 0.2165723720008527,
    "total_bedrooms": 0.19647279058409411, "households": 0.19526747197093852,
    "housing_median_age": 0.19454667978537768, "population": 0.1817760820234434,
    "median_income": 0.1645517505298754,
}
CORRELATIONS = {
    "median_income": 0.6878734499291473, "latitude": -0.1378638409631153, "total_rooms": 0.13680098461820744,
    "housing_median_age": 0.11630529814765289, "households": 0.0667880667173049, "longitude": -0.05234541619657408,
    "total_bedrooms": 0.04952335376176252, "population": -0.024592325530259442,
}
OUTLIERS = {
    "total_rooms": 6.2984496124031, "total_bedrooms": 6.2638427464008855, "households": 6.049280177187153,
    "population": 5.966223698781838, "median_house_value": 5.3156146179401995, "median_income": 3.3776301218161686,
    "latitude": 0.9897563676633444, "longitude": 0.0, "housing_median_age": 0.0,
}


@pytest.fixture(scope="module")
def schema(spark):
    return housing.housing_schema()


@pytest.fixture(scope="module")
def blocks(spark):
    """Two rows of the housing table."""
    data = [
        (-122.23, 37.88, 41.0, 880.0, 129.0, 322.0, 126.0, 8.3252, 452600.0, "NEAR BAY"),
        (-122.22, 37.86, 21.0, 7099.0, None, 2401.0, 1138.0, 8.3014, 358500.0, "NEAR BAY"),
    ]
    fields = ", ".join(f"{n} {'string' if n == 'ocean_proximity' else 'double'}"
                       for n in housing.housing_schema().names)
    return spark.createDataFrame(data, fields)


@pytest.fixture(scope="module")
def screen(spark):
    scores = spark.createDataFrame(list(SCORES.items()), "feature string, deviation_score double")
    label = classify(F.col("deviation_score"))
    return scores.withColumn("automated_screen", label).withColumn("exploratory_pattern", label).orderBy(
        F.desc("deviation_score"))


@pytest.fixture(scope="module")
def plan(blocks, schema, screen):
    return governance.feature_plan(
        blocks, schema, housing.RATIOS, housing.INTERACTIONS, housing.DOMAIN_ASSETS, screen, housing.SPLINE_COLUMNS
    )


def test_schema_views(schema):
    assert schema.target == "median_house_value" and len(schema.numerical) == 8
    assert schema.categorical == ["ocean_proximity"]
    assert schema.whole_number == ["housing_median_age", "total_rooms", "total_bedrooms", "population", "households"]
    assert len(schema.non_negative) == 7


def test_repository_order_and_ids(plan):
    rows = governance.feature_repository(plan).orderBy("feature_id").collect()
    assert [r["feature_id"] for r in rows][:2] == ["FEAT-001", "FEAT-002"] and len(rows) == 27
    assert [r["feature_name"] for r in rows] == [
        "bedrooms_per_household", "bedrooms_per_person", "bedrooms_per_room", "population_per_household",
        "rooms_per_household", "rooms_per_person", "coastal_access_group", "distance_to_business_centre",
        "local_amenity_index", "latitude_squared", "longitude_squared", "households_squared",
        "housing_median_age_squared", "income_age_interaction", "income_ocean_proximity_interaction",
        "longitude_latitude_interaction", "median_income_squared", "population_squared", "total_bedrooms_squared",
        "total_rooms_squared", "one_hot_categorical_predictors", "standardized_numeric_predictors",
        "polynomial_feature_expansion", "spline_basis_for_prediction", "orthogonal_polynomial_terms",
        "centered_numeric_predictors", "interpretable_spline_basis",
    ]
    assert len(rows[0].asDict()) == 16 and len(plan.columns) == 19


def test_dependencies(plan, blocks):
    rows = governance.feature_dependencies(plan, blocks).collect()
    assert len(rows) == 75
    assert {r["source_variable"] for r in rows if not r["source_available_in_training_data"]} == {
        "external_cbd_coordinates", "external_amenity_data"}


def test_summary_counts_by_decision(plan):
    rows = {r["feature_group"]: r for r in governance.feature_plan_summary(plan).collect()}
    assert {g: r["features"] for g, r in rows.items()} == {
        "Deterministic": 6, "Domain": 3, "Statistical": 11, "Machine Learning": 4, "Inferential": 3}
    assert sum(r["ready"] for r in rows.values()) == 8
    assert sum(r["needing_decision"] for r in rows.values()) == 19


def test_recommendations_need_their_columns(blocks):
    rows = governance.feature_recommendations(blocks, housing.RATIOS, housing.INTERACTIONS).collect()
    assert len(rows) == 8 and rows[0]["recommended_feature"] == "rooms_per_household"
    assert {r["recommended_feature"]: r["usable_rows"] for r in rows}["bedrooms_per_room"] == 1
    fewer = governance.feature_recommendations(
        blocks.drop("households", "longitude"), housing.RATIOS, housing.INTERACTIONS).collect()
    assert [r["recommended_feature"] for r in fewer] == [
        "bedrooms_per_room", "rooms_per_person", "bedrooms_per_person", "income_ocean_proximity_interaction"]


@pytest.fixture(scope="module")
def tables(spark, blocks):
    correlations = spark.createDataFrame(
        [(f, r, abs(r)) for f, r in CORRELATIONS.items()],
        "feature string, correlation_with_target double, absolute_correlation double")
    outliers = spark.createDataFrame(list(OUTLIERS.items()), "variable string, combined_flag_percentage double")
    distributions = spark.createDataFrame(
        [("median_house_value", 14448, 207143.47888981173, 0.9857121708200037)],
        "variable string, observations long, mean double, skewness double")
    gaps = spark.createDataFrame([(5, "total_bedrooms", 140)],
                                 "position int, column_name string, missing_count long")
    return correlations, outliers, distributions, gaps


def test_candidates(blocks, schema, tables, screen):
    correlations, outliers, _, _ = tables
    rows = {r["feature"]: r for r in findings.candidate_variables(
        blocks, schema, correlations, screen, outliers, housing.WORDING).collect()}
    assert list(rows) == [n for n in schema.names if n != schema.target]
    assert rows["median_income"]["observed_linear_association"].startswith("Strong")
    assert rows["longitude"]["exploratory_nonlinearity"] == "Strong nonlinear pattern"
    assert rows["ocean_proximity"]["observed_linear_association"] == "Categorical predictor"
    assert rows["ocean_proximity"]["exploratory_nonlinearity"] == "Not applicable"
    assert rows["ocean_proximity"]["potential_outlier_percentage"] == 0.0


@pytest.fixture(scope="module")
def known(spark, blocks, tables, screen):
    correlations, outliers, shape, gaps = tables
    checks = spark.createDataFrame([("a", "REVIEW"), ("b", "PASS")], "check_name string, status string")
    counts = spark.createDataFrame([("INLAND", 5), ("<1H OCEAN", 7), (None, 1)], "value string, value_count long")
    return findings.facts(
        blocks, "median_house_value", shape, gaps, correlations, spark.range(7), screen, outliers, checks, counts,
        "median_income", "ocean_proximity")


def test_challenges(known):
    rows = findings.modelling_challenges(known, rules.CHALLENGES).collect()
    assert [r["evidence"] for r in rows] == [
        "Skewness of median_house_value is 0.9857.",
        "Columns with gaps: total_bedrooms.",
        "Pairs of predictors with |r| of at least 0.80: 7.",
        "Not straight against the response: longitude, latitude, total_rooms, total_bedrooms, households, "
        "housing_median_age, population, median_income.",
        "Columns with 5 % or more flagged rows: total_rooms, total_bedrooms, households, population, "
        "median_house_value.",
        "Rows carry latitude and longitude.",
    ]


def test_notes(known):
    notes = [(r["section"], r["position"], r["note"]) for r in findings.notes(known, rules.NOTES).collect()]
    assert len(notes) == 5 + 3 + 4
    texts = {(s, p): n for s, p, n in notes}
    assert texts["eda", 2] == "median_income follows the target most closely on a straight line (r = 0.6879)."
    assert texts["understanding", 2] == "Logical checks to look into: a."
    assert texts["insight", 1] == "median_house_value is known for 14,448 rows; its mean is 207,143.48."
    assert texts["insight", 4] == "The most frequent ocean_proximity is <1H OCEAN."


def test_facts_that_are_not_given_state_nothing(spark, blocks):
    bare = findings.facts(blocks.drop("latitude"), "median_house_value")
    assert findings.modelling_challenges(bare, rules.CHALLENGES).count() == 0


def test_patterns(spark, blocks, tables):
    correlations = tables[0]
    means = spark.createDataFrame(
        [("ocean_proximity", "ISLAND", 351100.0), ("ocean_proximity", "INLAND", 124979.5),
         ("ocean_proximity", None, None)],
        "categorical_variable string, category_level string, target_mean double")
    patterns = [
        findings.Pattern("correlation", "median_income", ("median_income",), "", "", ""),
        findings.Pattern("category", "ocean_proximity", ("ocean_proximity",), "", "", ""),
        findings.Pattern("stated", "unknown", ("not_a_column",), "", "", "", "text"),
    ]
    rows = findings.pattern_summary(blocks, patterns, correlations, means).collect()
    assert [r["observed_pattern"] for r in rows] == [
        "Correlation with the response = 0.6879.",
        "Highest mean response category: ISLAND; lowest: INLAND.",
    ]
