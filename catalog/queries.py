"""Registered queries: each reads whole driver tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import bindings as b
from plumbline.functions.durable import kept, shared_folder
from plumbline.operators import (
    curvature, eda, features, figures, findings, governance, grown, models, nearest, outliers, prep, profile, sparse, split, validate,
)
from plumbline.plans import rules, workflow
from plumbline.schema import ColumnRule, SemanticSchema
from plumbline.sources import fingerprint, registry, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MEASURED = [*b.NUMBERS, b.TARGET]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _block(spark: SparkSession, sf: str) -> DataFrame:
    return b.order_block(spark, sf)


def _fitted_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.stratified_split(_block(spark, sf), b.KEY, b.STRATUM, b.EDGES, seed=b.SEED)


def _split(spark: SparkSession, sf: str) -> DataFrame:
    """The split order table, landed once per session for the queries that start from it."""
    return b.landed(spark, sf, "split", lambda: _fitted_split(spark, sf))


# Scans, sources, sinks


def _spoiled_events(spark, sf):
    k = F.col("event_id")
    broken = F.when(k % 97 == 0, F.lit("NaN").cast("double")).when(k % 101 == 0, F.lit("-Infinity").cast("double"))
    raw = b.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", broken.alias("broken"), "value"
    )
    return raw.withColumn("value", F.coalesce("broken", "value")).drop("broken")


@query
def scan_normalised(spark, sf):
    return b.shown(tables.with_missing_as_null(_spoiled_events(spark, sf)))


@query
def scan_delimited(spark, sf):
    """The events as delimited files with a header, written by Spark and scanned with a declared schema."""
    raw = _spoiled_events(spark, sf)
    path = f"{shared_folder(spark).rstrip('/')}/plumbline/{uuid.uuid4().hex}"
    tables.write_table(raw, path, fmt="csv")
    return b.shown(tables.read_csv(spark, path, raw.schema))


@query
def dataset_fingerprint(spark, sf):
    return fingerprint.dataset_fingerprint(b.table(spark, sf, "orders"))


@query
def appended_fingerprint(spark, sf):
    """The orders, landed in two appends, by the sums of their files: the second run reads the new files only."""
    place = f"{shared_folder(spark).rstrip('/')}/plumbline/{uuid.uuid4().hex}"
    path, manifest = f"{place}/orders", f"{place}/manifest"
    orders = b.table(spark, sf, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    for part in (orders.where(urgent), orders.where(~urgent | urgent.isNull())):
        part.write.mode("append").parquet(path)
        found = fingerprint.table_fingerprint(spark, path, manifest)
    return found


@query
def coerce_numeric(spark, sf):
    k = F.col("event_id")
    text = (
        F.when(k % 97 == 0, "NaN").when(k % 101 == 0, "Infinity").when(F.col("event_type") == "error", "n/a")
        .otherwise(F.col("value").cast("string"))
    )
    events = b.table(spark, sf, "events").select("event_id", text.alias("value"))
    return b.shown(prep.coerce_numeric(events, ["value"]))


@query
def schema_clean(spark, sf):
    return b.shown(tables.schema_clean(b.untidy_block(spark, sf), b.block_schema(), keep=[b.KEY]))


@query
def preprocessing_audit(spark, sf):
    raw, schema = b.untidy_block(spark, sf), b.block_schema()
    cleaned = tables.schema_clean(raw, schema)
    status = validate.validation_summary(raw, schema).first()["status"]
    return validate.preprocessing_audit(raw, schema, cleaned, status)


@query
def preview(spark, sf):
    return b.shown(profile.preview(_block(spark, sf), [b.KEY], 10))


# Validation


@query
def validation_issues(spark, sf):
    return validate.validation_issues(b.faulty_block(spark, sf), b.block_schema())


@query
def validation_issues_all_rules(spark, sf):
    """Branches that the order table does not take: an absent column, a wrong type, a maximum."""
    counted = {"semantic_type": "count", "minimum": 0.0, "whole_number": True}
    schema = SemanticSchema(
        (
            ColumnRule("line_count", maximum=5.0, **counted),
            ColumnRule("segment", **counted),
            ColumnRule("total_qty", "nominal_categorical", storage="string"),
            ColumnRule("not_there", **counted),
            ColumnRule("block_id", **counted),
        ),
        (),
    )
    block = _block(spark, sf).select("block_id", "line_count", "segment", "total_qty")
    return validate.validation_issues(block, schema)


@query
def validation_observations(spark, sf):
    return b.shown(validate.validation_observations(b.faulty_block(spark, sf), b.block_schema(), rules=None))


@query
def minimum_bound_observations(spark, sf):
    return b.shown(validate.validation_observations(b.faulty_block(spark, sf), b.block_schema()))


@query
def validation_summary(spark, sf):
    return validate.validation_summary(b.faulty_block(spark, sf), b.block_schema())


@query
def unexpected_values(spark, sf):
    """More bad values than any message could list."""
    events = b.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user"))
    rule = ColumnRule("user", "nominal_categorical", storage="string", allowed_values=("1", "2", "3"))
    return validate.unexpected_values(events, SemanticSchema((rule,), ()))


@query
def logical_checks(spark, sf):
    return validate.logical_checks(b.faulty_block(spark, sf), b.block_schema())


# Profiling


@query
def dataset_summary(spark, sf):
    return b.shown(profile.dataset_summary(b.faulty_block(spark, sf), b.block_schema()))


@query
def column_profile(spark, sf):
    return b.shown(profile.column_profile(_block(spark, sf), b.KEY))


@query
def datetime_candidates(spark, sf):
    orders = b.table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
        F.when(F.col("o_orderkey") % 5 != 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.lit("unknown")).alias("mixed_day"),
    )
    return profile.datetime_candidates(orders)


@query
def precise_values(spark, sf):
    """Doubles that differ in their last digits, tiny ones, and both zeros."""
    k, tenth = F.col("o_orderkey") % 6, F.lit(0.1)
    value = (
        F.when(k == 0, tenth + F.lit(0.2)).when(k == 1, F.lit(0.3)).when(k == 2, F.lit(1e-20)).when(k == 3, F.lit(2e-20))
        .when(k == 4, F.lit(-0.0)).otherwise(F.lit(0.0))
    )
    counted = profile.value_frequencies(b.table(spark, sf, "orders").select(value.alias("value")))
    return counted.join(profile.distinct_counts(counted), "column_name").select("number", "frequency", "unique_count")


@query
def categorical_candidates(spark, sf):
    return b.shown(profile.categorical_candidates(b.faulty_block(spark, sf)))


@query
def example_values(spark, sf):
    frequencies = profile.value_frequencies(_block(spark, sf), row_key=b.KEY)
    return profile.example_values(frequencies)


@query
def variable_summary(spark, sf):
    return b.shown(eda.variable_summary(_block(spark, sf), b.block_schema(), b.KEY))


@query
def duplicate_rows(spark, sf):
    return profile.duplicate_rows(b.faulty_block(spark, sf))


@query
def duplicate_rows_many(spark, sf):
    """With more repeated hashes than may be broadcast: every row is compared by its digest."""
    return profile.duplicate_rows(b.faulty_block(spark, sf), by_hash=True, limit=10)


@query
def text_unique_counts(spark, sf):
    """Distinct values of text columns that are nearly unique, repeat in part, or have few values."""
    documents = b.table(spark, sf, "documents").select("text", "lang", "source", F.col("n_chars").cast("string").alias("length"))
    return profile.unique_counts(documents)


@query
def missing_summary(spark, sf):
    return b.shown(profile.missing_summary(b.faulty_block(spark, sf), b.block_schema()))


@query
def missing_table(spark, sf):
    return profile.missing_table(b.faulty_block(spark, sf))


@query
def categorical_frequencies(spark, sf):
    documents = b.table(spark, sf, "documents").select("lang", "source")
    return b.shown(profile.categorical_frequencies(documents, ["lang", "source"]))


@query
def structure_table(spark, sf):
    return profile.structure_table(b.faulty_block(spark, sf))


@query
def value_counts(spark, sf):
    return profile.value_counts(b.faulty_block(spark, sf), b.CATEGORY)


# Exploratory statistics


@query
def describe_numeric(spark, sf):
    return eda.describe_numeric(_block(spark, sf), MEASURED)


@query
def target_statistics(spark, sf):
    return eda.target_statistics(_block(spark, sf), b.TARGET)


@query
def distribution_summary(spark, sf):
    return b.shown(eda.distribution_summary(_block(spark, sf), MEASURED))


@query
def lineitem_distribution(spark, sf):
    lines = b.table(spark, sf, "lineitem")
    return b.shown(eda.distribution_summary(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query
def correlation_matrix(spark, sf):
    block = _block(spark, sf).withColumn("unit", F.lit(1.0))
    return b.shown(eda.correlation_matrix(block, [*MEASURED, "unit"]))


def _wide_block(spark, sf):
    """More pairs than one aggregation holds, some columns with gaps, one constant."""
    columns = {name: F.col(name).cast("double") for name in MEASURED}
    columns["total_qty"] = F.when(F.col(b.KEY) % 11 != 0, F.col("total_qty"))
    for power in (2, 3):
        columns |= {f"{name}_{power}": F.pow(F.col(name) / 100.0, F.lit(float(power))) for name in MEASURED}
    columns["unit"] = F.lit(1.0)
    return _block(spark, sf).select(*[column.alias(name) for name, column in columns.items()])


@query
def correlation_wide(spark, sf):
    return b.shown(eda.correlation_matrix(_wide_block(spark, sf)))


@query
def correlation_tiled(spark, sf):
    """The same table cut into tiles of a few columns, as thousands of columns are."""
    return b.shown(eda.correlation_matrix(_wide_block(spark, sf), tile=5))


@query
def correlation_heatmap(spark, sf):
    return b.shown(figures.heatmap_cells(_block(spark, sf), MEASURED))


@query
def target_correlations(spark, sf):
    return b.shown(eda.target_correlations(_block(spark, sf), b.TARGET, MEASURED))


@query
def correlation_screen(spark, sf):
    return b.shown(eda.correlation_screen(_block(spark, sf), b.TARGET, MEASURED))


@query
def categorical_target_summary(spark, sf):
    return b.shown(eda.categorical_target_summary(b.faulty_block(spark, sf), [b.CATEGORY], b.TARGET))


@query
def outlier_summary(spark, sf):
    return b.shown(outliers.outlier_summary(_block(spark, sf), MEASURED))


# Groups above so many rows take the way of large groups: counted cells instead of a sort.
FEW = 500


@query
def outlier_summary_narrowed(spark, sf):
    block = _block(spark, sf)
    return b.shown(outliers.outlier_summary(block, MEASURED, outliers.fit_fences(block, MEASURED, bounded=FEW)))


@query
def outlier_iqr_only(spark, sf):
    return b.shown(outliers.outlier_iqr_only(b.table(spark, sf, "documents"), ["n_chars"]))


@query
def outlier_observations(spark, sf):
    return b.shown(outliers.outlier_observations(_block(spark, sf), MEASURED))


# Tables behind figures


@query
def histogram(spark, sf):
    return b.shown(figures.histogram(b.table(spark, sf, "events"), "value", figures.TARGET_BINS))


@query
def boxplot_stats(spark, sf):
    return b.shown(figures.boxplot_stats(_block(spark, sf), MEASURED))


@query
def scatter_sample(spark, sf):
    block = _block(spark, sf)
    correlations = eda.target_correlations(block, b.TARGET, MEASURED)
    return b.shown(figures.target_scatter(block, b.KEY, b.TARGET, correlations, top=3, size=1000))


@query
def grid_map(spark, sf):
    return b.shown(figures.grid_map(_block(spark, sf), "cust_balance", "total_qty", b.TARGET, 1000.0, 25.0))


# Curvature, candidates, findings


@query
def curvature_binned(spark, sf):
    return b.shown(curvature.binned_screen(_block(spark, sf), b.NUMBERS, b.TARGET))


@query
def curvature_binned_narrowed(spark, sf):
    scores = curvature.binned_scores(_block(spark, sf), b.NUMBERS, b.TARGET, bounded=FEW)
    return b.shown(curvature.screen_table(scores))


@query
def lowess_screen(spark, sf):
    """With the reweighting rounds of the method, over the order table as it is."""
    return b.shown(curvature.lowess_screen(_block(spark, sf), b.NUMBERS, b.TARGET, rounds=curvature.ROBUST_ROUNDS))


def _spiked_block(spark, sf):
    """The order table with outlying values of the target in a few rows of all."""
    spike = F.when(F.col(b.KEY) % 61 == 0, F.lit(40.0)).otherwise(F.lit(1.0))
    return _block(spark, sf).withColumn(b.TARGET, F.col(b.TARGET) * spike)


@query
def lowess_robust(spark, sf):
    return b.shown(curvature.robust_screen(_spiked_block(spark, sf), b.NUMBERS, b.TARGET, rounds=2))


@query
def lowess_robust_narrowed(spark, sf):
    """With fewer cells; groups above FEW rows take the way of large ones."""
    spiked = _spiked_block(spark, sf)
    return b.shown(curvature.robust_screen(spiked, b.NUMBERS, b.TARGET, rounds=2, bounded=10 * FEW, cells=20))


def _columns_only(spark, sf):
    """The training rows, without key and split: what is explored must not see held-out rows."""
    return prep.training_rows(_split(spark, sf)).drop(b.KEY, "split", "stratum")


def _outliers(block):
    return kept(outliers.outlier_summary(block, MEASURED))


def _correlations(block):
    return kept(eda.target_correlations(block, b.TARGET, MEASURED))


def _screen(block):
    return kept(curvature.binned_screen(block, b.NUMBERS, b.TARGET))


@query
def candidate_variables(spark, sf):
    block = _columns_only(spark, sf)
    return b.shown(
        findings.candidate_variables(
            block, b.block_schema(), _correlations(block), _screen(block), _outliers(block)
        )
    )


def _facts(block, target, measured, **more):
    predictors = [c for c in measured if c != target]
    return findings.facts(
        block,
        target,
        shape=eda.moment_table(block, [target]),
        gaps=profile.null_counts(block),
        correlations=eda.target_correlations(block, target, measured),
        pairs=eda.correlation_screen(block, target, measured),
        screen=curvature.binned_screen(block, predictors, target),
        outliers=outliers.outlier_summary(block, measured),
        **more,
    )


@query
def modelling_challenges(spark, sf):
    return findings.modelling_challenges(_facts(_columns_only(spark, sf), b.TARGET, MEASURED), rules.CHALLENGES)


STRAINED = ["total_qty", "line_count", "part_count", "cust_balance", "spiked", "strained_value"]


@query
def modelling_challenges_all(spark, sf):
    block = b.strained_block(spark, sf).drop(b.KEY)
    return findings.modelling_challenges(_facts(block, STRAINED[-1], STRAINED), rules.CHALLENGES)


@query
def eda_findings(spark, sf):
    block = _columns_only(spark, sf)
    known = _facts(
        block,
        b.TARGET,
        MEASURED,
        checks=validate.logical_checks(block, b.block_schema()),
        counts=profile.value_counts(block, b.CATEGORY),
        feature="cust_balance",
        category=b.CATEGORY,
    )
    return findings.notes(known, rules.NOTES)


PATTERNS = (
    findings.Pattern("correlation", "line_count", ("line_count",), "Longer orders hold more goods.",
                     "Useful for planning by order length.", "Associative; overlaps with quantity."),
    findings.Pattern("category", "segment", ("segment",), "Segments may buy different goods.",
                     "Useful for segmentation.", "Overlaps with balance."),
    findings.Pattern("stated", "order size variables", ("total_qty", "line_count"),
                     "Raw counts measure order size.", "Ratios are easier to compare.",
                     "Assess estimability first.", "Size counts are associated with one another."),
)


@query
def pattern_summary(spark, sf):
    block = _columns_only(spark, sf)
    return findings.pattern_summary(
        block,
        PATTERNS,
        eda.target_correlations(block, b.TARGET, MEASURED),
        kept(eda.categorical_target_summary(block, [b.CATEGORY], b.TARGET)),
    )


@query
def eda_headline(spark, sf):
    block = _columns_only(spark, sf)
    return findings.eda_headline(
        block,
        b.TARGET,
        eda.correlation_screen(block, b.TARGET, MEASURED),
        _screen(block),
        kept(governance.feature_recommendations(block, b.RATIOS, b.INTERACTIONS)),
    )


# Sampling and splitting


@query
def stratum_counts(spark, sf):
    return b.shown(split.stratum_counts(_block(spark, sf), b.STRATUM, b.EDGES))


@query
def stratified_split(spark, sf):
    return _fitted_split(spark, sf).select(b.KEY, "stratum", "split")


@query
def stratified_split_narrowed(spark, sf):
    made = split.stratified_split(
        _block(spark, sf), b.KEY, b.STRATUM, b.EDGES, seed=b.SEED, boundary_rows=40, prefix_digits=1
    )
    return made.select(b.KEY, "stratum", "split")


@query
def split_audit(spark, sf):
    return b.shown(split.split_audit(_split(spark, sf)))


# Features


@query
def ratio_features(spark, sf):
    made = features.ratio_features(_block(spark, sf), b.RATIOS)
    return b.shown(made.select(b.KEY, *[r.name for r in b.RATIOS]))


@query
def ratio_audit(spark, sf):
    return features.ratio_audit(_block(spark, sf), b.RATIOS)


@query
def interaction_features(spark, sf):
    block = _block(spark, sf)
    levels = prep.fit_levels(block, [b.CATEGORY])[b.CATEGORY]
    made = features.interaction_features(
        block,
        {"qty_x_lines": ("total_qty", "line_count"), "balance_x_lines": ("cust_balance", "line_count")},
        {"balance_segment": ("cust_balance", b.CATEGORY, levels)},
    )
    return b.shown(made.drop(*[c for c in block.columns if c != b.KEY]))


@query
def squared_features(spark, sf):
    made = features.squared_features(_block(spark, sf), b.NUMBERS)
    return b.shown(made.select(b.KEY, *[f"{n}_squared" for n in b.NUMBERS]))


def _fitted(spark, sf, make, columns):
    rows = _split(spark, sf)
    made = make(rows, prep.training_rows(rows), columns)
    return b.shown(made.drop(*[c for c in rows.columns if c != b.KEY]))


@query
def centered_features(spark, sf):
    return _fitted(spark, sf, features.centered_features, ["total_qty", "cust_balance"])


@query
def standardized_features(spark, sf):
    return _fitted(spark, sf, features.standardized_features, [*b.NUMBERS, b.TARGET])


@query
def spline_features(spark, sf):
    return _fitted(spark, sf, features.spline_features, ["total_qty", "cust_balance"])


@query
def orthogonal_poly(spark, sf):
    return _fitted(spark, sf, features.orthogonal_poly, ["total_qty", "line_count"])


@query
def composite_index(spark, sf):
    return _fitted(
        spark, sf, features.composite_index, {"total_qty": 0.5, "line_count": 0.3, "cust_balance": 0.2}
    )


@query
def polynomial_features(spark, sf):
    columns = ["total_qty", "line_count", "supp_count"]
    block = _block(spark, sf)
    made = features.polynomial_features(block, columns)
    return b.shown(made.drop(*[c for c in block.columns if c != b.KEY]))


@query
def category_groups(spark, sf):
    # The approved grouping: segments that buy goods for a home, others.
    orders = _block(spark, sf)
    counts = profile.value_counts(orders, b.CATEGORY).where(F.col("value").isin("FURNITURE", "HOUSEHOLD", "BUILDING"))
    mapping = counts.select(F.col("value").alias("level"), F.lit("HOME").alias("group_name"))
    return features.category_groups(orders, b.CATEGORY, mapping, "segment_group").select(
        b.KEY, "segment", "segment_group"
    )


WAREHOUSES = ((40.7, -74.0), (51.5, -0.1), (-33.9, 151.2))


@query
def nearest_distance(spark, sf):
    placed = b.table(spark, sf, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 120.0).alias("latitude"),
        (F.col("c_nationkey") * 14.0 - 170.0).alias("longitude"),
    )
    made = features.nearest_distance(placed, "latitude", "longitude", WAREHOUSES)
    return b.shown(made.select("c_custkey", "nearest_distance_km"))


@query
def nearest_point(spark, sf):
    """Each customer's distance to the nearest of all suppliers and parts, put at places of their own."""
    placed = b.table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 120.0).alias("latitude"), (F.col("c_nationkey") * 14.0 - 170.0).alias("longitude")
    )
    depots = b.table(spark, sf, "supplier").select(
        (F.col("s_suppkey") % 170 - 85.0).alias("latitude"), (F.col("s_suppkey") * 37 % 360 - 180.0).alias("longitude")
    )
    # Parts crowd around one place and a date line.
    shops = b.table(spark, sf, "part").select(
        (F.col("p_partkey") % 97 / 50.0 + 20.0).alias("latitude"),
        F.when(F.col("p_partkey") % 3 == 0, 179.0 + F.col("p_partkey") % 89 / 100.0)
        .otherwise(F.col("p_partkey") % 101 / 40.0 - 60.0).alias("longitude"),
    )
    made = nearest.nearest_point(placed, "latitude", "longitude", depots.unionByName(shops))
    return b.shown(made.select("c_custkey", "nearest_distance_km"))


# Governance


def _plan(spark, sf):
    train = _columns_only(spark, sf)
    screen = curvature.binned_screen(train, b.NUMBERS, b.TARGET)
    plan = governance.feature_plan(
        train, b.block_schema(), b.RATIOS, b.INTERACTIONS, b.DOMAIN, screen, b.NUMBERS[:1]
    )
    return train, plan


@query
def feature_recommendations(spark, sf):
    return governance.feature_recommendations(_columns_only(spark, sf), b.RATIOS, b.INTERACTIONS)


@query
def feature_plan(spark, sf):
    return _plan(spark, sf)[1]


@query
def feature_repository(spark, sf):
    return governance.feature_repository(_plan(spark, sf)[1])


@query
def feature_dependencies(spark, sf):
    train, plan = _plan(spark, sf)
    return governance.feature_dependencies(plan, train)


@query
def feature_plan_summary(spark, sf):
    return governance.feature_plan_summary(_plan(spark, sf)[1])


# Model inputs


@query
def drop_null_target(spark, sf):
    return b.shown(prep.drop_null_target(_block(spark, sf), b.TARGET))


@query
def selected_features(spark, sf):
    made = features.ratio_features(_block(spark, sf), b.RATIOS)
    return b.shown(prep.selected_features(made, b.SELECTED, b.TARGET, keep=[b.KEY]))


@query
def align_columns(spark, sf):
    return b.shown(
        prep.align_columns(_block(spark, sf), ["line_count", "absent_column", "total_qty"], keep=[b.KEY])
    )


@query
def one_hot(spark, sf):
    rows = _split(spark, sf).select(b.KEY, "split", "line_count", "segment")
    k = F.col(b.KEY)
    unseen = (F.col("split") == split.TEST) & (k % 89 == 0)
    rows = rows.withColumn("segment", F.when(unseen, "NEW").when(k % 83 != 0, F.col("segment")))
    levels = prep.fit_levels(prep.training_rows(rows), ["segment"])
    return b.shown(prep.one_hot(rows, levels, keep=[b.KEY, "split"]))


def _wide_lines(spark, sf):
    """Order lines with a category of thousands of levels: part and supplier; a fifth of the orders is held out."""
    level = F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    lines = b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", level.alias("part_supplier"),
        F.round("l_extendedprice", 2).alias("price"), (F.col("l_orderkey") % 5 != 0).alias("trained"),
    )
    return lines.withColumn("part_supplier", F.when(F.col("l_orderkey") % 83 != 0, F.col("part_supplier")))


@query
def one_hot_wide(spark, sf):
    """Number of each line's level among the training levels, NULL where it is unseen or missing."""
    lines = _wide_lines(spark, sf)
    layout = sparse.fit_layout(lines.where("trained"), ["l_quantity"], ["part_supplier"])
    return sparse.level_numbers(lines, layout, ["l_orderkey", "l_linenumber"])


@query
def sparse_features(spark, sf):
    """Places of the sparse layout that hold levels, with their names."""
    lines = _wide_lines(spark, sf)
    layout = sparse.fit_layout(lines.where("trained"), ["l_quantity"], ["part_supplier"])
    return layout.features()


@query
def ridge_wide(spark, sf):
    """Ridge on the levels alone, where each coefficient has a closed form: those that meet it."""
    lines = _wide_lines(spark, sf)
    layout = sparse.fit_layout(lines.where("trained"), [], ["part_supplier"])
    rows = sparse.sparse_rows(lines.where("trained and price is not null"), layout, ["price"])
    coefficients = sparse.ridge_coefficients(sparse.fit_ridge(rows, "price", layout=layout), layout)
    # A level of n rows with mean m has the coefficient n (m - a) / (n + 1), a the intercept.
    intercept = coefficients.where("place < 0").first()["coefficient"]
    means = lines.where("trained and price is not null").groupBy("part_supplier").agg(
        F.count(F.lit(1)).alias("n"), F.avg("price").alias("m")
    )
    named = means.withColumn("feature", F.concat_ws("_", F.lit("part_supplier"), "part_supplier"))
    wanted = F.col("n") * (F.col("m") - F.lit(intercept)) / (F.col("n") + 1)
    met = F.abs(F.col("coefficient") - wanted) <= 1e-6 * F.greatest(F.abs("m"), F.lit(1.0))
    return coefficients.join(named, "feature").select("feature", met.alias("met"))


@query
def median_impute(spark, sf):
    rows = _split(spark, sf).select(b.KEY, "split", "total_qty", b.TARGET)
    rows = rows.withColumn("empty_column", F.lit(None).cast("double"))
    medians = prep.fit_medians(prep.training_rows(rows), ["total_qty", b.TARGET, "empty_column"])
    return b.shown(prep.median_impute(rows, medians))


@query
def median_impute_narrowed(spark, sf):
    rows = _split(spark, sf).select(b.KEY, "split", "total_qty", b.TARGET)
    rows = rows.withColumn("empty_column", F.lit(None).cast("double"))
    medians = prep.fit_medians(prep.training_rows(rows), ["total_qty", b.TARGET, "empty_column"], bounded=FEW)
    return b.shown(prep.median_impute(rows, medians))


def _prepared(spark, sf):
    rows = _split(spark, sf)
    fitted = prep.fit_preparation(prep.training_rows(rows), b.SELECTED, b.TARGET, b.RATIOS)
    return prep.prepared_splits(rows, fitted, [b.KEY]), fitted


@query
def preprocessed_splits(spark, sf):
    return b.shown(_prepared(spark, sf)[0])


@query
def feature_names(spark, sf):
    prepared, fitted = _prepared(spark, sf)
    return governance.feature_names(fitted.layout, prep.training_rows(prepared))


# Models


@dataclass(frozen=True)
class Trained:
    """Models of one table and the rows they are scored on."""

    models: dict[str, PipelineModel]
    layout: list[str]
    prepared: DataFrame
    comparison: list
    seconds: dict[str, float]

    def part(self, name: str) -> DataFrame:
        return self.prepared.where(F.col("split") == name)

    @property
    def best(self) -> PipelineModel:
        return self.models[self.comparison[0]["Model"]]


_TRAINED: dict[tuple[str, str], Trained] = {}


def trained(spark: SparkSession, sf: str) -> Trained:
    """Train once per session and table; the queries on models share the result."""
    place = (spark.sparkContext.applicationId, sf)
    if place not in _TRAINED:
        prepared, fitted = _prepared(spark, sf)
        layout = fitted.layout
        rows = prepared.where(F.col("split") == split.TRAIN)
        seconds: dict[str, float] = {}
        made = models.train_models(rows, layout, b.TARGET, seconds=seconds)
        check = prepared.where(F.col("split") == split.VALIDATION)
        comparison = models.model_comparison(made, check, layout, b.TARGET).collect()
        _TRAINED[place] = Trained(made, layout, prepared, comparison, seconds)
    return _TRAINED[place]


@query
def model_comparison(spark, sf):
    t = trained(spark, sf)
    return models.model_comparison(t.models, t.part(split.VALIDATION), t.layout, b.TARGET)


@query
def best_model(spark, sf):
    return models.best_model(model_comparison(spark, sf))


@query
def ridge_coefficients(spark, sf):
    t = trained(spark, sf)
    return models.ridge_coefficients(t.models[models.RIDGE], t.layout, t.prepared)


@query
def ridge_normal_equations(spark, sf):
    prepared, fitted = _prepared(spark, sf)
    rows = prep.training_rows(prepared)
    made = models.train_models(rows, fitted.layout, b.TARGET, only=[models.RIDGE])
    return b.shown(models.ridge_normal_equations(made[models.RIDGE], rows, fitted.layout, b.TARGET))


@query
def feature_importance(spark, sf):
    t = trained(spark, sf)
    return models.feature_importance(t.models[models.FOREST], t.layout, t.prepared)


@query
def test_metrics(spark, sf):  # noqa: PT
    t = trained(spark, sf)
    return models.test_metrics(t.best, t.part(split.TEST), t.layout, b.TARGET)


@query
def predictions(spark, sf):
    t = trained(spark, sf)
    return b.shown(models.predictions(t.best, t.part(split.TEST), t.layout, b.KEY, b.TARGET))


@query
def residual_diagnostics(spark, sf):
    t = trained(spark, sf)
    return b.shown(models.residuals(t.best, t.part(split.VALIDATION), t.layout, b.KEY, b.TARGET))


@query
def residual_histogram(spark, sf):
    t = trained(spark, sf)
    table = models.residuals(t.best, t.part(split.VALIDATION), t.layout, b.KEY, b.TARGET)
    return b.shown(models.residual_histogram(table))


GROWN = ["line_count", "total_qty"]


def _grown_tree(spark, sf, settings: grown.GrownSettings) -> DataFrame:
    """The orders as one fully grown tree without bootstrap fits them: means of orders alike in the features."""
    rows = _block(spark, sf).where(F.col(b.TARGET).isNotNull()).select(b.KEY, *GROWN, b.TARGET)
    forest = grown.fit_grown(rows, b.KEY, GROWN, b.TARGET, settings)
    return b.shown(grown.predict_grown(forest, rows, b.KEY, settings))


@query
def grown_tree(spark, sf):
    return _grown_tree(spark, sf, grown.GrownSettings(trees=1, bootstrap=False))


@query
def grown_tree_handover(spark, sf):
    return _grown_tree(spark, sf, grown.GrownSettings(trees=1, bootstrap=False, handover=FEW * 20))


_GROWN: dict[tuple[str, str], tuple[grown.GrownForest, DataFrame]] = {}


def grown_forest(spark: SparkSession, sf: str) -> tuple[grown.GrownForest, DataFrame]:
    """The forest of the reference settings, its trees grown fully on the training rows, and the prepared rows; once per session."""
    place = (spark.sparkContext.applicationId, sf)
    if place not in _GROWN:
        prepared, fitted = _prepared(spark, sf)
        _GROWN[place] = grown.fit_grown(prep.training_rows(prepared), b.KEY, fitted.layout, b.TARGET), prepared
    return _GROWN[place]


@query
def grown_forest_metrics(spark, sf):
    forest, prepared = grown_forest(spark, sf)
    held_out = prepared.where(F.col("split") != split.TRAIN)
    scored = grown.predict_grown(forest, held_out, b.KEY)
    return models.regression_metrics(held_out.join(scored, b.KEY), b.TARGET, "prediction", ["split"])


@query
def grown_forest_importance(spark, sf):
    return grown.grown_importance(grown_forest(spark, sf)[0])


@query
def registry_snapshot(spark, sf):
    t = trained(spark, sf)
    comparison = kept(models.model_comparison(t.models, t.part(split.VALIDATION), t.layout, b.TARGET))
    return registry.registry_snapshot(
        _block(spark, sf), b.SELECTED, comparison, models.best_model(comparison),
        "Order value", b.TARGET, sf,
    )


@query
def regression_metrics(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    paired = orders.join(_block(spark, sf), F.col("o_orderkey") == F.col(b.KEY))
    return b.shown(models.regression_metrics(paired, "o_totalprice", b.TARGET, by=["o_orderstatus"]))


# The end-to-end run


def _run_plan() -> workflow.RunPlan:
    return workflow.RunPlan(
        b.block_schema(), b.KEY, b.STRATUM, b.EDGES, b.SELECTED, b.RATIOS, stop_on_failed_validation=False,
        interactions=b.INTERACTIONS, domain=b.DOMAIN, spline_columns=b.NUMBERS[:1], feature="cust_balance",
        category=b.CATEGORY, seed=b.SEED,
    )


# Of each stage the columns that two engines print alike.
STAGE_COLUMNS = {
    "validation_issues": ["severity", "rule", "column", "affected_count", "message"],
    "split_audit": ["split", "stratum", "observations"],
    "logical_checks": ["check_name", "affected_observations", "status"],
    "correlation_screen": ["feature_1", "feature_2"],
    "outlier_summary": ["variable", "iqr_flag_count", "modified_z_flag_count", "combined_flag_count"],
    "curvature_screen": ["feature", "automated_screen"],
    "candidate_variables": ["feature", "observed_linear_association", "exploratory_nonlinearity"],
    "modelling_challenges": ["challenge", "evidence"],
    "notes": ["section", "position", "note"],
    "feature_repository": ["feature_id", "feature_name", "source_columns", "priority", "analyst_decision"],
    "feature_dependencies": ["feature_name", "source_variable"],
}


def _summary(spark, staged):
    rows = []
    for stage, (table, columns) in staged.items():
        found = fingerprint.dataset_fingerprint(table, columns).first()
        rows.append((stage, found["row_total"], found["fingerprint"]))
    return spark.createDataFrame(rows, "stage string, row_total long, fingerprint string")


SPLIT_COLUMNS = {"splits": [b.KEY, "stratum", "split"], "prepared": [b.KEY, "split"]}


@query
def pipeline_summary(spark, sf):
    """Rows and fingerprint of every deterministic stage of the end-to-end run."""
    explored = workflow.explore(_block(spark, sf), _run_plan())
    found = explored.tables | {"splits": explored.splits, "prepared": explored.prepared}
    summary = _summary(spark, {name: (found[name], columns) for name, columns in (STAGE_COLUMNS | SPLIT_COLUMNS).items()})
    explored.forget()
    return summary


@query
def pipeline_summary_kept(spark, sf):
    """The same from results kept by content: what is summed up was reread by a second run that made nothing."""
    place = f"{shared_folder(spark).rstrip('/')}/plumbline/{uuid.uuid4().hex}"
    tables.write_table(_block(spark, sf), f"{place}/orders")
    for _ in range(2):
        kept_run = workflow.run_kept(spark, f"{place}/orders", _run_plan(), f"{place}/store", train=False)
    if kept_run.made:
        raise RuntimeError("The results of the first run were not found.")
    return _summary(
        spark, {name: (kept_run.tables[name], columns) for name, columns in (STAGE_COLUMNS | SPLIT_COLUMNS).items()}
    )
