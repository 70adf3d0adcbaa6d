"""Feature governance: recommendations, plan, repository, lineage.

These tables describe columns, so their size follows the schema. The evidence in them
(zero denominators, usable rows, curvature classes) is measured on the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.curvature import CURVED, STRONGEST
from plumbline.operators.features import ratio_audit
from plumbline.schema import Ratio, SemanticSchema, quoted

# Codes and groups of the governance tables, in the order of the plan.
CREATE = "Create automatically"
EVALUATE = "Evaluate as a candidate, not as a mandatory feature"
RATIO_KIND = "DETERMINISTIC RATIO"
INTERACTION_KIND = "EXPLORATORY INTERACTION"
GROUP_ORDER = ("Deterministic", "Domain", "Statistical", "Machine Learning", "Inferential")
READY_DECISIONS = ("APPROVE FOR IMPLEMENTATION", "APPROVE FOR ML")
SEPARATOR = " | "
RECOMMENDATION_CAUTION = "A zero denominator gives NULL; whatever is fitted is fitted on training rows."


@dataclass(frozen=True)
class Interaction:
    """A product of two columns, put forward as a hypothesis."""

    name: str
    sources: tuple[str, str]
    formula: str
    meaning: str
    recommended: bool = True


@dataclass(frozen=True)
class Asset:
    """One proposed feature of the plan; field order is the column order."""

    feature_name: str
    feature_group: str
    feature_subtype: str
    source_columns: str
    formula_or_method: str
    business_meaning: str
    analytical_rationale: str
    creation_status: str
    used_by_machine_learning: bool
    used_by_inference: bool
    used_by_optimization: bool
    used_by_grey_models: bool
    requires_training_fit: bool
    validation_rule: str
    leakage_risk: str
    implementation_module: str
    priority: str
    analyst_decision: str
    notes: str = ""


def _fields_of(kind: type) -> str:
    return ", ".join(
        f"{f.name} {'boolean' if f.type == 'bool' else 'string'}" for f in fields(kind)
    )


def feature_recommendations(
    df: DataFrame, ratios: Sequence[Ratio], interactions: Sequence[Interaction]
) -> DataFrame:
    """Features whose source columns exist, with the rows on which each can be computed."""
    proposals = [
        (r.name, f"{r.numerator} / {r.denominator}", r.meaning, RATIO_KIND, CREATE, (r.numerator, r.denominator))
        for r in ratios
    ] + [
        (i.name, i.formula, i.meaning, INTERACTION_KIND, EVALUATE, i.sources)
        for i in interactions
        if i.recommended
    ]
    possible = [p for p in proposals if all(c in df.columns for c in p[-1])]
    if not possible:
        raise ValueError("No recommended feature has its source columns in this table.")
    rows = []
    for name, formula, meaning, kind, rule, sources in possible:
        usable = quoted(sources[0]).isNotNull() & quoted(sources[1]).isNotNull()
        if kind == RATIO_KIND:
            usable = usable & (quoted(sources[1]) != 0)
        rows.append(
            F.struct(
                F.lit(name).alias("recommended_feature"),
                F.lit(formula).alias("formula"),
                F.lit(meaning).alias("business_meaning"),
                F.lit(kind).alias("recommendation_type"),
                F.lit(rule).alias("implementation_rule"),
                F.lit(RECOMMENDATION_CAUTION).alias("caution"),
                F.count_if(usable).alias("usable_rows"),
            )
        )
    return df.agg(F.array(*rows).alias("all")).select(F.inline("all"))


@dataclass(frozen=True)
class Family:
    """What all features made by one function of this package have in common.

    ``uses`` has M for machine learning, I for inference, O for optimisation, G for grey models.
    """

    group: str
    subtype: str
    made_by: str
    uses: str
    status: str
    decision: str
    priority: str
    reason: str
    check: str
    fitted: bool = False
    risk: str = "LOW"


_FEATURES, _PREP = "plumbline.operators.features.", "plumbline.operators.prep."
BY_EVIDENCE, AFTER_BASELINE = "DECIDE BY EVIDENCE", "AFTER BASELINE"
NEEDS_REVIEW, NEEDS_DATA = "NEEDS DOMAIN REVIEW", "NEEDS EXTERNAL DATA"

RATIO = Family(
    "Deterministic", "Ratio", _FEATURES + "ratio_features", "MIOG", "READY", READY_DECISIONS[0], "HIGH",
    "A share does not grow with the size of the unit.", "NULL where the denominator is 0 or missing.",
)
GROUPING = Family(
    "Domain", "Grouped levels", _FEATURES + "category_groups", "MI", "OPTIONAL", NEEDS_REVIEW, "LOW",
    "Rare levels say more together.", "One mapping for all splits.",
)
DISTANCE = Family(
    "Domain", "Distance", _FEATURES + "nearest_distance", "MIO", "WAITS FOR DATA", NEEDS_DATA, "LOW",
    "Raw coordinates do not say how far a place is.", "Reference points are documented.",
)
INDEX = Family(
    "Domain", "Composite index", _FEATURES + "composite_index", "MIO", "WAITS FOR DATA", NEEDS_DATA, "LOW",
    "Stands for what the table does not hold.", "Weights are documented.",
)
SQUARE = Family(
    "Statistical", "Squared term", _FEATURES + "squared_features", "I", "CANDIDATE", BY_EVIDENCE, "MEDIUM",
    "The curvature screen finds a bend.", "Stays only if validation rows gain by it.",
)
PRODUCT = Family(
    "Statistical", "Product term", _FEATURES + "interaction_features", "MI", "CANDIDATE", BY_EVIDENCE, "MEDIUM",
    "A hypothesis; single effects do not prove it.", "Stays only if it adds to both single terms.",
)
_ML, _INFERENCE = "Machine Learning", "Inferential"
#: Terms fitted on training rows: family, name, the schema columns they read, method, meaning.
MODEL_TERMS = (
    (
        Family(_ML, "Indicators", _PREP + "one_hot", "M", "REQUIRED", READY_DECISIONS[1], "HIGH",
               "Linear models need numbers.", "Levels come from training rows.", True, "HIGH"),
        "one_hot_categorical_predictors", "categorical", "0/1 per training level but the first",
        "Levels without an order among them.",
    ),
    (
        Family(_ML, "Scaling", _FEATURES + "standardized_features", "M", "REQUIRED", READY_DECISIONS[1], "HIGH",
               "Penalties compare coefficients.", "Mean and deviation come from training rows.", True, "HIGH"),
        "standardized_numeric_predictors", "numerical", "(x - mean) / deviation", "Columns on one scale.",
    ),
    (
        Family(_ML, "Polynomials", _FEATURES + "polynomial_features", "M", "OPTIONAL", AFTER_BASELINE, "LOW",
               "Helps where a straight line underfits.", "The degree is chosen on validation rows.", True, "HIGH"),
        "polynomial_feature_expansion", "numerical", "squares and pairwise products", "Bends and joint effects.",
    ),
    (
        Family(_ML, "Splines", _FEATURES + "spline_features", "M", "OPTIONAL", AFTER_BASELINE, "LOW",
               "Bends without high powers.", "Knots are quantiles of training rows.", True, "HIGH"),
        "spline_basis_for_prediction", "numerical", "restricted cubic spline", "Smooth effects.",
    ),
    (
        Family(_INFERENCE, "Orthogonal polynomials", _FEATURES + "orthogonal_poly", "I", "CANDIDATE", AFTER_BASELINE,
               "LOW", "Powers of a column are collinear.", "Moments come from training rows.", True, "HIGH"),
        "orthogonal_polynomial_terms", "numerical", "first and second orthogonal term", "A bend apart from the slope.",
    ),
    (
        Family(_INFERENCE, "Centering", _FEATURES + "centered_features", "I", "OPTIONAL", BY_EVIDENCE, "MEDIUM",
               "Products of raw columns are collinear with them.", "Means come from training rows.", True, "HIGH"),
        "centered_numeric_predictors", "numerical", "x - mean", "Effects read at the mean.",
    ),
    (
        Family(_INFERENCE, "Splines", _FEATURES + "spline_features", "I", "CANDIDATE", AFTER_BASELINE, "MEDIUM",
               "Lines and squares may not suffice.", "Knots are quantiles of training rows.", True, "HIGH"),
        "interpretable_spline_basis", "", "restricted cubic spline", "A smooth effect that can be drawn.",
    ),
)


def planned(
    family: Family, name: str, sources: Sequence[str], formula: str, meaning: str, note: str = "", **other: str
) -> Asset:
    """A feature of a family; ``other`` overrides what the family says."""
    f = replace(family, **other)
    uses = [letter in f.uses for letter in "MIOG"]
    return Asset(
        name, f.group, f.subtype, SEPARATOR.join(sources), formula, meaning, f.reason, f.status, *uses, f.fitted,
        f.check, f.risk, f.made_by, f.priority, f.decision, note,
    )


def zero_note(zeros: int) -> str:
    return f"Training rows with a zero denominator: {zeros}."


def plan_order(assets: Sequence[Asset]) -> list[Asset]:
    """By feature group, then priority code, then name."""
    return sorted(assets, key=lambda a: (GROUP_ORDER.index(a.feature_group), a.priority, a.feature_name))


def feature_plan(
    train: DataFrame,
    schema: SemanticSchema,
    ratios: Sequence[Ratio],
    interactions: Sequence[Interaction],
    domain: Sequence[Asset],
    screen: DataFrame,
    spline_columns: Sequence[str],
) -> DataFrame:
    """All proposed features. ``screen`` is a curvature screen of the training rows."""
    known = set(train.columns)
    usable = [r for r in ratios if {r.numerator, r.denominator} <= known]
    zeros = {r["feature_name"]: r["zero_denominators"] for r in ratio_audit(train, usable).collect()} if usable else {}
    curved = screen.where(F.col("exploratory_pattern").isin(*CURVED)).select("feature", "exploratory_pattern").collect()
    read = {"categorical": schema.categorical, "numerical": schema.numerical, "": spline_columns}
    assets = [
        *[
            planned(RATIO, r.name, (r.numerator, r.denominator), f"{r.numerator} / {r.denominator}", r.meaning,
                    zero_note(zeros[r.name]))
            for r in usable
        ],
        *domain,
        *[
            planned(SQUARE, f"{name}_squared", (name,), f"{name} ^ 2", f"The effect of {name} may change along the way.",
                    priority="HIGH" if pattern == STRONGEST else SQUARE.priority)
            for name, pattern in curved
        ],
        *[planned(PRODUCT, i.name, i.sources, i.formula, i.meaning) for i in interactions if set(i.sources) <= known],
        *[planned(family, name, read[of], formula, meaning) for family, name, of, formula, meaning in MODEL_TERMS],
    ]
    return train.sparkSession.createDataFrame([astuple(a) for a in plan_order(assets)], _fields_of(Asset))


def feature_repository(plan: DataFrame) -> DataFrame:
    """The plan with stable identifiers: one row per proposed feature, numbered in plan order."""
    group = F.array_position(F.array(*[F.lit(g) for g in GROUP_ORDER]), F.col("feature_group"))
    order = F.struct(group.alias("g"), F.col("priority").alias("p"), F.col("feature_name").alias("n"))
    rows = plan.agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), *[F.col(c) for c in plan.columns]))).alias("all"))
    numbered = rows.select(F.posexplode("all").alias("place", "row")).select("place", "row.*")
    return numbered.select(
        F.format_string("FEAT-%03d", F.col("place") + 1).alias("feature_id"),
        "feature_name", "feature_group", "feature_subtype", "source_columns", "business_meaning",
        "creation_status", "used_by_machine_learning", "used_by_inference", "used_by_optimization",
        "used_by_grey_models", "requires_training_fit", "implementation_module", "priority", "analyst_decision",
        F.lit("PLANNED").alias("repository_status"),
    )


def feature_dependencies(plan: DataFrame, train: DataFrame) -> DataFrame:
    """One row per (feature, source column) with whether the source is available."""
    available = train.sparkSession.createDataFrame([(c,) for c in train.columns], "known string")
    sources = plan.select(
        "feature_name", "feature_group", F.explode(F.split("source_columns", " \\| ")).alias("source_variable")
    )
    return sources.join(F.broadcast(available), F.col("source_variable") == F.col("known"), "left").select(
        "feature_name", "feature_group", "source_variable",
        F.col("known").isNotNull().alias("source_available_in_training_data"),
    )


def feature_plan_summary(plan: DataFrame) -> DataFrame:
    """Counts by group, and how many are ready or still need a decision."""
    ready = F.col("analyst_decision").isin(*READY_DECISIONS)
    return plan.groupBy("feature_group").agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if(ready).alias("ready"),
        F.count_if(~ready).alias("needing_decision"),
    )


def feature_names(layout: Sequence[str], train: DataFrame) -> DataFrame:
    """Model columns in order, with the training rows that have a value other than 0."""
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("feature_name"),
            F.count_if(quoted(name) != 0).alias("non_zero_rows"),
        )
        for i, name in enumerate(layout, start=1)
    ]
    return train.agg(F.array(*rows).alias("all")).select(F.inline("all"))
