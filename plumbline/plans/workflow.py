"""The end-to-end run: validate, split, profile, explore, plan features, prepare, train, evaluate, register.

One function composes the operators; there is no scheduler. What is explored and fitted sees
training rows only. The split table and the model matrix, the two tables as long as the data,
are written once, below the output folder or the shared scratch folder, and read from there;
control returns to the driver only with results whose size follows the schema.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.durable import forget, remove, shared_folder
from plumbline.operators import (
    curvature, eda, findings, governance, models, outliers, prep, profile, split, validate,
)
from plumbline.plans import rules
from plumbline.schema import Ratio, SemanticSchema, numeric_columns
from plumbline.sources.fingerprint import table_fingerprint
from plumbline.sources.registry import registry_snapshot, write_snapshot
from plumbline.sources.tables import read_parquet, schema_clean, write_table

#: To be raised when a stage gives other results for the same input and plan.
RESULTS_VERSION = 1


@dataclass(frozen=True)
class RunPlan:
    """What one run needs to know about a table."""

    schema: SemanticSchema
    row_key: str
    stratify_by: str
    edges: Sequence[float]
    selected: Sequence[str]
    ratios: Sequence[Ratio] = ()
    project: str = ""
    source: str = ""
    settings: models.ModelSettings = field(default_factory=models.ModelSettings)
    seed: int = 42
    stop_on_failed_validation: bool = True
    interactions: Sequence[governance.Interaction] = ()
    domain: Sequence[governance.Asset] = ()
    spline_columns: Sequence[str] = ()
    wording: findings.Wording = field(default_factory=findings.Wording)
    challenges: Sequence[findings.Rule] = rules.CHALLENGES
    notes: Sequence[findings.Rule] = rules.NOTES
    feature: str = ""
    category: str = ""


@dataclass
class Exploration:
    """Everything up to the model inputs; ``tables`` holds the results by stage, in order."""

    status: str
    tables: dict[str, DataFrame]
    clean: DataFrame
    splits: DataFrame
    prepared: DataFrame
    preparation: prep.Preparation
    #: Tables that lie in their place already.
    written: tuple[str, ...] = ()

    def forget(self) -> None:
        """Delete the tables that a run without an output folder has written."""
        forget(self.splits, self.prepared, *[self.tables[n] for n in self.written])


@dataclass
class RunResult:
    """Handles on everything a run produced."""

    explored: Exploration
    fitted: dict[str, PipelineModel]
    comparison: DataFrame
    best: str
    test: DataFrame
    predictions: DataFrame
    residuals: DataFrame
    importance: DataFrame
    snapshot: DataFrame

    @property
    def status(self) -> str:
        return self.explored.status

    @property
    def splits(self) -> DataFrame:
        return self.explored.splits

    @property
    def preparation(self) -> prep.Preparation:
        return self.explored.preparation


def _written(df: DataFrame, name: str, output: str | None, partition_by: Sequence[str] = ()) -> DataFrame:
    """A data-sized table, written once where the run keeps it."""
    place = output or f"{shared_folder(df.sparkSession).rstrip('/')}/plumbline"
    path = f"{place}/{name}" if output else f"{place}/{uuid.uuid4().hex}"
    write_table(df, path, partition_by=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def explore(raw: DataFrame, plan: RunPlan, output: str | None = None) -> Exploration:
    """All stages before training. They are deterministic, also across partitionings."""
    schema, target, key = plan.schema, plan.schema.target, plan.row_key
    issues, summary = validate.validated(raw.drop(key), schema)
    status = summary.first()["status"]
    if plan.stop_on_failed_validation:
        validate.require_valid(summary)

    clean = schema_clean(raw, schema, keep=[key])
    assigned = split.stratified_split(clean, key, plan.stratify_by, plan.edges, seed=plan.seed)
    splits = _written(assigned, "splits", output)
    split.require_cover(clean, splits)
    keyed = prep.training_rows(splits).drop("split", "stratum")
    train = keyed.drop(key)

    numbers = numeric_columns(train)
    predictors = [n for n in numbers if n != target]
    # Statistics with several readers are written once, where the run keeps its results.
    shared = {
        "logical_checks": validate.logical_checks(train, schema),
        "target_correlations": eda.target_correlations(train, target),
        "correlation_screen": eda.correlation_screen(train, target),
        "outlier_summary": outliers.outlier_summary(train),
        "curvature_screen": curvature.binned_screen(train, predictors, target),
    }
    shared = {name: _written(made, name, output) for name, made in shared.items()}
    checks, correlations, pairs = (shared[n] for n in ("logical_checks", "target_correlations", "correlation_screen"))
    flagged, screen = shared["outlier_summary"], shared["curvature_screen"]
    known = findings.facts(
        train, target, eda.moment_table(train, [target]), profile.null_counts(train), correlations, pairs, screen,
        flagged, checks, profile.value_counts(train, plan.category) if plan.category else None,
        plan.feature, plan.category,
    )
    planned = governance.feature_plan(
        train, schema, plan.ratios, plan.interactions, plan.domain, screen, plan.spline_columns
    )
    planned = shared["feature_plan"] = _written(planned, "feature_plan", output)
    preparation = prep.fit_preparation(train, plan.selected, target, plan.ratios)
    prepared = _written(prep.prepared_splits(splits, preparation, [key]), "prepared", output)
    tables = {
        "validation_issues": issues,
        "validation_summary": summary,
        "split_audit": split.split_audit(splits),
        "column_profile": profile.column_profile(keyed, key),
        "variable_summary": eda.variable_summary(keyed, schema, key),
        "logical_checks": checks,
        "distribution_summary": eda.distribution_summary(train),
        "target_correlations": correlations,
        "correlation_screen": pairs,
        "categorical_target_summary": eda.categorical_target_summary(train, schema.categorical, target),
        "outlier_summary": flagged,
        "curvature_screen": screen,
        "candidate_variables": findings.candidate_variables(train, schema, correlations, screen, flagged, plan.wording),
        "modelling_challenges": findings.modelling_challenges(known, plan.challenges),
        "notes": findings.notes(known, plan.notes),
        "feature_plan": planned,
        "feature_repository": governance.feature_repository(planned),
        "feature_dependencies": governance.feature_dependencies(planned, train),
    }
    return Exploration(status, tables, clean, splits, prepared, preparation, tuple(shared))


def run(raw: DataFrame, plan: RunPlan, output: str | None = None) -> RunResult:
    """Run every stage on ``raw``; with ``output`` the results are written below it."""
    return _run(raw, plan, output)[0]


def _run(raw: DataFrame, plan: RunPlan, output: str | None) -> tuple[RunResult, list[str]]:
    """The run, and the names of the tables it wrote."""
    target, key = plan.schema.target, plan.row_key
    explored = explore(raw, plan, output)
    layout, prepared = explored.preparation.layout, explored.prepared
    part = {name: prepared.where(F.col("split") == name) for name in (split.TRAIN, split.VALIDATION, split.TEST)}

    fitted = models.train_models(part[split.TRAIN], layout, target, plan.settings)
    comparison = models.model_comparison(fitted, part[split.VALIDATION], layout, target)
    rows = comparison.collect()
    comparison = raw.sparkSession.createDataFrame(rows, comparison.schema)
    chosen = models.best_model(comparison)
    best = chosen.first()["Model"]
    model_path = f"{output}/model" if output else ""
    result = RunResult(
        explored,
        fitted,
        comparison,
        best,
        models.test_metrics(fitted[best], part[split.TEST], layout, target),
        models.predictions(fitted[best], part[split.TEST], layout, key, target),
        models.residuals(fitted[best], part[split.VALIDATION], layout, key, target),
        models.feature_importance(fitted[models.FOREST], layout, prepared),
        registry_snapshot(
            explored.clean, list(plan.selected), comparison, chosen, plan.project, target, plan.source, model_path
        ),
    )
    return result, save(result, plan, output) if output else []


def save_explored(explored: Exploration, output: str) -> list[str]:
    """Write the result tables of the stages before training; the names of all tables there."""
    for name, table in explored.tables.items():
        if name not in explored.written:
            write_table(table, f"{output}/{name}")
    return [*explored.tables, "splits", "prepared"]


def save(result: RunResult, plan: RunPlan, output: str) -> list[str]:
    """Write the result tables, the chosen model and the snapshot of a run; the names of all tables there."""
    names = save_explored(result.explored, output)
    write_table(result.comparison, f"{output}/model_comparison")
    write_table(result.test, f"{output}/test_metrics")
    write_table(result.predictions, f"{output}/predictions", row_key=[plan.row_key])
    write_table(result.residuals, f"{output}/residuals", row_key=[plan.row_key])
    write_table(result.importance, f"{output}/feature_importance")
    models.save_model(result.fitted[result.best], f"{output}/model")
    write_snapshot(result.snapshot, f"{output}/registry")
    return [*names, "model_comparison", "test_metrics", "predictions", "residuals", "feature_importance"]


@dataclass
class KeptRun:
    """The written results of a run; ``made`` tells whether this call made them."""

    place: str
    made: bool
    tables: dict[str, DataFrame]

    def model(self) -> PipelineModel:
        return models.load_model(f"{self.place}/model")


def run_address(content: Row, plan: RunPlan, train: bool = True) -> str:
    """Where the results of a table and a plan are kept: both, and the version of the results, decide."""
    parts = [RESULTS_VERSION, content["fingerprint"], content["row_total"], train, asdict(plan)]
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def run_kept(
    spark: SparkSession,
    path: str,
    plan: RunPlan,
    store: str,
    train: bool = True,
    read: Callable[[SparkSession, str], DataFrame] = read_parquet,
) -> KeptRun:
    """The results for the Parquet table at ``path``, reread where they were made before.

    Results lie in ``store`` under an address of content and plan. The content is known by the fingerprint of
    the table, for which only files not seen before are read; an unchanged table with an unchanged plan is not
    scanned at all. The list of results is written last, so a run that broke off counts for nothing
    and is made again. Results of other addresses that this store holds are deleted afterwards.
    Without ``train`` the run ends before the models.
    """
    content = table_fingerprint(spark, path, f"{store}/manifest").first()
    place = f"{store}/{run_address(content, plan, train)}"
    names, made = _finished(spark, place), False
    if names is None:
        made = True
        note = spark.createDataFrame([(place,)], "place string")
        note.write.mode("append").parquet(f"{store}/places")
        raw = read(spark, path)
        names = _run(raw, plan, place)[1] if train else save_explored(explore(raw, plan, place), place)
        listed = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "number int, name string")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{place}/finished")
    # One row per run ever made here.
    for old in spark.read.schema("place string").parquet(f"{store}/places").distinct().collect():
        if old["place"] != place:
            remove(spark, old["place"])
    return KeptRun(place, made, {name: spark.read.parquet(f"{place}/{name}") for name in names})


def _finished(spark: SparkSession, place: str) -> list[str] | None:
    """The tables of a run that came to its end, None if there is no such run."""
    try:
        listed = spark.read.schema("number int, name string").parquet(f"{place}/finished").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return [row["name"] for row in sorted(listed)]
