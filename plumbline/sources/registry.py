"""Registry snapshot: one nested row that records data, features and models of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.sources.fingerprint import dataset_fingerprint

REGISTRY_VERSION = "2.0"


def registry_snapshot(
    data: DataFrame,
    features: Sequence[str],
    comparison: DataFrame,
    best: DataFrame,
    project: str,
    target: str,
    source: str,
    model_path: str = "",
) -> DataFrame:
    """Nested single row from four small results; only the fingerprint scans the data."""
    registered = dataset_fingerprint(data).select(
        F.struct(
            F.lit(source).alias("source"),
            "fingerprint",
            F.col("row_total").alias("rows"),
            F.col("column_total").alias("total_columns"),
        ).alias("data_registry")
    )
    record = F.struct(*[F.col(c) for c in comparison.columns])
    ordered = comparison.agg(F.sort_array(F.collect_list(F.struct("Val_RMSE", record.alias("r")))).alias("all"))
    compared = ordered.select(F.transform("all", lambda item: item["r"]))
    names = F.array(*[F.lit(n) for n in features]) if features else F.array().cast("array<string>")
    # The models of one run: a handful of rows.
    return (
        registered.withColumn("comparison_results", compared.scalar())
        .withColumn("best_model", best.select("Model").limit(1).scalar())
        .select(
            F.lit(REGISTRY_VERSION).alias("registry_version"),
            F.current_timestamp().alias("generated_at"),
            F.struct(
                F.lit(project).alias("name"),
                F.lit("Regression").alias("problem_type"),
                F.lit(target).alias("target"),
            ).alias("project"),
            "data_registry",
            F.struct(names.alias("selected_features"), F.lit(len(features)).alias("feature_count")).alias(
                "feature_store"
            ),
            F.struct(
                "best_model",
                F.lit(model_path).alias("path"),
                F.col("best_model").isNotNull().alias("available"),
                "comparison_results",
            ).alias("model_registry"),
        )
    )


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    snapshot.write.mode("overwrite").json(path)
