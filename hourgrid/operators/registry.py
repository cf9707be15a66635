"""Model registry rows and the latest approved entry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.clock import moment

# Approval states and property names of a registry entry.
PENDING = "PendingManualApproval"
APPROVED = "Approved"
REJECTED = "Rejected"
METRICS = ("mae", "rmse", "mape")


def _literal_map(entries: Mapping[str, str]) -> Column:
    flat = [F.lit(part) for item in entries.items() for part in item]
    return F.create_map(*flat)


def registry_rows(
    metrics: DataFrame,
    *,
    group: str,
    run_id: str,
    created_at: datetime | str,
    commit: str = "N/A",
    feature_source: str = "N/A",
    start: str = "N/A",
    end: str = "N/A",
    split: str = "N/A",
    hyperparameters: Mapping[str, str] | None = None,
    model_path: str | None = None,
) -> DataFrame:
    """One pending entry per building from its row of metrics.

    All properties come from the metrics row and from constants of the run, so
    the entries are a projection: no shuffle and nothing collected.
    """
    status = F.when(F.col("n") > 0, "Success").otherwise("Error")
    lineage = {
        "GitCommit": commit,
        "FeatureSourcePath": feature_source,
        "TrainingStartDate": start,
        "TrainingEndDate": end,
        "EvaluationSplitDate": split,
    }
    parameters = {
        f"Hyperparameter_{name}": str(value)
        for name, value in (hyperparameters or {}).items()
    }
    scores = F.create_map(
        *[
            part
            for name in METRICS
            for part in (
                F.lit(f"Evaluation_{name}"),
                F.when(F.col(name).isNull(), "None").otherwise(
                    F.format_string("%.6f", F.col(name))
                ),
            )
        ],
        F.lit("EvaluationStatus"),
        status,
    )
    summary = (
        f"Training days {start} .. {end}; commit {commit}; "
        f"features from {feature_source}; evaluation: "
    )
    return metrics.select(
        F.concat_ws("/", F.lit(group), F.lit(run_id), F.col("building_id")).alias(
            "model_package_id"
        ),
        F.lit(group).alias("model_package_group"),
        "building_id",
        F.concat(F.lit(summary), status).alias("description"),
        F.lit(PENDING).alias("approval_status"),
        F.lit(commit).alias("commit_id"),
        F.lit(model_path).cast("string").alias("model_path"),
        moment(created_at).alias("created_at"),
        F.map_concat(_literal_map({**lineage, **parameters}), scores).alias(
            "properties"
        ),
    )


def latest_per_group(
    registry: DataFrame,
    group: str | Sequence[str] = "model_package_group",
    created: str = "created_at",
    entry_id: str = "model_package_id",
    where: Column | None = None,
) -> DataFrame:
    """The newest entry of each group (ties: highest id).

    A ``max_by`` aggregate keeps one entry per task before the shuffle, so one group
    holding most of the entries is no problem. Each task sorts its entries for that;
    a ranking window would sort all of a group's on one task.
    """
    keys = [group] if isinstance(group, str) else list(group)
    entries = registry if where is None else registry.where(where)
    newest = F.max_by(
        F.struct(*[F.col(c) for c in registry.columns]), F.struct(created, entry_id)
    )
    return entries.groupBy(*keys).agg(newest.alias("_entry")).select("_entry.*")


def with_status(entries: DataFrame, status: str, where: Column) -> DataFrame:
    """The entries that ``where`` is true of, in another state of approval."""
    return entries.where(where).withColumn("approval_status", F.lit(status))


def latest_approved(registry: DataFrame) -> DataFrame:
    return latest_per_group(registry, where=F.col("approval_status") == APPROVED)


def require_latest_approved(registry: DataFrame, group: str):
    """The approved entry to use for inference; an error when there is none."""
    in_group = registry.where(F.col("model_package_group") == group)
    entry = latest_approved(in_group).first()
    if entry is None:
        raise ValueError(f"Group {group} holds no approved entry")
    return entry


def approved_model_path(registry: DataFrame, group: str) -> str:
    """Where the model of the group's latest approved entry is stored."""
    entry = require_latest_approved(registry, group)
    if entry.model_path is None:
        raise ValueError(f"Entry {entry.model_package_id} names no stored model")
    return entry.model_path
