"""The user's entry points: ingest, train, evaluate, forecast, publish.

Each takes paths, composes lazy operators and ends in a writer. The only other
actions are the guards on the inputs of inference.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid import schemas
from hourgrid.config import (
    HORIZON_HOURS,
    INFERENCE_COLUMNS,
    LOOKBACK_DAYS,
    TRAINING_COLUMNS,
    BoostedTreeParams,
    FeatureSpec,
    QualityThresholds,
    TrendSeasonalParams,
)
from hourgrid.models.store import (
    Forecaster,
    fit_forecaster,
    load_forecaster,
    model_type_of,
)
from hourgrid.operators import contributions as contribution_ops
from hourgrid.operators import features as feature_ops
from hourgrid.operators import horizon, metrics, publish, registry
from hourgrid.operators.panel import build_panel
from hourgrid.operators.rollup import calendar_daily
from hourgrid.session import scratch_path
from hourgrid.sources import readers, writers

logger = logging.getLogger(__name__)


# --- Ingest -------------------------------------------------------------------


def process_panel(
    spark: SparkSession,
    consumption_path: str,
    solar_path: str,
    weather_path: str,
    calendar_path: str,
    start: str,
    end: str,
) -> DataFrame:
    return build_panel(
        readers.read_consumption(spark, consumption_path, start, end),
        readers.read_solar(spark, solar_path, start, end),
        readers.read_weather(spark, weather_path, start, end),
        readers.read_calendar(spark, calendar_path),
    )


def ingest_feeds(
    consumption: DataFrame,
    solar: DataFrame,
    weather: DataFrame,
    calendar: DataFrame,
    start: str,
    end: str,
    destination: str,
    table: str | None = None,
) -> int:
    """Replace what the source days ``start`` to ``end`` contribute to the stored panel.

    The feeds hold records of these source days, which may be late: of hours on other
    days. Every hour day that a record concerns, or did before, is merged again from the
    contributions of all source days, so daily runs in any order, repeated or not, give the
    panel of one run over everything. Returns the rows of the merged days.
    """
    rows, _ = _ingest([consumption, solar, weather], calendar, (start, end), destination, table)
    return rows


def _ingest(
    feeds: Sequence[DataFrame],
    calendar: DataFrame,
    days: tuple[str, str],
    destination: str,
    table: str | None,
) -> tuple[int, int]:
    """The rows of the merged days, and the number of lines that are no records."""
    made = contribution_ops.contributions(*feeds)
    spark = made.sparkSession
    staged = scratch_path(spark, "contributions")
    made.write.parquet(staged)
    kept = spark.read.schema(made.schema).parquet(staged)
    bad = kept.agg(F.sum("rejected")).first()[0] or 0
    writers.write_contributions(kept.where(F.col("source_day").isNotNull()), destination, days)
    dates = calendar_daily(calendar)
    rows = writers.merge_pending(
        spark, destination, lambda parts: contribution_ops.merged_panel(parts, dates), table
    )
    return rows, bad


def run_ingest(
    spark: SparkSession,
    consumption_path: str,
    solar_path: str,
    weather_path: str,
    calendar_path: str,
    start: str,
    end: str,
    destination: str,
    table: str | None = None,
) -> int:
    """Ingest the JSON feeds of some source days (``ingest_feeds``), with their rejects.

    Lines that are no records are counted while the records are read; only if there are
    any is a second pass made, which sets them aside by source day.
    """
    days = (start, end)
    day = F.col("date_partition_col")
    feeds = {
        name: readers.read_feed(spark, path, schema).where(day.between(*days) | day.isNull())
        for name, path, schema in (
            ("consumption", consumption_path, schemas.RAW_CONSUMPTION),
            ("solar", solar_path, schemas.RAW_SOLAR),
            ("weather", weather_path, schemas.RAW_WEATHER),
        )
    }
    calendar = readers.read_calendar(spark, calendar_path)
    rows, bad = _ingest(list(feeds.values()), calendar, days, destination, table)
    lines = reduce(DataFrame.unionByName, (readers.rejected(f, name) for name, f in feeds.items()))
    if bad:
        logger.warning("%d lines are no records", bad)
    writers.write_rejects(lines if bad else lines.limit(0), destination, days)
    if rows == 0:
        logger.warning("No panel rows for %s to %s", start, end)
    return rows


# --- Training -----------------------------------------------------------------


def calculate_features(
    spark: SparkSession,
    panel_path: str,
    start: str,
    end: str,
    split: str,
    spec: FeatureSpec | None = None,
    columns: Sequence[str] = TRAINING_COLUMNS,
) -> tuple[DataFrame, DataFrame] | tuple[None, None]:
    """Train and evaluation features, or (None, None) without panel rows."""
    panel = readers.read_panel(spark, panel_path, start, end)
    if panel.isEmpty():
        logger.error("No panel rows for %s to %s", start, end)
        return None, None
    labelled = feature_ops.training_features(panel, start, end, split, spec, columns)
    return feature_ops.train_eval_split(labelled)


def run_feature_engineering(
    spark: SparkSession,
    panel_path: str,
    start: str,
    end: str,
    split: str,
    output_path: str,
    spec: FeatureSpec | None = None,
    columns: Sequence[str] = TRAINING_COLUMNS,
) -> int:
    """Write both feature sets below ``output_path`` in one job."""
    panel = readers.read_panel(spark, panel_path, start, end)
    labelled = feature_ops.training_features(panel, start, end, split, spec, columns)
    return writers.write_feature_sets(labelled, output_path)


def model_version(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/run={run_id}"


def run_training(
    spark: SparkSession,
    strategy: str,
    train_path: str,
    model_path: str,
    feature_columns: Sequence[str] = (),
    hyperparameters: Mapping[str, Any] | None = None,
    target: str = "consumption_kwh",
    spec: FeatureSpec | None = None,
) -> Forecaster:
    """Fit, store and reload a model; ``spec`` says how its features were made.

    Give every run a ``model_path`` of its own (``model_version``), so a registered model
    is never overwritten by a later one.
    """
    train = readers.read_features(spark, train_path)
    if train.isEmpty():
        raise ValueError("There are no rows to train on")
    fitted = fit_forecaster(strategy, train, feature_columns, hyperparameters, target, spec)
    fitted.save(spark, model_path)
    # The stored model: what a fresh fit computes lazily is only read from here on.
    return load_forecaster(spark, model_path)


# --- Evaluation ---------------------------------------------------------------


def score_evaluation(model: Forecaster, evaluation: DataFrame) -> DataFrame:
    """Actual and predicted value per evaluated hour.

    The evaluation rows already hold the actual, so it rides along with the scoring
    instead of being joined back; ``metrics.match_actuals`` is for forecasts that
    come from elsewhere.
    """
    return model.forecast(evaluation, keep=[model.target_column])


def run_evaluation(
    spark: SparkSession, model_path: str, eval_path: str, report_path: str
) -> DataFrame:
    """Write the evaluation report and return it as stored."""
    model = load_forecaster(spark, model_path)
    scored = score_evaluation(model, readers.read_features(spark, eval_path))
    result = metrics.forecast_metrics(scored, model.target_column)
    writers.write_evaluation_report(metrics.evaluation_report(result), report_path)
    return readers.read_evaluation_report(spark, report_path)


@dataclass(frozen=True)
class RunDetails:
    """What a registry entry records about the run that produced a model."""

    group: str
    run_id: str
    created_at: datetime
    commit: str = "N/A"
    feature_source: str = "N/A"
    start: str = "N/A"
    end: str = "N/A"
    split: str = "N/A"


def run_registration(
    spark: SparkSession,
    model_path: str,
    eval_path: str,
    registry_path: str,
    run: RunDetails,
    hyperparameters: Mapping[str, Any] | None = None,
    thresholds: QualityThresholds | None = None,
) -> int:
    """Append one pending entry for every building that passes the gate."""
    model = load_forecaster(spark, model_path)
    settings = hyperparameters or {}
    params: TrendSeasonalParams | BoostedTreeParams
    if model_type_of(model.model_type) == "boosted_trees":
        params = BoostedTreeParams.from_mapping(settings)
    else:
        params = TrendSeasonalParams.from_mapping(settings)
    scored = score_evaluation(model, readers.read_features(spark, eval_path))
    by_building = metrics.forecast_metrics(
        scored, model.target_column, by=["building_id"]
    )
    passed = metrics.quality_gate(by_building, thresholds).where("passed")
    entries = registry.registry_rows(
        passed,
        group=run.group,
        run_id=run.run_id,
        created_at=run.created_at,
        commit=run.commit,
        feature_source=run.feature_source,
        start=run.start,
        end=run.end,
        split=run.split,
        hyperparameters=params.as_strings(),
        model_path=model_path,
    )
    return writers.append_registry(entries, registry_path)


def run_approval(
    spark: SparkSession, registry_path: str, group: str, run_id: str, status: str = registry.APPROVED
) -> int:
    """Set the state of all entries of a run in a group; returns how many it has."""
    own = F.startswith("model_package_id", F.lit(f"{group}/{run_id}/"))
    return writers.set_approval(
        spark, registry_path, status, (F.col("model_package_group") == group) & own
    )


# --- Inference and publishing -------------------------------------------------


def calculate_inference_features(
    spark: SparkSession,
    panel_path: str,
    weather_forecast_path: str,
    calendar_path: str,
    start: str,
    horizon_hours: int = HORIZON_HOURS,
    lookback_days: int = LOOKBACK_DAYS,
    spec: FeatureSpec | None = None,
    columns: Sequence[str] = INFERENCE_COLUMNS,
    keep_null: bool = False,
) -> DataFrame | None:
    """Horizon features, or None without history or without forecast weather."""
    days = horizon.lookback_range(start, lookback_days)
    history = readers.read_panel(spark, panel_path, *days)
    if history.isEmpty():
        logger.error("No panel rows in the %d days before %s", lookback_days, start)
        return None
    raw_weather = readers.read_weather_forecast(spark, weather_forecast_path)
    weather = horizon.hourly_weather_forecast(raw_weather, start, horizon_hours)
    if weather.isEmpty():
        logger.error("No weather forecast from %s on", start)
        return None
    return horizon.inference_features(
        history,
        weather,
        calendar_daily(readers.read_calendar(spark, calendar_path)),
        start,
        horizon_hours,
        spec,
        columns,
        keep_null,
    )


def run_inference_features(
    spark: SparkSession,
    panel_path: str,
    weather_forecast_path: str,
    calendar_path: str,
    start: str,
    output_path: str,
    horizon_hours: int = HORIZON_HOURS,
    lookback_days: int = LOOKBACK_DAYS,
    columns: Sequence[str] = INFERENCE_COLUMNS,
    spec: FeatureSpec | None = None,
) -> bool:
    """Write the horizon features; False (and nothing written) without inputs."""
    features = calculate_inference_features(
        spark,
        panel_path,
        weather_forecast_path,
        calendar_path,
        start,
        horizon_hours,
        lookback_days,
        spec,
        columns,
    )
    if features is None:
        return False
    writers.write_features(features, output_path)
    return True


def run_forecast(
    spark: SparkSession, model_path: str, features_path: str, output_path: str
) -> None:
    model = load_forecaster(spark, model_path)
    features = readers.read_features(spark, features_path)
    writers.write_forecasts(model.forecast(features), output_path)


def run_publish(
    spark: SparkSession, forecasts_path: str, output_path: str, target: str = "PARQUET"
) -> int:
    """Unpivot the forecast files into the measure table; returns rows written."""
    if target != "PARQUET":
        raise ValueError(f"Unsupported publish target: {target}")
    forecasts = readers.read_forecasts(spark, forecasts_path)
    return writers.write_measures(publish.forecast_long(forecasts), output_path)


def run_inference(
    spark: SparkSession,
    model_path: str,
    panel_path: str,
    weather_forecast_path: str,
    calendar_path: str,
    start: str,
    work_path: str,
    measures_path: str,
    horizon_hours: int = HORIZON_HOURS,
    lookback_days: int = LOOKBACK_DAYS,
    columns: Sequence[str] | None = None,
    spec: FeatureSpec | None = None,
) -> int:
    """Features, forecast and publication in one application.

    Columns and spec are by default those that the stored model was trained with.
    """
    model = load_forecaster(spark, model_path)
    columns, spec = columns or model.serving_columns, spec or model.spec
    features_path, forecasts_path = f"{work_path}/features", f"{work_path}/forecasts"
    written = run_inference_features(
        spark,
        panel_path,
        weather_forecast_path,
        calendar_path,
        start,
        features_path,
        horizon_hours,
        lookback_days,
        columns,
        spec,
    )
    if not written:
        return 0
    run_forecast(spark, model_path, features_path, forecasts_path)
    return run_publish(spark, forecasts_path, measures_path)


def run_group_inference(
    spark: SparkSession,
    registry_path: str,
    group: str,
    panel_path: str,
    weather_forecast_path: str,
    calendar_path: str,
    start: str,
    work_path: str,
    measures_path: str,
    horizon_hours: int = HORIZON_HOURS,
    lookback_days: int = LOOKBACK_DAYS,
) -> int:
    """Inference with the model of the group's latest approved registry entry."""
    entries = spark.read.schema(schemas.REGISTRY).parquet(registry_path)
    return run_inference(
        spark,
        registry.approved_model_path(entries, group),
        panel_path,
        weather_forecast_path,
        calendar_path,
        start,
        work_path,
        measures_path,
        horizon_hours,
        lookback_days,
    )
