"""Forecast error metrics, the evaluation report and the quality gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.config import QualityThresholds
from hourgrid.functions.numeric import or_zero

# Fixed value: smallest denominator of the percentage error (double epsilon).
EPSILON = 2.220446049250313e-16


def match_actuals(
    actuals: DataFrame, predictions: DataFrame, target: str = "consumption_kwh"
) -> DataFrame:
    """Only hours with both an actual and a prediction are scored."""
    key = ["building_id", "timestamp_hour"]
    return actuals.select(*key, target).join(
        predictions.select(*key, "yhat"), key, "inner"
    )


def _metric_columns(actual: str, predicted: str) -> list[Column]:
    y, p = or_zero(actual), or_zero(predicted)
    error = F.abs(y - p)
    share = F.when(y != 0.0, error / F.greatest(F.abs(y), F.lit(EPSILON)))
    rows = F.count(F.lit(1))
    no_share = F.when(rows > 0, F.lit(float("inf")))
    return [
        F.avg(error).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.coalesce(F.avg(share) * 100.0, no_share).alias("mape"),
        rows.alias("n"),
    ]


def forecast_metrics(
    scored: DataFrame,
    actual: str = "consumption_kwh",
    predicted: str = "yhat",
    by: Sequence[str] = (),
) -> DataFrame:
    """MAE, RMSE, MAPE (percent) and row count, overall or per group.

    Missing values count as 0. MAPE skips zero actuals and is infinite when none
    is left; without any row all three are NULL and ``n`` is 0.
    """
    return scored.groupBy(*by).agg(*_metric_columns(actual, predicted))


def evaluation_report(metrics: DataFrame) -> DataFrame:
    """The one-row report for one row of ``forecast_metrics``."""
    empty = F.col("n") == 0
    return metrics.select(
        F.struct("mae", "rmse", "mape").alias("metrics"),
        F.col("n").alias("num_eval_records"),
        F.when(empty, "Error").otherwise("Success").alias("status"),
        F.when(empty, "No matching actuals and predictions").alias("error_message"),
    )


def quality_gate(
    metrics: DataFrame, thresholds: QualityThresholds | None = None
) -> DataFrame:
    """Adds ``passed``; a missing or infinite metric fails."""
    limits = thresholds or QualityThresholds()
    within = (F.col("mape") <= limits.max_mape) & (F.col("rmse") <= limits.max_rmse)
    return metrics.withColumn("passed", F.coalesce(within, F.lit(False)))
