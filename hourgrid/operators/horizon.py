"""The future side: horizon hours, forecast weather, and lags across the seam."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.config import INFERENCE_COLUMNS, FeatureSpec
from hourgrid.functions.clock import as_datetime, moment, parse_timestamp
from hourgrid.operators.features import feature_table
from hourgrid.operators.panel import panel_range, with_holiday_flag
from hourgrid.operators.rollup import building_ids

FRAME_COLUMNS = (
    "building_id",
    "timestamp_hour",
    "consumption_kwh",
    "temperature_c",
    "solar_irradiance_ghi",
    "humidity",
    "is_holiday_flag",
)


def lookback_range(start: str, lookback_days: int) -> tuple[date, date]:
    """First and last of the days before ``start`` that feed the lags."""
    first = as_datetime(start).date()
    return first - timedelta(days=lookback_days), first - timedelta(days=1)


def lookback(panel: DataFrame, start: str, lookback_days: int) -> DataFrame:
    return panel_range(panel, *lookback_range(start, lookback_days))


def hourly_weather_forecast(
    raw: DataFrame, start: str, horizon_hours: int
) -> DataFrame:
    """Forecast weather of the days the horizon touches, under the panel's names.

    Hourly averages per building, so a repeated forecast row gives no second hour.
    """
    first = as_datetime(start)
    last_day = (first + timedelta(hours=horizon_hours - 1)).date()
    hour = F.date_trunc("hour", parse_timestamp("timestamp_hour_str")).cast("timestamp_ntz")
    rows = raw.select(
        "building_id",
        hour.alias("timestamp_hour"),
        F.col("temp_fcst").alias("temperature_c"),
        F.col("ghi_fcst").alias("solar_irradiance_ghi"),
        F.col("humidity_fcst").alias("humidity"),
    ).where(
        (F.col("timestamp_hour") >= moment(first))
        & (F.col("timestamp_hour") < moment(as_datetime(last_day) + timedelta(days=1)))
    )
    values = ("temperature_c", "solar_irradiance_ghi", "humidity")
    return rows.groupBy("building_id", "timestamp_hour").agg(
        *(F.avg(name).alias(name) for name in values)
    )


def future_frame(history: DataFrame, start: str, horizon_hours: int) -> DataFrame:
    """One row per known building and horizon hour, generated where the ids live."""
    first = as_datetime(start)
    hours = F.sequence(
        moment(first),
        moment(first + timedelta(hours=horizon_hours - 1)),
        F.expr("INTERVAL '1' HOUR"),
    )
    return building_ids(history).select(
        "building_id", F.explode(hours).alias("timestamp_hour")
    )


def inference_frame(
    history: DataFrame,
    weather: DataFrame,
    calendar: DataFrame,
    start: str,
    horizon_hours: int,
) -> DataFrame:
    """History plus the horizon, whose target is NULL.

    ``weather`` comes from ``hourly_weather_forecast``, ``calendar`` from
    ``calendar_daily``.
    """
    future = future_frame(history, start, horizon_hours).join(
        weather, ["building_id", "timestamp_hour"], "left"
    )
    future = with_holiday_flag(future, calendar).withColumn(
        "consumption_kwh", F.lit(None).cast("double")
    )
    return history.select(*FRAME_COLUMNS).unionByName(future.select(*FRAME_COLUMNS))


def inference_features(
    history: DataFrame,
    weather: DataFrame,
    calendar: DataFrame,
    start: str,
    horizon_hours: int,
    spec: FeatureSpec | None = None,
    columns: Sequence[str] = INFERENCE_COLUMNS,
    keep_null: bool = False,
) -> DataFrame:
    """Horizon rows with the features a model expects.

    A lag shorter than the horizon has no value beyond its own length, because the
    target is unknown there. Such gaps become ``spec.imputation_value``, or stay
    NULL with ``keep_null``.
    """
    spec = spec or FeatureSpec()
    frame = inference_frame(history, weather, calendar, start, horizon_hours)
    features = (
        feature_table(frame, spec, columns)
        .where(F.col(spec.time) >= moment(start))
        .dropna(subset=[spec.key, spec.time])
    )
    return features if keep_null else features.fillna(spec.imputation_value)
