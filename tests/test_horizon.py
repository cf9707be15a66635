from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from frames import (
    FORECAST_START,
    history_panel,
    humidity,
    temperature,
    training_panel,
    weather_forecast,
    weekend_calendar,
)
from pyspark.sql import functions as F

from hourgrid.config import INFERENCE_COLUMNS, TREE_FEATURES, FeatureSpec
from hourgrid.operators import features, horizon
from hourgrid.operators.rollup import calendar_daily

START = "2025-08-11"


def _features(spark, hours=72, **options):
    return horizon.inference_features(
        horizon.lookback(history_panel(spark), START, 7),
        horizon.hourly_weather_forecast(weather_forecast(spark), START, hours),
        calendar_daily(weekend_calendar(spark)),
        START,
        hours,
        **options,
    )


def _by_hour(frame):
    return {r.timestamp_hour: r for r in frame.collect()}


def test_one_row_per_building_and_hour(spark):
    result = _features(spark)
    assert tuple(result.columns) == INFERENCE_COLUMNS
    rows = _by_hour(result)
    first = datetime(2025, 8, 11)
    assert sorted(rows) == [first + timedelta(hours=h) for h in range(72)]


def test_first_hour_sees_history_forecast_and_calendar(spark):
    row = _by_hour(_features(spark))[datetime(2025, 8, 11)]
    yesterday = _by_hour(history_panel(spark))[datetime(2025, 8, 10)]
    assert row.consumption_lag_24h == pytest.approx(yesterday.consumption_kwh)
    assert row.temperature_c == pytest.approx(temperature(FORECAST_START) + 1)
    assert row.humidity == pytest.approx(humidity(FORECAST_START) - 2)
    assert (row.is_holiday_flag, row.day_of_week, row.hour_of_day) == (0, 2, 0)


def test_lags_beyond_their_length_are_filled_or_kept_null(spark):
    late = datetime(2025, 8, 13, 5)
    assert _by_hour(_features(spark))[late].consumption_lag_24h == 0.0
    assert _by_hour(_features(spark, keep_null=True))[late].consumption_lag_24h is None


def test_weekly_lag_covers_the_whole_horizon(spark):
    rows = _features(spark, columns=["building_id", "timestamp_hour", "consumption_lag_168h"])
    history = _by_hour(history_panel(spark))
    for hour, row in _by_hour(rows).items():
        week_ago = history[hour - timedelta(days=7)]
        assert row.consumption_lag_168h == pytest.approx(week_ago.consumption_kwh)


def test_horizon_ending_inside_a_day(spark):
    weather = horizon.hourly_weather_forecast(weather_forecast(spark), START, 30)
    assert weather.count() == 48  # whole days are read
    assert _features(spark, hours=30).count() == 30


def test_training_and_inference_compute_the_same_features(spark):
    """Features of a known day, reached through both paths."""
    panel = training_panel(spark)
    day = "2025-08-09"
    columns = ["building_id", "timestamp_hour", *TREE_FEATURES]
    spec = FeatureSpec()
    trained = features.training_features(
        panel, "2025-08-01", day, day, spec, columns
    ).where(F.col("split") == "eval")
    known = panel.select(
        "building_id", "timestamp_hour", "temperature_c", "solar_irradiance_ghi", "humidity"
    ).where(F.to_date("timestamp_hour") == F.lit(day).cast("date"))
    served = horizon.inference_features(
        horizon.lookback(panel, day, 8),
        known,
        calendar_daily(weekend_calendar(spark)),
        day,
        24,
        spec,
        columns,
    )
    # The target of the day itself is unknown when serving; only its own rolling
    # mean may differ.
    shared = [c for c in columns if "_roll_" not in c]
    rows = [
        sorted(map(tuple, frame.select(*shared).collect())) for frame in (trained, served)
    ]
    assert len(rows[0]) == 48
    for one, other in zip(*rows):
        assert list(one[2:]) == [pytest.approx(v) for v in other[2:]]


def test_building_without_forecast_weather_still_gets_rows(spark):
    history = horizon.lookback(training_panel(spark), START, 14)
    result = horizon.inference_features(
        history,
        horizon.hourly_weather_forecast(weather_forecast(spark), START, 24),
        calendar_daily(weekend_calendar(spark)),
        START,
        24,
    )
    b2 = result.where("building_id = 'B2'").collect()
    assert len(b2) == 24
    assert {r.temperature_c for r in b2} == {0.0}
