from __future__ import annotations

from datetime import datetime

import pytest
from frames import temperature, training_panel
from pyspark.sql import functions as F

from hourgrid.config import TRAINING_COLUMNS, FeatureSpec, Rolling
from hourgrid.operators import features

RANGE = ("2025-08-01", "2025-08-10")


def _at(frame, building, moment):
    stamp = F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return frame.where((F.col("building_id") == building) & (F.col("timestamp_hour") == stamp))


def test_columns_counts_and_split(spark):
    labelled = features.training_features(training_panel(spark), *RANGE, "2025-08-08")
    train, evaluation = features.train_eval_split(labelled)
    assert tuple(train.columns) == tuple(evaluation.columns) == TRAINING_COLUMNS
    sizes = {r.split: r.n for r in features.split_sizes(labelled).collect()}
    assert sizes == {"train": 288, "eval": 144}
    bounds = {r.split: r for r in features.split_bounds(labelled).collect()}
    assert bounds["train"].last_hour == datetime(2025, 8, 7, 23)
    assert bounds["eval"].first_hour == datetime(2025, 8, 8)
    assert train.intersect(evaluation).isEmpty()


def test_lags_come_from_the_same_hour_a_day_earlier(spark):
    panel = training_panel(spark)
    labelled = features.training_features(panel, *RANGE, "2025-08-08")
    later = _at(labelled, "B1", datetime(2025, 8, 2)).first()
    earlier = _at(panel, "B1", datetime(2025, 8, 1)).first()
    assert later.consumption_lag_24h == pytest.approx(earlier.consumption_kwh)
    assert later.temp_lag_24h == pytest.approx(earlier.temperature_c)


def test_evaluation_lags_may_use_training_hours(spark):
    panel = training_panel(spark)
    labelled = features.training_features(panel, *RANGE, "2025-08-08")
    first_eval = _at(labelled, "B2", datetime(2025, 8, 8)).first()
    assert first_eval.split == "eval"
    last_week = _at(panel, "B2", datetime(2025, 8, 7)).first()
    assert first_eval.consumption_lag_24h == pytest.approx(last_week.consumption_kwh)


def test_rolling_values(spark):
    panel = training_panel(spark)
    labelled = features.training_features(panel, "2025-08-01", "2025-08-02", "2025-08-03")
    row = _at(labelled, "B1", datetime(2025, 8, 2, 1)).first()
    stamp = [datetime(2025, 8, 1, 2), datetime(2025, 8, 2, 1)]
    day = panel.where(
        (F.col("building_id") == "B1")
        & (F.col("timestamp_hour") >= F.lit(str(stamp[0])).cast("timestamp_ntz"))
        & (F.col("timestamp_hour") <= F.lit(str(stamp[1])).cast("timestamp_ntz"))
    ).agg(F.avg("consumption_kwh").alias("m"), F.stddev("consumption_kwh").alias("s"), F.count("*"))
    mean, spread, n = day.first()
    assert n == 24
    assert row.consumption_roll_avg_24h == pytest.approx(mean)
    assert row.consumption_roll_std_24h == pytest.approx(spread)


def test_end_date_is_inclusive(spark):
    labelled = features.training_features(
        training_panel(spark), "2025-08-01", "2025-08-02", "2025-08-05"
    )
    assert labelled.agg(F.max("timestamp_hour")).first()[0] == datetime(2025, 8, 2, 23)


def test_nan_rows_are_incomplete(spark):
    panel = training_panel(spark).withColumn(
        "humidity",
        F.when(F.hour("timestamp_hour") == 5, F.lit(float("nan"))).otherwise(F.col("humidity")),
    )
    labelled = features.training_features(panel, *RANGE, "2025-08-08")
    assert labelled.where(F.hour("timestamp_hour") == 5).isEmpty()


def test_calendar_parts(spark):
    spec = FeatureSpec()
    parts = features.feature_table(
        training_panel(spark), spec, ["building_id", "timestamp_hour", *spec.time_features]
    )
    row = _at(parts, "B1", datetime(2025, 8, 3, 7)).first()  # a Sunday
    assert row[2:] == (7, 1, 3, 8, 1)


def test_interaction_brings_its_own_inputs(spark):
    row = _at(
        features.feature_table(
            training_panel(spark),
            FeatureSpec(),
            ["building_id", "timestamp_hour", "temp_x_hour"],
        ),
        "B1",
        datetime(2025, 8, 1, 14),
    ).first()
    assert row.temp_x_hour == pytest.approx(temperature(datetime(2025, 8, 1, 14)) * 14)


def test_spec_from_mapping():
    spec = FeatureSpec.from_mapping(
        {
            "target_column": "kwh",
            "time_features": ["hour_of_day"],
            "lag_features": {"kwh": [24]},
            "rolling_window_features": {"kwh": {"windows": [3], "aggs": ["avg", "max"]}},
            "imputation_value": -1.0,
        }
    )
    assert spec.target == "kwh"
    assert list(features.window_features(spec)) == [
        "kwh_lag_24h",
        "kwh_roll_avg_3h",
        "kwh_roll_max_3h",
    ]
    with pytest.raises(ValueError, match="aggregates"):
        FeatureSpec(rolling={"x": Rolling((3,), ("median",))})
    with pytest.raises(ValueError, match="mode"):
        FeatureSpec(mode="days")


def test_existing_columns_keep_the_wanted_order(spark):
    frame = spark.range(1).selectExpr("1 as b", "2 as a")
    assert features.existing_columns(frame, ["a", "x", "b"]).columns == ["a", "b"]


def test_unknown_column_is_an_error(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        features.feature_table(training_panel(spark), FeatureSpec(), ["nope"])
