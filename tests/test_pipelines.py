"""Whole runs over files: ingest, features, training, evaluation, publication."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from frames import (
    consumption,
    history_panel,
    weekend_calendar,
    solar,
    training_panel,
    weather,
    weather_forecast,
)
from pyspark.sql import functions as F

from hourgrid.config import TREE_FEATURES, FeatureSpec, QualityThresholds
from hourgrid.operators import publish, registry
from hourgrid.operators.panel import with_date_parts
from hourgrid.plans import pipelines
from hourgrid.sources import readers, writers

TRAIN_COLUMNS = ("building_id", "timestamp_hour", "consumption_kwh", *TREE_FEATURES)
DAYS = ("2025-08-09", "2025-08-10")


def _write_feeds(spark, folder):
    rng = random.Random(5)
    stamps = [
        datetime(2025, 8, 8) + timedelta(minutes=20 * i, seconds=7) for i in range(72 * 4)
    ]
    text = [f"{s:%Y-%m-%d %H:%M:%S}" for s in stamps]
    feeds = {
        "consumption": consumption(
            spark, *[("B1", t, round(rng.uniform(0, 2), 2)) for t in text]
        ),
        "solar": solar(spark, *[("B1", t, 0.1) for t in text]),
        "weather": weather(spark, *[("B1", t, 10.0, 100.0, 50.0) for t in text]),
        "calendar": weekend_calendar(spark),
    }
    for name, feed in feeds.items():
        feed.write.json(f"{folder}/{name}")
    return [f"{folder}/{name}" for name in feeds]


def _stored_panel(spark, frame, path):
    writers.write_panel(with_date_parts(frame), path)
    return path


def test_ingest_replaces_only_its_days(spark, tmp_path):
    feeds = _write_feeds(spark, tmp_path)
    target = str(tmp_path / "panel")
    assert pipelines.run_ingest(spark, *feeds, *DAYS, target) == 48
    assert pipelines.run_ingest(spark, *feeds, DAYS[1], DAYS[1], target) == 24
    stored = spark.read.parquet(target)
    assert stored.count() == 48
    assert stored.select("building_id", "timestamp_hour").distinct().count() == 48
    assert dict(stored.dtypes)["timestamp_hour"] == "timestamp_ntz"
    assert readers.read_panel(spark, target, DAYS[0], DAYS[0]).count() == 24
    holiday = stored.agg(F.min("is_holiday_flag"), F.max("is_holiday_flag")).first()
    assert tuple(holiday) == (1, 1)


def test_ingest_of_a_day_without_data_leaves_the_panel(spark, tmp_path):
    feeds = _write_feeds(spark, tmp_path)
    target = str(tmp_path / "panel")
    pipelines.run_ingest(spark, *feeds, *DAYS, target)
    assert pipelines.run_ingest(spark, *feeds, "2020-01-01", "2020-01-01", target) == 0
    assert spark.read.parquet(target).count() == 48


def test_corrupt_lines_are_set_aside_by_day(spark, tmp_path):
    feeds = _write_feeds(spark, tmp_path)
    target = str(tmp_path / "panel")
    clean = pipelines.run_ingest(spark, *feeds, *DAYS, target)
    assert not (tmp_path / "panel_rejects").exists()
    bad = tmp_path / "consumption" / "bad.json"
    bad.write_text(
        '{"building_id": "B1", "date_partition_col": "2025-08-09", "aggr\n'
        '{"building_id":"B1","timestamp_str":"2025-08-10 01:00:00","aggregated_kwh":"x","date_partition_col":"2025-08-10"}\n'
        "no record\n"
        '{"date_partition_col":"2025-08-01"\n'
    )
    for _ in range(2):
        assert pipelines.run_ingest(spark, *feeds, *DAYS, target) == clean
        rejects = spark.read.schema("feed string, line string, read string, source_day string").parquet(
            writers.rejects_path(target)
        )
        found = sorted((r.feed, r.source_day or "", r.line[:5]) for r in rejects.collect())
        assert [f[:2] for f in found] == [("consumption", ""), ("consumption", DAYS[0]), ("consumption", DAYS[1])]
    assert spark.read.parquet(target).count() == 48
    bad.write_text("")
    pipelines.run_ingest(spark, *feeds, *DAYS, target)
    assert rejects.sparkSession.read.schema(rejects.schema).parquet(writers.rejects_path(target)).isEmpty()


def test_panel_table_is_registered(spark, tmp_path):
    feeds = _write_feeds(spark, tmp_path)
    target = str(tmp_path / "panel")
    try:
        pipelines.run_ingest(spark, *feeds, DAYS[0], DAYS[0], target, "panel_table")
        assert spark.table("panel_table").count() == 24
        pipelines.run_ingest(spark, *feeds, DAYS[1], DAYS[1], target, "panel_table")
        table = spark.table("panel_table")
        assert table.count() == 48
        assert table.columns[-3:] == ["year", "month", "day"]
    finally:
        spark.sql("DROP TABLE IF EXISTS panel_table")


def test_feature_sets_are_written_by_side(spark, tmp_path):
    panel = _stored_panel(spark, training_panel(spark), str(tmp_path / "panel"))
    target = str(tmp_path / "features")
    args = ("2025-08-01", "2025-08-10", "2025-08-08")
    assert pipelines.run_feature_engineering(spark, panel, *args, target) == 432
    assert readers.read_features(spark, f"{target}/split=train").count() == 288
    assert readers.read_features(spark, f"{target}/split=eval").count() == 144
    train, evaluation = pipelines.calculate_features(spark, panel, *args)
    assert (train.count(), evaluation.count()) == (288, 144)


def test_no_panel_rows_give_no_features(spark, tmp_path):
    panel = _stored_panel(spark, training_panel(spark, 1), str(tmp_path / "panel"))
    result = pipelines.calculate_features(
        spark, panel, "2020-01-01", "2020-01-10", "2020-01-08"
    )
    assert result == (None, None)


def test_zoned_panels_keep_their_wall_clock(spark, tmp_path):
    path = str(tmp_path / "panel")
    zoned = with_date_parts(training_panel(spark, 1)).withColumn(
        "timestamp_hour", F.col("timestamp_hour").cast("timestamp")
    )
    zoned.write.partitionBy("year", "month", "day").parquet(path)
    panel = readers.read_panel(spark, path, "2025-08-01", "2025-08-01")
    assert dict(panel.dtypes)["timestamp_hour"] == "timestamp_ntz"
    assert panel.agg(F.min("timestamp_hour")).first()[0] == datetime(2025, 8, 1)


@pytest.fixture
def inputs(spark, tmp_path):
    """A stored 30-day panel, a 72 h weather forecast for two buildings, a calendar."""
    forecast = str(tmp_path / "weather_forecast")
    both = weather_forecast(spark)
    both = both.unionByName(both.withColumn("building_id", F.lit("B2")))
    shifted = both.withColumn(
        "timestamp_hour_str",
        F.date_format(
            F.col("timestamp_hour_str").cast("timestamp_ntz")
            + F.expr("INTERVAL '20' DAY"),
            "yyyy-MM-dd HH:mm:ss",
        ),
    )
    shifted.write.json(forecast)
    calendar = str(tmp_path / "calendar")
    weekend_calendar(spark).write.json(calendar)
    panel = _stored_panel(spark, training_panel(spark, 30), str(tmp_path / "panel"))
    return {"panel": panel, "forecast": forecast, "calendar": calendar}


@pytest.mark.parametrize(
    ("strategy", "settings"),
    [
        ("Prophet", {}),
        # Every tree is shrunk by eta, the first too: few rounds need a larger one, and all
        # features, or trees without the lags tell the two buildings apart by chance.
        (
            "XGBoost",
            {
                "xgb_max_depth": 3,
                "xgb_num_boost_round": 12,
                "xgb_eta": 0.4,
                "xgb_subsample": 1.0,
                "xgb_colsample_bytree": 1.0,
            },
        ),
    ],
)
def test_train_evaluate_register_and_publish(spark, tmp_path, inputs, strategy, settings):
    path = {
        name: str(tmp_path / name)
        for name in ("features", "model", "report", "registry", "work", "measures")
    }
    rows = pipelines.run_feature_engineering(
        spark,
        inputs["panel"],
        "2025-08-01",
        "2025-08-30",
        "2025-08-25",
        path["features"],
        columns=TRAIN_COLUMNS,
    )
    assert rows == 2 * 23 * 24  # the first week lacks its weekly lag
    train, evaluation = (f"{path['features']}/split={s}" for s in ("train", "eval"))
    pipelines.run_training(
        spark, strategy, train, path["model"], TREE_FEATURES, settings
    )

    report = pipelines.run_evaluation(spark, path["model"], evaluation, path["report"])
    (row,) = report.collect()
    assert (row.status, row.num_eval_records) == ("Success", 2 * 6 * 24)
    assert 0 < row.metrics.mape < 20
    files = list((tmp_path / "report").glob("*.json"))
    stored = json.loads(next(f.read_text() for f in files if f.stat().st_size))
    assert set(stored) == {"metrics", "num_eval_records", "status"}

    run = pipelines.RunDetails("g", "run-1", datetime(2025, 8, 31), commit="c0ffee")
    registered = pipelines.run_registration(
        spark, path["model"], evaluation, path["registry"], run, settings
    )
    entries = spark.read.parquet(path["registry"])
    assert registered == entries.count() == 2
    strict = pipelines.run_registration(
        spark,
        path["model"],
        evaluation,
        path["registry"],
        run,
        settings,
        QualityThresholds(max_mape=0.0),
    )
    assert strict == 0

    written = pipelines.run_inference(
        spark,
        path["model"],
        inputs["panel"],
        inputs["forecast"],
        inputs["calendar"],
        "2025-08-31",
        path["work"],
        path["measures"],
    )
    assert written == 2 * 72 * 3
    measures = spark.read.parquet(path["measures"])
    served = publish.serve_forecast(measures, "B1", "2025-08-31", hours=72)
    assert served.count() == 72
    assert served.where("measure_value IS NULL").isEmpty()


def test_group_inference_uses_the_approved_model_and_its_columns(spark, tmp_path, inputs):
    """Two versions are registered; the approved one serves, with the features it was trained on."""
    spec = FeatureSpec(lags={"consumption_kwh": (36,)}, rolling={}, mode="hours")
    columns = ("building_id", "timestamp_hour", "consumption_kwh", "hour_of_day", "consumption_lag_36h")
    features, registered = str(tmp_path / "features"), str(tmp_path / "registry")
    days = ("2025-08-01", "2025-08-30", "2025-08-25")
    pipelines.run_feature_engineering(spark, inputs["panel"], *days, features, spec, columns)
    settings = {"xgb_max_depth": 3, "xgb_num_boost_round": 3, "xgb_subsample": 1.0}
    for run, used in (("r1", ["hour_of_day", "consumption_lag_36h"]), ("r2", ["hour_of_day"])):
        model = pipelines.model_version(str(tmp_path / "models"), run)
        pipelines.run_training(spark, "XGBoost", f"{features}/split=train", model, used, settings, spec=spec)
        details = pipelines.RunDetails("g", run, datetime(2025, 8, 30 + (run == "r2")))
        loose = QualityThresholds(max_mape=1e9, max_rmse=1e9)
        pipelines.run_registration(spark, model, f"{features}/split=eval", registered, details, settings, loose)
    args = (inputs["panel"], inputs["forecast"], inputs["calendar"], "2025-08-31")
    paths = (str(tmp_path / "work"), str(tmp_path / "measures"))
    with pytest.raises(ValueError, match="no approved entry"):
        pipelines.run_group_inference(spark, registered, "g", *args, *paths)
    assert pipelines.run_approval(spark, registered, "g", "r1") == 2
    assert pipelines.run_approval(spark, registered, "g", "nothing") == 0
    assert pipelines.run_group_inference(spark, registered, "g", *args, *paths) == 2 * 72 * 3
    made = spark.read.parquet(f"{paths[0]}/features")
    assert made.columns == ["building_id", "timestamp_hour", "hour_of_day", "consumption_lag_36h"]
    # Approving the newer run changes what serves.
    assert pipelines.run_approval(spark, registered, "g", "r2") == 2
    pipelines.run_group_inference(spark, registered, "g", *args, *paths)
    assert spark.read.parquet(f"{paths[0]}/features").columns == made.columns[:3]
    assert pipelines.run_approval(spark, registered, "g", "r2", registry.REJECTED) == 2
    entries = spark.read.parquet(registered)
    assert registry.approved_model_path(entries, "g").endswith("run=r1")


def test_a_side_without_rows_is_empty(spark, tmp_path):
    panel = _stored_panel(spark, training_panel(spark), str(tmp_path / "panel"))
    target = str(tmp_path / "features")
    days = ("2025-08-01", "2025-08-10")
    pipelines.run_feature_engineering(spark, panel, *days, "2025-08-08", target)
    for split, sides in (("2025-09-01", (432, 0)), ("2025-08-01", (0, 432)), ("2025-08-08", (288, 144))):
        assert pipelines.run_feature_engineering(spark, panel, *days, split, target) == 432
        read = [readers.read_features(spark, f"{target}/split={side}") for side in ("train", "eval")]
        assert tuple(r.count() for r in read) == sides
        assert read[0].columns == read[1].columns and "consumption_lag_24h" in read[0].columns
    assert pipelines.run_feature_engineering(spark, panel, "2020-01-01", "2020-01-02", "2020-01-02", target) == 0
    assert readers.read_features(spark, f"{target}/split=train").isEmpty()


def test_missing_history_or_weather_gives_no_features(spark, tmp_path, inputs):
    def run(start):
        return pipelines.calculate_inference_features(
            spark, inputs["panel"], inputs["forecast"], inputs["calendar"], start
        )

    assert run("2025-01-01") is None  # no history
    assert run("2025-08-20") is None  # no forecast weather
    assert run("2025-08-31").count() == 144
    assert not pipelines.run_inference_features(
        spark,
        inputs["panel"],
        inputs["forecast"],
        inputs["calendar"],
        "2025-01-01",
        str(tmp_path / "nothing"),
    )
    assert not (tmp_path / "nothing").exists()


def test_inference_features_from_files(spark, tmp_path):
    forecast, calendar = str(tmp_path / "forecast"), str(tmp_path / "calendar")
    weather_forecast(spark).write.json(forecast)
    weekend_calendar(spark).write.json(calendar)
    panel = _stored_panel(spark, history_panel(spark), str(tmp_path / "panel"))
    result = pipelines.calculate_inference_features(
        spark, panel, forecast, calendar, "2025-08-11", 72, 7
    )
    assert result.count() == 72
    last = result.agg(F.max("timestamp_hour")).first()[0]
    assert last == datetime(2025, 8, 13, 23)


def test_evaluation_without_matches_reports_an_error(spark, tmp_path):
    frame = training_panel(spark, 3)
    train, other = str(tmp_path / "train"), str(tmp_path / "other")
    frame.write.parquet(train)
    frame.limit(0).write.parquet(other)
    pipelines.run_training(spark, "Prophet", train, str(tmp_path / "model"))
    report = pipelines.run_evaluation(
        spark, str(tmp_path / "model"), other, str(tmp_path / "report")
    ).first()
    assert (report.status, report.num_eval_records) == ("Error", 0)
    assert report.error_message


def test_empty_or_missing_training_data_is_an_error(spark, tmp_path):
    empty = str(tmp_path / "empty")
    training_panel(spark, 1).limit(0).write.parquet(empty)
    with pytest.raises(ValueError, match="no rows to train on"):
        pipelines.run_training(spark, "Prophet", empty, str(tmp_path / "model"))
    with pytest.raises(FileNotFoundError):
        pipelines.run_training(
            spark, "Prophet", str(tmp_path / "absent"), str(tmp_path / "model")
        )


def test_feature_files_with_different_columns(spark, tmp_path):
    path = str(tmp_path / "features")
    spark.range(2).selectExpr("id", "1.0D a").write.parquet(path)
    spark.range(3).selectExpr("2.0D b", "id").write.mode("append").parquet(path)
    merged = readers.read_features(spark, path, merge_schema=True)
    assert set(merged.columns) == {"id", "a", "b"}
    assert merged.agg(F.count("a"), F.count("b")).first()[:] == (2, 3)


def test_unknown_publish_target_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported publish target"):
        pipelines.run_publish(spark, str(tmp_path), str(tmp_path / "out"), "RDS")
