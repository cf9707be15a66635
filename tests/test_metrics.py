from __future__ import annotations

import math

import pytest

from hourgrid.config import QualityThresholds
from hourgrid.operators import metrics
from hourgrid.sources import readers, writers


def _scored(spark, pairs):
    return spark.createDataFrame(
        [("B1", y, p) for y, p in pairs],
        "building_id string, consumption_kwh double, yhat double",
    )


def _metrics(spark, pairs):
    return metrics.forecast_metrics(_scored(spark, pairs)).first()


def test_basic_values(spark):
    row = _metrics(spark, [(8.0, 6.0), (20.0, 23.0), (5.0, 5.0)])
    assert row.mae == pytest.approx(5 / 3)
    assert row.rmse == pytest.approx(math.sqrt(13 / 3))
    assert row.mape == pytest.approx(40 / 3)
    assert row.n == 3


def test_zero_actuals_are_left_out_of_mape_only(spark):
    row = _metrics(spark, [(0.0, 3.0), (40.0, 30.0), (0.0, 2.0)])
    assert row.mae == pytest.approx(5.0)
    assert row.mape == pytest.approx(25.0)


def test_missing_values_count_as_zero(spark):
    row = _metrics(spark, [(None, 2.0), (4.0, None), (float("nan"), 0.0)])
    assert row.mae == pytest.approx(2.0)
    assert row.mape == pytest.approx(100.0)


def test_only_zero_actuals_give_infinite_mape(spark):
    row = _metrics(spark, [(0.0, 1.0)])
    assert (row.mae, row.mape) == (1.0, math.inf)


def test_empty_input_gives_nulls_and_an_error_report(spark):
    empty = metrics.forecast_metrics(_scored(spark, []))
    assert tuple(empty.first()) == (None, None, None, 0)
    report = metrics.evaluation_report(empty).first()
    assert (report.status, report.num_eval_records) == ("Error", 0)
    assert report.error_message


def test_reports_survive_json(spark, tmp_path):
    path = str(tmp_path / "report")
    for pairs, mape in (([(0.0, 1.0)], math.inf), ([(2.0, 1.0)], 50.0), ([], None)):
        scores = metrics.forecast_metrics(_scored(spark, pairs))
        report = metrics.evaluation_report(scores)
        writers.write_evaluation_report(report, path)
        stored = readers.read_evaluation_report(spark, path).collect()
        assert stored == report.collect()
        assert stored[0].metrics.mape == mape


def test_only_matching_hours_are_scored(spark):
    actuals = spark.createDataFrame(
        [("B1", "2024-01-01 00:00:00", 5.0), ("B1", "2024-01-01 01:00:00", 6.0)],
        "building_id string, timestamp_hour string, consumption_kwh double",
    )
    predictions = spark.createDataFrame(
        [("B1", "2024-01-01 01:00:00", 7.0), ("B2", "2024-01-01 01:00:00", 9.0)],
        "building_id string, timestamp_hour string, yhat double",
    )
    (row,) = metrics.match_actuals(actuals, predictions).collect()
    assert (row.consumption_kwh, row.yhat) == (6.0, 7.0)


@pytest.mark.parametrize(
    ("mape", "rmse", "passed"),
    [
        (20.0, 5.0, True),
        (20.1, 5.0, False),
        (20.0, 5.1, False),
        (None, 1.0, False),
        (math.inf, 1.0, False),
    ],
)
def test_quality_gate(spark, mape, rmse, passed):
    row = spark.createDataFrame([(mape, rmse)], "mape double, rmse double")
    assert metrics.quality_gate(row, QualityThresholds()).first().passed is passed
