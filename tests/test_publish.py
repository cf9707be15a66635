from __future__ import annotations

from datetime import datetime

import pytest

from hourgrid.operators import publish, registry
from hourgrid.schemas import FORECAST
from hourgrid.sources import readers, writers

ROWS = [
    ("B1", datetime(2025, 8, 11, 0), 20.1, 18.0, 22.0),
    ("B1", datetime(2025, 8, 11, 1), 21.0, 19.0, None),
    ("B2", datetime(2025, 8, 12, 0), 9.5, 8.0, 11.0),
]


@pytest.fixture
def forecasts(spark):
    return spark.createDataFrame(ROWS, FORECAST)


def test_three_measures_per_row(forecasts):
    long = publish.forecast_long(forecasts)
    assert long.columns == ["time", "dim_building_id", "measure_name", "measure_value"]
    values = {(r.dim_building_id, r.time, r.measure_name): r.measure_value for r in long.collect()}
    assert len(values) == 9
    assert values["B1", datetime(2025, 8, 11, 0), "forecast"] == 20.1
    assert values["B1", datetime(2025, 8, 11, 1), "forecast_upper"] is None


def test_rows_without_key_are_dropped(spark):
    rows = [(None, ROWS[0][1], 1.0, 1.0, 1.0), ("B1", None, 1.0, 1.0, 1.0)]
    assert publish.forecast_long(spark.createDataFrame(rows, FORECAST)).isEmpty()


def test_measure_counts(forecasts):
    counts = publish.measure_counts(publish.forecast_long(forecasts))
    assert {tuple(r) for r in counts.collect()} == {("B1", 3, 6), ("B2", 3, 3)}


def test_stored_measures_serve_one_building_and_day(spark, forecasts, tmp_path):
    path = str(tmp_path / "measures")
    long = publish.forecast_long(forecasts)
    assert writers.write_measures(long, path) == 9
    assert writers.write_measures(long, path) == 9  # a re-run replaces
    stored = spark.read.parquet(path)
    assert stored.count() == 9
    served = publish.serve_forecast(stored, "B1", "2025-08-11")
    assert [r.measure_value for r in served.collect()] == [20.1, 21.0]
    assert publish.serve_forecast(stored, "B1", "2025-08-11", limit=1).count() == 1
    assert publish.serve_forecast(stored, "B1", "2025-08-12").isEmpty()
    plan = served._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_rows_can_go_to_another_store(forecasts, tmp_path):
    folder = str(tmp_path)

    def send(rows):
        import uuid
        from pathlib import Path

        lines = [f"{r.dim_building_id},{r.measure_name}\n" for r in rows]
        if lines:
            Path(folder, uuid.uuid4().hex).write_text("".join(lines))

    writers.send_measures(publish.forecast_long(forecasts), send)
    sent = "".join(f.read_text() for f in tmp_path.iterdir()).splitlines()
    assert len(sent) == 9


def test_latest_hour(forecasts):
    (row,) = publish.latest_hour(forecasts).collect()
    assert row.timestamp_hour == datetime(2025, 8, 12, 0)


def test_mixed_files_are_read_as_one_frame(spark, forecasts, tmp_path):
    path = str(tmp_path / "mixed")
    forecasts.limit(2).write.mode("append").parquet(path)
    late = forecasts.where("building_id = 'B2'")
    late.write.mode("append").option("header", "true").csv(path)
    result = readers.read_forecasts(spark, path)
    assert sorted(map(tuple, result.collect())) == sorted(ROWS)


def test_csv_with_plain_timestamps(spark, tmp_path):
    file = tmp_path / "f.out"
    file.write_text(
        "building_id,timestamp_hour,yhat,yhat_lower,yhat_upper\n"
        "B1,2025-08-11 00:00:00,1.5,1.0,2.0\n"
    )
    row = readers.read_forecast_file(spark, str(file)).first()
    assert tuple(row) == ("B1", datetime(2025, 8, 11), 1.5, 1.0, 2.0)


def test_csv_columns_go_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "yhat,building_id,note,yhat_upper,yhat_lower,timestamp_hour\n"
        "7.5,N7,kept out,9.0,6.0,2025-06-02 03:00:00\n"
    )
    (tmp_path / "b.csv").write_text(
        "building_id,timestamp_hour,yhat,yhat_lower,yhat_upper\n"
        "N8,2025-06-02 04:00:00,1.0,0.5,2.0\n"
    )
    rows = sorted(map(tuple, readers.read_forecasts(spark, str(tmp_path)).collect()))
    assert rows == [
        ("N7", datetime(2025, 6, 2, 3), 7.5, 6.0, 9.0),
        ("N8", datetime(2025, 6, 2, 4), 1.0, 0.5, 2.0),
    ]


def test_csv_header_is_the_first_line_of_its_file(spark, tmp_path):
    """Lines that look like a header stay data; quoted cells keep their commas."""
    (tmp_path / "a.csv").write_text(
        '"note","building_id","timestamp_hour","yhat"\n'
        '"a, b","building_id",2025-06-02 03:00:00,7.5\n'
        "\n"
        'building_id,"N,7",2025-06-02 05:00:00,\n'
    )
    (tmp_path / "b.csv").write_text("yhat\n")
    (tmp_path / "c.csv").write_text("")
    rows = sorted(map(tuple, readers.read_forecasts(spark, str(tmp_path)).collect()))
    assert rows == [
        ("N,7", datetime(2025, 6, 2, 5), None, None, None),
        ("building_id", datetime(2025, 6, 2, 3), 7.5, None, None),
    ]


def test_csv_files_larger_than_a_block(spark, tmp_path):
    lines = [f"N7,2025-06-02 03:00:00,{i}.0,0,0" for i in range(3000)]
    for name in ("a", "b"):
        text = "\n".join(["building_id,timestamp_hour,yhat,yhat_lower,yhat_upper", *lines])
        (tmp_path / f"{name}.csv").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = readers.read_forecasts(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.yhat for r in found) == sorted(2 * [float(i) for i in range(3000)])


def test_other_file_types_are_refused(spark, tmp_path):
    (tmp_path / "forecasts.xlsx").write_text("x")
    with pytest.raises(ValueError, match="Neither Parquet nor CSV"):
        readers.read_forecasts(spark, str(tmp_path))
    with pytest.raises(ValueError, match="Neither Parquet nor CSV"):
        readers.read_forecast_file(spark, "forecasts.xlsx")


def test_folder_without_files_gives_no_rows(spark, tmp_path):
    assert readers.read_forecasts(spark, str(tmp_path)).isEmpty()


# --- Registry -------------------------------------------------------------------


def _registry(spark):
    day = datetime(2024, 1, 1)
    later = datetime(2024, 2, 1)
    rows = [
        ("a-1", "a", "Approved", day),
        ("a-2", "a", "Approved", later),
        ("a-3", "a", "Approved", later),
        ("a-4", "a", "PendingManualApproval", datetime(2025, 8, 1)),
        ("b-1", "b", "PendingManualApproval", day),
    ]
    return spark.createDataFrame(
        rows,
        "model_package_id string, model_package_group string,"
        " approval_status string, created_at timestamp_ntz",
    )


def test_latest_approved_prefers_newest_then_highest_id(spark):
    (row,) = registry.latest_approved(_registry(spark)).collect()
    assert row.model_package_id == "a-3"
    assert registry.require_latest_approved(_registry(spark), "a").model_package_id == "a-3"
    with pytest.raises(ValueError, match="Group b holds no approved entry"):
        registry.require_latest_approved(_registry(spark), "b")


def test_latest_without_status_filter(spark):
    latest = registry.latest_per_group(_registry(spark))
    assert {r.model_package_id for r in latest.collect()} == {"a-4", "b-1"}


def test_registry_rows(spark):
    scores = spark.createDataFrame(
        [("B1", 1.0, 2.0, 3.0, 10), ("B2", None, None, None, 0)],
        "building_id string, mae double, rmse double, mape double, n bigint",
    )
    entries = registry.registry_rows(
        scores,
        group="g",
        run_id="r",
        created_at=datetime(2025, 8, 1),
        commit="c0ffee",
        hyperparameters={"xgb_eta": "0.1"},
    )
    rows = {r.building_id: r for r in entries.collect()}
    assert rows["B1"].approval_status == "PendingManualApproval"
    assert rows["B1"].properties["Evaluation_mape"] == "3.000000"
    assert rows["B1"].properties["Hyperparameter_xgb_eta"] == "0.1"
    assert rows["B1"].properties["GitCommit"] == "c0ffee"
    assert rows["B2"].properties["EvaluationStatus"] == "Error"
    assert rows["B2"].properties["Evaluation_mae"] == "None"
