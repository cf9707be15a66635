"""The physical plans the operators are meant to get at scale."""

from __future__ import annotations

import re

import pytest
from frames import (
    calendar,
    consumption,
    solar,
    training_panel,
    weather,
)

from hourgrid.config import FeatureSpec
from hourgrid.models.trend_seasonal import fit_trend_seasonal
from hourgrid.operators import features
from hourgrid.operators.panel import build_panel, with_date_parts
from hourgrid.plans import catalog
from hourgrid.sources import readers, writers


@pytest.fixture(autouse=True)
def no_size_based_broadcast(spark):
    """Tables here are tiny; plan the joins as for large ones."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> list[str]:
    return re.findall(r"Exchange (?:hash|range|single|round)\w*(?:\([^)]*\))?", plan)


def test_panel_joins_reuse_the_rollup_shuffles(spark):
    panel = build_panel(
        consumption(spark, ("B1", "2025-08-10 14:15:00", 1.5)),
        solar(spark, ("B1", "2025-08-10 14:15:00", 1.5)),
        weather(spark, ("B1", "2025-08-10 14:15:00", 1.5, 1.0, 1.0)),
        calendar(spark, ("2025-08-10", 0, "day")),
    )
    plan = _plan(panel)
    assert len(_shuffles(plan)) == 4  # three feeds and the calendar
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("BroadcastHashJoin") == 1  # one row per date


def test_training_features_compute_only_what_is_asked_for(spark):
    labelled = features.training_features(
        training_panel(spark), "2025-08-01", "2025-08-10", "2025-08-08"
    )
    plan = _plan(labelled)
    assert len(_shuffles(plan)) == 5
    assert "consumption_lag_168h" not in plan  # features not asked for are pruned


def test_row_window_queries_read_stored_rows_only(spark):
    for query in (catalog.lag_features, catalog.rolling_features_full, catalog.forecast_metrics):
        plan = _plan(query(spark, "/root/testdata/sf0.001"))
        assert "events.parquet" not in plan
        assert "FileScan" in plan


def test_unbounded_windows_never_partition_by_building_alone(spark):
    for mode in ("rows", "hours"):
        spec = FeatureSpec(mode=mode)
        plan = _plan(features.add_window_features(training_panel(spark), spec))
        windows = re.findall(r"\bWindow \[(?:lag|max|avg)\(.*", plan)
        assert windows
        assert all(re.search(r"\], \[building_id#\d+, _block#\d+L?\], \[", w) for w in windows)
    assert len(_shuffles(plan)) == 1  # by the clock: no second shuffle


def test_row_positions_move_the_rows_once_and_the_counts_thrice(spark):
    plan = _plan(features.add_window_features(training_panel(spark), FeatureSpec()))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    keys = [re.sub(r"#\d+L?|, \d+$", "", s) for s in shuffles]
    assert sorted(keys) == sorted(
        [
            "_series, _chunk",  # the rows, to be numbered
            "building_id, _block",  # the rows, into their blocks
            "_series, _chunk",  # counts per chunk
            "_series",  # their running total
            "_series, _chunk",  # the totals, back to the numbered rows
        ]
    )


def test_days_are_pruned_in_the_stored_panel(spark, tmp_path):
    path = str(tmp_path / "panel")
    writers.write_panel(with_date_parts(training_panel(spark, 5)), path)
    plan = _plan(
        readers.read_panel(spark, path, "2025-08-02", "2025-08-03").select("humidity")
    )
    filters = re.search(r"PartitionFilters: \[([^\]]*)", plan).group(1)
    assert "make_date" in filters
    assert re.search(r"ReadSchema: struct<humidity:double>", plan)


def test_writes_gather_days_into_full_files(spark, tmp_path):
    path = str(tmp_path / "panel")
    panel = with_date_parts(training_panel(spark, 3)).repartition(16)
    writers.write_panel(panel, path)
    assert len(list((tmp_path / "panel").rglob("*.parquet"))) == 3
    hinted = panel.hint("rebalance", "year", "month", "day")
    assert "REBALANCE_PARTITIONS_BY_COL" in _plan(hinted)


def test_fit_shuffles_narrow_rows_once_and_partial_results_once(spark):
    model = fit_trend_seasonal(training_panel(spark))
    plan = _plan(model.coefficients)
    assert len(_shuffles(plan)) == 2
    assert re.search(r"hashpartitioning\(building_id#\d+, _block#\d+L?", plan)
    # The wide design rows are made after the shuffle.
    assert re.search(r"array\(SIN\(", plan).start() < plan.index("REPARTITION_BY_COL")
