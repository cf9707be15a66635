"""Clock windows against plain scans of the rows in the frame."""

from __future__ import annotations

import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hourgrid.config import FeatureSpec, Rolling
from hourgrid.operators.features import add_window_features, feature_table
from hourgrid.schemas import PANEL_VALUES

START = datetime(2025, 1, 1)
LENGTHS = (1, 2, 3, 5, 24, 31, 168)
AGGS = ("avg", "stddev", "min", "max")
SPEC = FeatureSpec(
    mode="hours",
    lags={"consumption_kwh": (24,)},
    rolling={"consumption_kwh": Rolling(LENGTHS, AGGS), "temperature_c": Rolling((24,), ("avg",))},
)


def _rows():
    rng = random.Random(11)
    rows = []
    for building, share in (("A", 0.97), ("B", 0.3), ("C", 0.004), (None, 0.5)):
        for hour in range(3000):
            if rng.random() < share:
                value = rng.choice([None, 1e9, *[rng.uniform(0, 5) for _ in range(30)]])
                rows.append((building, START + timedelta(hours=hour), value))
    rows += [("A", START + timedelta(hours=50), 7.0)] * 2 + [("A", None, 1.0), ("A", None, 3.0), ("B", None, None)]
    return [(b, t, v, 0.0, v, None, None, 0) for b, t, v in rows]


def _expected(values, agg):
    if len(values) < (2 if agg == "stddev" else 1):
        return None
    kinds = {"avg": statistics.fmean, "stddev": statistics.stdev, "min": min, "max": max}
    return kinds[agg](values)


@pytest.mark.parametrize("block_rows", [168, 4096])
def test_frames_equal_plain_scans(spark, block_rows):
    rows = _rows()
    panel = spark.createDataFrame(rows, PANEL_VALUES).repartition(3)
    found = add_window_features(panel, SPEC, block_rows=block_rows).collect()
    assert len(found) == len(rows)
    by_building: dict = {}
    for b, t, v, *_ in rows:
        by_building.setdefault(b, []).append((t, v))
    for r in found[:: 3 if block_rows == 168 else 7]:
        for length in LENGTHS:
            first = r.timestamp_hour and r.timestamp_hour - timedelta(hours=length - 1)
            values = [
                v
                for t, v in by_building[r.building_id]
                if v is not None
                and (t is None if first is None else t is not None and first <= t <= r.timestamp_hour)
            ]
            for agg in AGGS:
                got = r[f"consumption_roll_{'std' if agg == 'stddev' else agg}_{length}h"]
                want = _expected(values, agg)
                assert got == want or math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-6), (r, length, agg)


def test_nan_ranks_above_numbers(spark):
    values = [1.0, math.nan, 2.0]
    rows = [("A", START + timedelta(hours=i), v, 0.0, v, None, None, 0) for i, v in enumerate(values)]
    spec = FeatureSpec(mode="hours", lags={}, rolling={"consumption_kwh": Rolling((2,), ("avg", "min", "max"))})
    found = add_window_features(spark.createDataFrame(rows, PANEL_VALUES), spec).orderBy("timestamp_hour").collect()
    assert [r.consumption_roll_min_2h for r in found] == [1.0, 1.0, 2.0]
    assert [math.isnan(r.consumption_roll_max_2h) for r in found] == [False, True, True]
    assert [math.isnan(r.consumption_roll_avg_2h) for r in found] == [False, True, True]


def test_one_shuffle_and_no_rows(spark):
    panel = spark.createDataFrame(_rows(), PANEL_VALUES)
    columns = ["building_id", "timestamp_hour", "consumption_lag_24h", "consumption_roll_avg_168h"]
    made = feature_table(panel, SPEC, columns)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert feature_table(panel.where(F.lit(False)), SPEC, columns).count() == 0
