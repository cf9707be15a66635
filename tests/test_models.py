from __future__ import annotations

import math
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.config import BoostedTreeParams, TrendSeasonalParams
from hourgrid.models import ridge
from hourgrid.models.boosted_trees import fit_boosted_trees
from hourgrid.models.store import fit_forecaster, load_forecaster, model_type_of
from hourgrid.models.trend_seasonal import (
    Layout,
    fit_trend_seasonal,
    linear_trend,
    plan_layout,
)

START = datetime(2025, 8, 1)
FRAME = "building_id string, timestamp_hour timestamp_ntz, consumption_kwh double"


def _wave(hour: int, level: float) -> float:
    return level + 0.05 * hour + 3 * math.sin(2 * math.pi * hour / 24)


def _series(spark, hours, first=0, levels=(("B1", 20.0), ("B2", 50.0))):
    rows = [
        (b, START + timedelta(hours=h), _wave(h, level))
        for b, level in levels
        for h in range(first, first + hours)
    ]
    return spark.createDataFrame(rows, FRAME)


def test_trend_and_season_are_recovered(spark):
    model = fit_trend_seasonal(_series(spark, 28 * 24))
    future = _series(spark, 72, first=28 * 24)
    forecast = model.forecast(future)
    assert forecast.columns == [
        "building_id",
        "timestamp_hour",
        "yhat",
        "yhat_lower",
        "yhat_upper",
    ]
    both = forecast.join(future, ["building_id", "timestamp_hour"]).collect()
    assert len(both) == 144
    for row in both:
        assert row.yhat == pytest.approx(row.consumption_kwh, abs=0.2)
        assert row.yhat_lower <= row.yhat <= row.yhat_upper


def _minimiser(x, y, squares, absolutes):
    """Coordinate descent for |y - xb|**2 / 2 + squares * b**2 / 2 + absolutes * |b|."""
    gram, moment = x.T @ x, x.T @ y
    beta = np.linalg.lstsq(gram + np.diag(squares + 1e-9), moment, rcond=None)[0]
    for _ in range(40_000):
        before = beta.copy()
        for j in range(len(beta)):
            rest = moment[j] - gram[j] @ beta + gram[j, j] * beta[j]
            beta[j] = np.sign(rest) * max(abs(rest) - absolutes[j], 0) / (gram[j, j] + squares[j])
        if np.abs(beta - before).max() < 1e-12:
            break
    return beta


def test_coefficients_equal_a_direct_solution(spark, monkeypatch):
    """Summed blocks give what one penalised problem over all rows gives."""
    params = TrendSeasonalParams(n_changepoints=3, yearly_seasonality=False)
    rng = np.random.default_rng(1)
    hours = np.arange(500)
    values = 10 + 0.02 * np.maximum(hours - 200, 0) + np.sin(hours / 5) + rng.normal(0, 0.3, 500)
    frame = spark.createDataFrame(
        [("B1", START + timedelta(hours=int(h)), float(v)) for h, v in zip(hours, values)],
        FRAME,
    )
    from hourgrid.models import trend_seasonal

    monkeypatch.setattr(trend_seasonal, "BLOCK_HOURS", 60)
    model = fit_trend_seasonal(frame, params)
    fitted = model.coefficients.first()

    layout = plan_layout(0, 499, params, ())
    origin = (START - datetime(1970, 1, 1)) // timedelta(hours=1)
    t = hours / 499
    columns = [np.ones(500), t]
    columns += [np.maximum(t - p, 0) for p in layout.changepoints]
    for period, order in ((24, 4), (168, 3)):
        for k in range(1, order + 1):
            angle = 2 * np.pi * k * (hours + origin) / period
            columns += [np.sin(angle), np.cos(angle)]
    x = np.column_stack(columns)
    scale = math.sqrt(np.mean(values**2))
    y = values / scale
    normal = np.array([5.0] * 2 + [np.inf] * 3 + [10.0] * 14)
    laplace = np.array([np.inf] * 2 + [0.05] * 3 + [np.inf] * 14)
    noise = 1.0
    for _ in range(ridge.SOLVER_ROUNDS):
        beta = _minimiser(x, y, noise / normal**2, noise / laplace)
        noise = np.mean((y - x @ beta) ** 2)
    assert fitted.coefficients == pytest.approx(list(beta * scale), abs=1e-5)
    assert fitted.sigma == pytest.approx(math.sqrt(noise) * scale, rel=1e-6)
    assert fitted.n_obs == 500
    bends = np.abs(fitted.coefficients[2:5])
    assert fitted.drift == pytest.approx(3 * 2 * bends.mean() ** 2 / 3)

    # Scoring looks the trend up by stretch; it must equal the full design row.
    forecast = model.forecast(frame).orderBy("timestamp_hour").collect()
    assert [r.yhat for r in forecast] == pytest.approx(list(x @ beta * scale), abs=1e-5)


def test_absolute_penalties_meet_their_conditions():
    rng = np.random.default_rng(4)
    for size in (0, 1, 2, 6, 25):
        for strength in (0.0, 0.1, 3.0, 1e6):
            rows = rng.normal(size=(40, size)).cumsum(axis=0)
            square, linear = rows.T @ rows, rows.T @ rng.normal(size=40)
            penalty = np.full(size, strength)
            found = ridge.absolute(square, linear, penalty)
            slope = square @ found - linear
            zero = found == 0
            assert (np.abs(slope[zero]) <= penalty[zero] + 1e-6).all()
            assert slope[~zero] == pytest.approx(-penalty[~zero] * np.sign(found[~zero]), abs=1e-6)
            if strength == 1e6:
                assert zero.all()


def test_one_change_of_slope_is_recovered_and_no_other(spark):
    rng = np.random.default_rng(3)
    params = TrendSeasonalParams(weekly_seasonality=False, yearly_seasonality=False)
    layout = plan_layout(0, 1999, params, ())
    turn = layout.changepoints[12]
    rows = [
        (b, START + timedelta(hours=h), 20 + 8 * bend * max(h / 1999 - turn, 0) + rng.normal(0, 0.4))
        for b, bend in (("bent", 1), ("flat", 0))
        for h in range(2000)
    ]
    model = fit_trend_seasonal(spark.createDataFrame(rows, FRAME), params)
    found = {r.building_id: np.array(r.coefficients[2:27]) for r in model.coefficients.collect()}
    near = np.abs(np.array(layout.changepoints) - turn) < 0.1
    assert found["bent"][near].sum() == pytest.approx(8, rel=0.15)
    assert np.abs(found["bent"][~near]).sum() < 1.0
    assert (found["flat"] == 0).sum() >= 20 and (found["bent"] == 0).sum() >= 15
    # Beyond the range the interval of the bent one widens, inside it is level.
    later = [(b, START + timedelta(hours=h), 0.0) for b in ("bent", "flat") for h in (100, 1999, 2999, 3999)]
    wide: dict = {"bent": [], "flat": []}
    forecast = model.forecast(spark.createDataFrame(later, FRAME)).orderBy("timestamp_hour")
    for r in forecast.collect():
        wide[r.building_id].append(r.yhat_upper - r.yhat_lower)
    first, last, year, more = wide["bent"]
    assert first == pytest.approx(last) and last < year < more
    drift = {r.building_id: r.drift for r in model.coefficients.collect()}
    grown = (more**2 - last**2) / (2 * 1.2815515655446004) ** 2
    assert grown == pytest.approx(drift["bent"] * (2000 / 1999) ** 3, rel=1e-6)


def test_without_penalties_the_fit_is_a_least_squares_line(spark):
    params = TrendSeasonalParams(
        n_changepoints=0, daily_seasonality=False, weekly_seasonality=False, yearly_seasonality=False
    )
    rng = np.random.default_rng(9)
    rows = [("B1", START + timedelta(hours=h), 5 + rng.normal(0, 3)) for h in range(0, 90, 2)]
    frame = spark.createDataFrame(rows, FRAME)
    model = fit_trend_seasonal(frame, params, trend_prior_scale=math.inf)
    line = np.polyfit(range(0, 90, 2), [r[2] for r in rows], 1)
    found = model.forecast(frame).orderBy("timestamp_hour").collect()
    assert [r.yhat for r in found] == pytest.approx(list(np.polyval(line, range(0, 90, 2))), abs=1e-8)


def test_interval_widens_with_noise(spark):
    rng = np.random.default_rng(0)
    rows = [
        (b, START + timedelta(hours=h), 20 + rng.normal(0, spread))
        for b, spread in (("calm", 0.5), ("wild", 5.0))
        for h in range(600)
    ]
    coefficients = fit_trend_seasonal(spark.createDataFrame(rows, FRAME)).coefficients
    sigma = {r.building_id: r.sigma for r in coefficients.collect()}
    assert sigma["calm"] == pytest.approx(0.5, rel=0.2)
    assert sigma["wild"] == pytest.approx(5.0, rel=0.2)


def test_holiday_effect_is_learned(spark):
    rows = []
    for h in range(40 * 24):
        ts = START + timedelta(hours=h)
        off = int(h // 24 in (5, 11, 17, 26, 33))
        rows.append(("B1", ts, 10.0 + 4.0 * off, off))
    train = spark.createDataFrame(rows, FRAME + ", is_holiday_flag int")
    model = fit_trend_seasonal(train)
    assert model.layout.regressors == ("is_holiday_flag",)
    effect = model.coefficients.first().coefficients[-1]
    assert effect == pytest.approx(4.0, abs=0.2)


def test_auto_season_needs_enough_history(spark):
    params = TrendSeasonalParams(weekly_seasonality="auto")
    short = fit_trend_seasonal(_series(spark, 10 * 24), params).coefficients.first()
    weekly = slice(2 + 25 + 8, 2 + 25 + 8 + 6)
    yearly = slice(2 + 25 + 8 + 6, None)
    assert set(short.coefficients[weekly]) == set(short.coefficients[yearly]) == {0.0}
    long = fit_trend_seasonal(_series(spark, 20 * 24), params).coefficients.first()
    assert any(long.coefficients[weekly])
    assert set(long.coefficients[yearly]) == {0.0}


def test_building_without_model_gets_nulls(spark):
    model = fit_trend_seasonal(_series(spark, 240, levels=(("B1", 20.0),)))
    (row,) = model.forecast(_series(spark, 1, levels=(("new", 1.0),))).collect()
    assert (row.yhat, row.yhat_lower, row.yhat_upper) == (None, None, None)


def test_trend_without_changepoints(spark):
    params = TrendSeasonalParams(
        n_changepoints=0,
        daily_seasonality=False,
        weekly_seasonality=False,
        yearly_seasonality=False,
    )
    rows = [("B1", START + timedelta(hours=h), 3.0 + 0.5 * h) for h in range(100)]
    model = fit_trend_seasonal(spark.createDataFrame(rows, FRAME), params)
    (row,) = model.forecast(_series(spark, 1, 120, (("B1", 0.0),))).collect()
    assert row.yhat == pytest.approx(63.0, abs=0.1)


def test_missing_targets_are_ignored(spark):
    holes = _series(spark, 240).withColumn(
        "consumption_kwh",
        F.when(F.hour("timestamp_hour") == 3, F.lit(float("nan")))
        .when(F.hour("timestamp_hour") == 4, F.lit(None))
        .otherwise(F.col("consumption_kwh")),
    )
    fitted = fit_trend_seasonal(holes).coefficients.collect()
    assert {r.n_obs for r in fitted} == {220}
    assert all(math.isfinite(c) for r in fitted for c in r.coefficients)


def test_empty_training_set_is_an_error(spark):
    with pytest.raises(ValueError, match="no rows to train on"):
        fit_trend_seasonal(spark.createDataFrame([], FRAME))


def test_linear_trend(spark):
    rows = [("B1", START + timedelta(hours=h), 3.0 + 0.5 * h) for h in range(50)]
    origin = (START - datetime(1970, 1, 1)) // timedelta(hours=1)
    row = linear_trend(spark.createDataFrame(rows, FRAME), origin).first()
    assert (row.slope, row.intercept) == (pytest.approx(0.5), pytest.approx(3.0))
    assert row.n_obs == 50


# --- Boosted trees ----------------------------------------------------------------


def _tree_rows(spark, days=7):
    rows = []
    for h in range(days * 24):
        day, hour = divmod(h, 24)
        ts = START + timedelta(hours=h)
        lag = None if day == 0 else 10 + hour * 0.2 + (day - 1) * 1.5
        kwh = 10 + hour * 0.2 + day * 1.5
        rows.append(("B1", ts, kwh, 10.0 + day, hour, ts.weekday(), lag))
    schema = (
        FRAME + ", temperature_c double, hour_of_day int, day_of_week int,"
        " consumption_lag_24h double"
    )
    return spark.createDataFrame(rows, schema).coalesce(1)


INPUTS = ("temperature_c", "hour_of_day", "day_of_week", "consumption_lag_24h")
SMALL = {"xgb_eta": 0.1, "xgb_max_depth": 3, "xgb_num_boost_round": 5}


def test_trees_beat_the_mean_and_repeat(spark):
    train = _tree_rows(spark)
    predictions = []
    for _ in range(2):
        model = fit_boosted_trees(train, INPUTS, BoostedTreeParams.from_mapping(SMALL))
        rows = model.forecast(train).orderBy("timestamp_hour").collect()
        predictions.append([r.yhat for r in rows])
        assert all(r.yhat_lower == r.yhat == r.yhat_upper for r in rows)
    assert predictions[0] == predictions[1]
    actual = [r[0] for r in train.orderBy("timestamp_hour").select("consumption_kwh").collect()]
    mean = sum(actual) / len(actual)
    error = sum((a - p) ** 2 for a, p in zip(actual, predictions[0]))
    assert error < 0.5 * sum((a - mean) ** 2 for a in actual)


@pytest.mark.parametrize(("penalty", "alpha"), [(0.0, 0.0), (1.0, 0.0), (1.0, 30.0), (5.0, 1e6)])
def test_leaves_are_penalised(spark, penalty, alpha):
    """Two rounds of stumps against the same done by hand."""
    params = BoostedTreeParams(
        eta=0.5, max_depth=1, num_boost_round=2, subsample=1.0, colsample_bytree=1.0,
        reg_lambda=penalty, reg_alpha=alpha,
    )
    values = [(h, 10.0 + 3 * (h > 6) - 2 * (h > 15) + 0.01 * h) for h in range(24)]
    rows = [("B1", START + timedelta(hours=h), y, h) for h, y in values]
    train = spark.createDataFrame(rows, FRAME + ", hour_of_day int")
    model = fit_boosted_trees(train, ["hour_of_day"], params)
    found = [r.yhat for r in model.forecast(train).orderBy("timestamp_hour").collect()]
    predicted = [sum(y for _, y in values) / 24] * 24
    for _ in range(2):
        left = [y - p for (_, y), p in zip(values, predicted)]
        cut = max(range(1, 24), key=lambda k: sum(left[:k]) ** 2 / k + sum(left[k:]) ** 2 / (24 - k))
        for part in (range(cut), range(cut, 24)):
            total = sum(left[i] for i in part)
            shrunk = math.copysign(max(abs(total) - alpha, 0) / (len(part) + penalty), total)
            for i in part:
                predicted[i] += 0.5 * shrunk
    assert found == pytest.approx(predicted, abs=1e-9)


def test_stored_rounds_and_sampling_repeat(spark, monkeypatch):
    from hourgrid.models import boosted_trees

    train = _tree_rows(spark)
    params = BoostedTreeParams(max_depth=2, num_boost_round=5, subsample=0.8, colsample_bytree=0.5)
    kept = []
    for rounds in (2, 100):
        monkeypatch.setattr(boosted_trees, "STORED_ROUNDS", rounds)
        kept.append(fit_boosted_trees(train, INPUTS, params).trees)
    assert kept[0] == kept[1]
    assert all({n.feature for n in tree} <= {-1, 0, 1, 2, 3} for tree in kept[0])


def test_trees_need_feature_columns(spark):
    with pytest.raises(ValueError, match="feature_columns"):
        fit_forecaster("XGBoost", _tree_rows(spark))


# --- Choosing, saving, loading ------------------------------------------------------


def test_strategy_names():
    assert model_type_of("Prophet") == "trend_seasonal"
    assert model_type_of("XGBoost") == "boosted_trees"
    with pytest.raises(ValueError, match="Unknown model strategy"):
        model_type_of("Oracle")


@pytest.mark.parametrize(
    ("strategy", "settings"),
    [("Prophet", {"prophet_yearly_seasonality": False}), ("XGBoost", SMALL)],
)
def test_saved_models_forecast_alike(spark, tmp_path, strategy, settings):
    rows = _tree_rows(spark)
    fitted = fit_forecaster(strategy, rows, INPUTS, settings)
    fitted.save(spark, str(tmp_path))
    loaded = load_forecaster(spark, str(tmp_path))
    assert loaded.model_type == fitted.model_type
    assert loaded.target_column == "consumption_kwh"
    pair = [
        [tuple(r) for r in m.forecast(rows).orderBy("timestamp_hour").collect()]
        for m in (fitted, loaded)
    ]
    for one, other in zip(*pair):
        assert list(one[2:]) == [pytest.approx(v, abs=1e-9) for v in other[2:]]


def test_missing_model_is_reported(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_forecaster(spark, str(tmp_path / "nothing"))


def test_parameters():
    params = TrendSeasonalParams.from_mapping({"prophet_changepoint_prior_scale": 0.5})
    assert params.changepoint_prior_scale == 0.5
    assert params.as_strings()["prophet_changepoint_prior_scale"] == "0.5"
    with pytest.raises(ValueError, match="Unknown parameter"):
        TrendSeasonalParams.from_mapping({"prophet_typo": 1})
    with pytest.raises(ValueError, match="given twice"):
        BoostedTreeParams.from_mapping({"eta": 0.1, "xgb_eta": 0.2})
    with pytest.raises(ValueError, match="negative"):
        BoostedTreeParams.from_mapping({"xgb_lambda": -2.0})
    assert BoostedTreeParams.from_mapping({"xgb_lambda": 2.0, "xgb_alpha": 0.5}).reg_alpha == 0.5
    with pytest.raises(ValueError, match="yearly_seasonality"):
        TrendSeasonalParams(yearly_seasonality="sometimes")


def test_layout_survives_json():
    layout = plan_layout(5, 105, TrendSeasonalParams(), ("temperature_c",))
    assert Layout.from_json(layout.to_json()) == layout


def test_workers_do_not_need_the_package():
    """The grouped functions unpickle where the package is not importable."""
    repo = str(Path(__file__).resolve().parents[1])
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "import numpy as np\n"
        "from pyspark import cloudpickle\n"
        "from hourgrid.models import ridge\n"
        "solve = ridge.solver(np.ones(2), np.zeros(2), np.zeros(0))\n"
        "sys.stdout.buffer.write(cloudpickle.dumps((ridge.cross_products(np.zeros(0)), solve)))" % repo
    )
    dumped = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, check=True, cwd="/"
    ).stdout
    loader = "import sys, pickle; f, g = pickle.loads(sys.stdin.buffer.read()); print(callable(f))"
    done = subprocess.run(
        [sys.executable, "-c", loader], input=dumped, capture_output=True, cwd="/"
    )
    assert done.stdout.strip() == b"True", done.stderr
