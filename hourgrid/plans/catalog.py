"""Named queries over the generated tables, one per operator.

Every query reads whole tables and is checked against ``oracle.SQL`` under the
same key. Doubles are rounded to six decimals so that summation order does not
matter; means of two-decimal inputs often fall exactly between two roundings, so a
tiny nudge, far below the last digit kept, settles those on both sides alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.config import (
    INFERENCE_COLUMNS,
    FeatureSpec,
    QualityThresholds,
    TrendSeasonalParams,
)
from hourgrid.functions.clock import as_datetime, hour_index_of
from hourgrid.models.store import Forecaster, fit_forecaster, load_forecaster
from hourgrid.models.trend_seasonal import fit_trend_seasonal, linear_trend
from hourgrid.operators import features as feature_ops
from hourgrid.operators import horizon, metrics, publish, registry, rollup
from hourgrid.operators.panel import build_panel
from hourgrid.operators.panel import panel_range as panel_between
from hourgrid.plans import pipelines
from hourgrid.schemas import FORECAST_COLUMNS, PANEL, REGISTRY
from hourgrid.session import scratch_path
from hourgrid.sources import event_feeds, readers, writers

KEY = ("building_id", "timestamp_hour")

# Ranges of the test scenario. The oracle uses the same constants.
FILTER_START, FILTER_END = "2024-01-10", "2024-01-20"
RANGE_START, RANGE_END = "2024-01-14", "2024-01-27"
TRAIN_START, TRAIN_END, SPLIT = "2024-01-01", "2024-01-31", "2024-01-24"
INFERENCE_START, HORIZON, LOOKBACK = "2024-01-28", 72, 14
TREND_ORIGIN = "2024-01-01"
SERVED_BUILDING = "B1"
TIE_NUDGE = 2.5e-10
WHOLE_RANGE = ("2000-01-01", "2099-12-31")
INGEST_RUNS = (
    ("2024-01-11", "2024-01-20"),
    ("2000-01-01", "2024-01-10"),
    ("2024-01-11", "2024-01-20"),
    ("2024-01-21", "2099-12-31"),
)
LATE_SECONDS, BROKEN_SECOND = 7, "13"
REGISTRY_RUN = {
    "group": "demand-forecaster",
    "run_id": "run-1",
    "created_at": "2024-02-01",
    "commit": "abc123",
    "feature_source": "panel",
    "start": TRAIN_START,
    "end": TRAIN_END,
    "split": SPLIT,
    "model_path": "models/run=run-1",
}
STUMP_SETTINGS = {
    "xgb_eta": 0.5,
    "xgb_max_depth": 1,
    "xgb_num_boost_round": 1,
    "xgb_subsample": 1.0,
    "xgb_colsample_bytree": 1.0,
    "xgb_alpha": 2.0,
}
#: Limits that some buildings pass and others do not.
SPLIT_LIMITS = QualityThresholds(max_mape=500.0, max_rmse=400.5)

# The tree model of the catalog: small enough to fit while checking results.
TREE_INPUTS = tuple(name for name in INFERENCE_COLUMNS if name not in KEY)
TREE_SETTINGS = {"xgb_max_depth": 3, "xgb_num_boost_round": 10}


def _rounded(frame: DataFrame) -> DataFrame:
    doubles = [f.name for f in frame.schema if isinstance(f.dataType, T.DoubleType)]
    return frame.withColumns(
        {name: F.round(F.col(name) + TIE_NUDGE, 6) for name in doubles}
    )


def _panel(spark: SparkSession, folder: str) -> DataFrame:
    feeds = event_feeds.raw_feeds(spark, folder)
    return build_panel(feeds.consumption, feeds.solar, feeds.weather, feeds.calendar)


def _consumption(spark: SparkSession, folder: str) -> DataFrame:
    """Panel hours with their target only: what target-based features need."""
    return rollup.hourly_consumption(event_feeds.raw_feeds(spark, folder).consumption)


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows as a table, for queries that read them more than once."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _stored_panel(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(_panel(spark, folder), "panel")


# --- Ingest -------------------------------------------------------------------


def src_date_filter(spark: SparkSession, folder: str) -> DataFrame:
    raw = event_feeds.raw_feeds(spark, folder).consumption
    return rollup.between_dates(raw, FILTER_START, FILTER_END)


def hourly_consumption(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_consumption(spark, folder))


def hourly_solar(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(rollup.hourly_solar(event_feeds.raw_feeds(spark, folder).solar))


def hourly_weather(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(rollup.hourly_weather(event_feeds.raw_feeds(spark, folder).weather))


def calendar_daily(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.calendar_daily(event_feeds.raw_feeds(spark, folder).calendar)


def building_ids(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.building_ids(_panel(spark, folder))


def panel(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_panel(spark, folder))


def panel_range(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(panel_between(_panel(spark, folder), RANGE_START, RANGE_END))


def panel_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "panel")
    writers.write_panel(_panel(spark, folder), path)
    return _rounded(readers.read_panel(spark, path, RANGE_START, RANGE_END))


def _misfiled(raw: DataFrame) -> DataFrame:
    """The feed with every seventh second's records filed one to three days late."""
    late = F.substring("timestamp_str", 18, 2).cast("int") % LATE_SECONDS
    filed = F.date_add(F.col("date_partition_col").cast("date"), F.when(late == 0, F.col("_late")).otherwise(0))
    rows = raw.withColumn("_late", 1 + F.substring("timestamp_str", 15, 2).cast("int") % 3)
    return rows.withColumn("date_partition_col", filed.cast("string")).drop("_late")


def panel_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Late records, ingested by source days out of order and twice: still the whole panel."""
    feeds = event_feeds.raw_feeds(spark, folder)
    misfiled = [
        _stored(_misfiled(raw), "misfiled") for raw in (feeds.consumption, feeds.solar, feeds.weather)
    ]
    path = scratch_path(spark, "panel")
    for days in INGEST_RUNS:
        own = [rollup.between_dates(raw, *days) for raw in misfiled]
        pipelines.ingest_feeds(*own, feeds.calendar, *days, path)
    return _rounded(spark.read.schema(PANEL).parquet(path))


def _json_ingest(spark: SparkSession, folder: str) -> str:
    """Feeds as JSON files, a part of the consumption lines broken in two, ingested."""
    feeds = event_feeds.raw_feeds(spark, folder)
    base = scratch_path(spark, "feeds")
    paths = []
    for name in ("consumption", "solar", "weather", "calendar"):
        feed = getattr(feeds, name)
        lines = feed.select(F.to_json(F.struct(*feed.columns)).alias("value"))
        if name == "consumption":
            # A line with its day in sight, cut off before its value: it adds to no hour.
            broken = F.when(
                F.substring("timestamp_str", 18, 2) == BROKEN_SECOND,
                F.concat(F.lit('{"date_partition_col":"'), "date_partition_col", F.lit('","aggregated_kwh":')),
            )
            whole = F.to_json(F.struct(*feed.columns))
            lines = feed.select(F.explode(F.array_compact(F.array(whole, broken))).alias("value"))
        lines.write.text(f"{base}/{name}")
        paths.append(f"{base}/{name}")
    path = scratch_path(spark, "panel")
    pipelines.run_ingest(spark, *paths, *WHOLE_RANGE, path)
    return path


def json_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(spark.read.schema(PANEL).parquet(_json_ingest(spark, folder)))


def json_rejects(spark: SparkSession, folder: str) -> DataFrame:
    path = writers.rejects_path(_json_ingest(spark, folder))
    lines = spark.read.schema("feed string, line string, read string, source_day string").parquet(path)
    return lines.groupBy("feed", "source_day").agg(F.count("line").alias("n"))


# --- Features -----------------------------------------------------------------


def time_features(spark: SparkSession, folder: str) -> DataFrame:
    spec = FeatureSpec()
    return feature_ops.feature_table(
        _panel(spark, folder), spec, [*KEY, *spec.time_features]
    )


def interaction_feature(spark: SparkSession, folder: str) -> DataFrame:
    columns = [*KEY, "temp_x_hour"]
    return _rounded(
        feature_ops.feature_table(_panel(spark, folder), FeatureSpec(), columns)
    )


def _windowed(
    frame: DataFrame, spec: FeatureSpec, chosen: Callable[[str], bool]
) -> DataFrame:
    names = [name for name in feature_ops.window_features(spec) if chosen(name)]
    return _rounded(feature_ops.feature_table(frame, spec, [*KEY, *names]))


def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    return _windowed(_stored_panel(spark, folder), FeatureSpec(), lambda name: "_lag_" in name)


def rolling_features(spark: SparkSession, folder: str) -> DataFrame:
    def chosen(name: str) -> bool:
        return name.startswith(("consumption_roll_avg", "consumption_roll_std"))

    hours = _stored(_consumption(spark, folder), "hours")
    return _windowed(hours, FeatureSpec(), chosen)


def rolling_features_full(spark: SparkSession, folder: str) -> DataFrame:
    return _windowed(
        _stored_panel(spark, folder), FeatureSpec(), lambda name: "_roll_" in name
    )


def rolling_time_based(spark: SparkSession, folder: str) -> DataFrame:
    return _windowed(
        _panel(spark, folder), FeatureSpec(mode="hours"), lambda name: "_roll_" in name
    )


def lag_time_based(spark: SparkSession, folder: str) -> DataFrame:
    return _windowed(
        _panel(spark, folder), FeatureSpec(mode="hours"), lambda name: "_lag_" in name
    )


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return feature_ops.training_features(
        _stored_panel(spark, folder), TRAIN_START, TRAIN_END, SPLIT
    )


def train_features(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_labelled(spark, folder))


def train_eval_split(spark: SparkSession, folder: str) -> DataFrame:
    train, evaluation = feature_ops.train_eval_split(
        _stored(_labelled(spark, folder), "features")
    )
    sides = [
        side.select(*KEY, "consumption_kwh", F.lit(name).alias("side"))
        for name, side in (("train", train), ("eval", evaluation))
    ]
    return _rounded(sides[0].unionByName(sides[1]))


def split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return feature_ops.split_sizes(_labelled(spark, folder))


def split_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return feature_ops.split_bounds(_labelled(spark, folder))


# --- Inference ----------------------------------------------------------------


def _inference_inputs(
    spark: SparkSession, folder: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    history = horizon.lookback(_stored_panel(spark, folder), INFERENCE_START, LOOKBACK)
    weather = horizon.hourly_weather_forecast(
        event_feeds.raw_weather_forecast(spark, folder), INFERENCE_START, HORIZON
    )
    calendar = rollup.calendar_daily(event_feeds.raw_feeds(spark, folder).calendar)
    return history, weather, calendar


def future_frame(spark: SparkSession, folder: str) -> DataFrame:
    history = horizon.lookback(_panel(spark, folder), INFERENCE_START, LOOKBACK)
    return horizon.future_frame(history, INFERENCE_START, HORIZON)


def inference_frame(spark: SparkSession, folder: str) -> DataFrame:
    inputs = _inference_inputs(spark, folder)
    return _rounded(horizon.inference_frame(*inputs, INFERENCE_START, HORIZON))


def _inference_features(spark: SparkSession, folder: str) -> DataFrame:
    inputs = _inference_inputs(spark, folder)
    return horizon.inference_features(*inputs, INFERENCE_START, HORIZON)


def inference_features(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_inference_features(spark, folder))


def latest_forecast_hour(spark: SparkSession, folder: str) -> DataFrame:
    return publish.latest_hour(_inference_features(spark, folder).select(*KEY))


# --- Evaluation ---------------------------------------------------------------


def _naive(hours: DataFrame) -> DataFrame:
    """Actuals with yesterday's value as the forecast, bounds at -10 % and +10 %."""
    lagged = feature_ops.feature_table(
        hours, FeatureSpec(), [*KEY, "consumption_kwh", "consumption_lag_24h"]
    )
    yhat = F.col("consumption_lag_24h")
    return lagged.select(
        *KEY,
        "consumption_kwh",
        yhat.alias("yhat"),
        (yhat * 0.9).alias("yhat_lower"),
        (yhat * 1.1).alias("yhat_upper"),
    )


def _naive_scored(spark: SparkSession, folder: str) -> DataFrame:
    actuals = _stored(_consumption(spark, folder), "hours")
    predictions = _naive(actuals).where(F.col("yhat").isNotNull())
    return metrics.match_actuals(actuals, predictions)


def forecast_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.forecast_metrics(_naive_scored(spark, folder)))


def _metrics_by_building(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.forecast_metrics(_naive_scored(spark, folder), by=["building_id"])


def forecast_metrics_by_building(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_metrics_by_building(spark, folder))


def eval_report(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "report")
    scores = metrics.forecast_metrics(_naive_scored(spark, folder))
    writers.write_evaluation_report(metrics.evaluation_report(scores), path)
    stored = readers.read_evaluation_report(spark, path)
    return _rounded(
        stored.select("metrics.*", "num_eval_records", "status", "error_message")
    )


def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.quality_gate(_metrics_by_building(spark, folder)))


# --- Publishing and registry --------------------------------------------------


def _naive_long(spark: SparkSession, folder: str) -> DataFrame:
    hours = _stored(_consumption(spark, folder), "hours")
    return publish.forecast_long(_naive(hours))


def forecast_long(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_naive_long(spark, folder))


def measure_counts(spark: SparkSession, folder: str) -> DataFrame:
    return publish.measure_counts(_naive_long(spark, folder))


def serve_forecast_day(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "measures")
    writers.write_measures(_naive_long(spark, folder), path)
    stored = spark.read.parquet(path)
    return _rounded(publish.serve_forecast(stored, SERVED_BUILDING, INFERENCE_START))


def multi_file_union(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "forecasts")
    hours = _stored(_consumption(spark, folder), "hours")
    forecasts = _stored(_naive(hours).select(*FORECAST_COLUMNS), "naive")
    early = F.col("timestamp_hour") < F.lit(SPLIT).cast("timestamp_ntz")
    forecasts.where(early).write.mode("append").parquet(path)
    forecasts.where(~early).write.mode("append").option("header", "true").csv(path)
    return _rounded(readers.read_forecasts(spark, path))


def latest_approved(spark: SparkSession, folder: str) -> DataFrame:
    return registry.latest_approved(event_feeds.registry_from_orders(spark, folder))


def registry_rows(spark: SparkSession, folder: str) -> DataFrame:
    entries = registry.registry_rows(
        _metrics_by_building(spark, folder),
        hyperparameters={"xgb_eta": "0.1", "xgb_max_depth": "5"},
        **REGISTRY_RUN,
    )
    pairs = F.transform(
        F.map_entries("properties"), lambda e: F.concat(e.key, F.lit("="), e.value)
    )
    return entries.withColumn("properties", F.array_join(F.array_sort(pairs), ";"))


def quality_gate_split(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.quality_gate(_metrics_by_building(spark, folder), SPLIT_LIMITS))


def measures_republish(spark: SparkSession, folder: str) -> DataFrame:
    """Forecasts published twice, the second time later hours doubled: these replace theirs."""
    path = scratch_path(spark, "measures")
    long = _stored(_naive_long(spark, folder), "long")
    writers.write_measures(long, path)
    later = F.col("time") >= F.lit(SPLIT).cast("timestamp_ntz")
    writers.write_measures(long.where(later).withColumn("measure_value", F.col("measure_value") * 2), path)
    return _rounded(spark.read.parquet(path).select("time", "dim_building_id", "measure_name", "measure_value"))


def registry_approved(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs registered, the first approved: its entry leads to its model."""
    path = scratch_path(spark, "registry")
    scores = _stored(_metrics_by_building(spark, folder), "scores")
    for run, day in (("run-1", "2024-02-01"), ("run-2", "2024-02-02")):
        details = REGISTRY_RUN | {"run_id": run, "created_at": day, "model_path": f"models/run={run}"}
        writers.append_registry(registry.registry_rows(scores, **details), path)
    pipelines.run_approval(spark, path, REGISTRY_RUN["group"], "run-1")
    entries = spark.read.schema(REGISTRY).parquet(path)
    return registry.latest_approved(entries).select(
        "model_package_id", "model_package_group", "approval_status", "created_at", "model_path"
    )


# --- Models -------------------------------------------------------------------


def trend_fit(spark: SparkSession, folder: str) -> DataFrame:
    origin = hour_index_of(as_datetime(TREND_ORIGIN))
    return _rounded(linear_trend(_consumption(spark, folder), origin))


def feature_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Both feature sets written by side, over those of a run without evaluation rows, and read."""
    path = scratch_path(spark, "features")
    labelled = _stored(_labelled(spark, folder), "labelled")
    writers.write_feature_sets(labelled.where("split = 'eval'"), path)
    writers.write_feature_sets(labelled.where("split = 'train'"), path)
    writers.write_feature_sets(labelled, path)
    sides = [
        readers.read_features(spark, f"{path}/split={side}").withColumn("split", F.lit(side))
        for side in ("train", "eval")
    ]
    return _rounded(sides[0].unionByName(sides[1]))


def _stump(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Paths of feature sets and of a model of one tree of one split, trained on them."""
    features, model = scratch_path(spark, "features"), scratch_path(spark, "model")
    writers.write_feature_sets(_labelled(spark, folder), features)
    pipelines.run_training(
        spark, "XGBoost", f"{features}/split=train", model, ["hour_of_day"], STUMP_SETTINGS
    )
    return features, model


def train_stump(spark: SparkSession, folder: str) -> DataFrame:
    features, model = _stump(spark, folder)
    evaluation = readers.read_features(spark, f"{features}/split=eval")
    return _rounded(load_forecaster(spark, model).forecast(evaluation))


def train_evaluate(spark: SparkSession, folder: str) -> DataFrame:
    features, model = _stump(spark, folder)
    report = scratch_path(spark, "report")
    stored = pipelines.run_evaluation(spark, model, f"{features}/split=eval", report)
    return _rounded(stored.select("metrics.*", "num_eval_records", "status", "error_message"))


def _line_model(spark: SparkSession, folder: str) -> str:
    """Path of a stored trend model without penalties: a least-squares line per building."""
    train = panel_between(_stored_panel(spark, folder), TRAIN_START, RANGE_END)
    first = hour_index_of(as_datetime(TRAIN_START))
    last = hour_index_of(as_datetime(INFERENCE_START)) - 1
    params = TrendSeasonalParams(
        n_changepoints=0, daily_seasonality=False, weekly_seasonality=False, yearly_seasonality=False, regressors=()
    )
    line = fit_trend_seasonal(train, params, hours=(first, last), trend_prior_scale=float("inf"))
    path = scratch_path(spark, "model")
    Forecaster("trend_seasonal", line, (), "consumption_kwh").save(spark, path)
    return path


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    model = load_forecaster(spark, _line_model(spark, folder))
    return _rounded(model.forecast(_stored_panel(spark, folder)))


def forecast_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Stored features to stored forecasts to the frame that publishing reads."""
    features, forecasts = scratch_path(spark, "horizon"), scratch_path(spark, "forecasts")
    writers.write_features(_inference_features(spark, folder), features)
    pipelines.run_forecast(spark, _line_model(spark, folder), features, forecasts)
    return _rounded(readers.read_forecasts(spark, forecasts))


def forecast_trend_seasonal(spark: SparkSession, folder: str) -> DataFrame:
    train = panel_between(_panel(spark, folder), TRAIN_START, RANGE_END)
    first = hour_index_of(as_datetime(TRAIN_START))
    last = hour_index_of(as_datetime(INFERENCE_START)) - 1
    model = fit_trend_seasonal(train, TrendSeasonalParams(), hours=(first, last))
    return model.forecast(_inference_features(spark, folder))


def forecast_gbt(spark: SparkSession, folder: str) -> DataFrame:
    columns = [*KEY, "consumption_kwh", *TREE_INPUTS]
    labelled = feature_ops.training_features(
        _stored_panel(spark, folder), TRAIN_START, TRAIN_END, SPLIT, columns=columns
    )
    # Boosting passes over its input many times: store it once, as training does.
    path = scratch_path(spark, "features")
    writers.write_feature_sets(labelled, path)
    train = readers.read_features(spark, f"{path}/split=train")
    model = fit_forecaster("XGBoost", train, TREE_INPUTS, TREE_SETTINGS)
    return model.forecast(_inference_features(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        src_date_filter,
        hourly_consumption,
        hourly_solar,
        hourly_weather,
        calendar_daily,
        building_ids,
        panel,
        panel_range,
        panel_roundtrip,
        panel_incremental,
        json_ingest,
        json_rejects,
        time_features,
        interaction_feature,
        lag_features,
        rolling_features,
        rolling_features_full,
        rolling_time_based,
        lag_time_based,
        train_features,
        train_eval_split,
        split_sizes,
        split_bounds,
        future_frame,
        inference_frame,
        inference_features,
        latest_forecast_hour,
        forecast_metrics,
        forecast_metrics_by_building,
        eval_report,
        quality_gate,
        forecast_long,
        measure_counts,
        serve_forecast_day,
        multi_file_union,
        latest_approved,
        registry_rows,
        registry_approved,
        quality_gate_split,
        measures_republish,
        feature_roundtrip,
        trend_fit,
        train_stump,
        train_evaluate,
        model_roundtrip,
        forecast_roundtrip,
        forecast_trend_seasonal,
        forecast_gbt,
    )
}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly consumption with its day-old value and trailing day statistics."""
    columns = [
        *KEY,
        "consumption_kwh",
        "consumption_lag_24h",
        "consumption_roll_avg_24h",
        "consumption_roll_std_24h",
    ]
    hours = _stored(_consumption(spark, folder), "hours")
    return _rounded(feature_ops.feature_table(hours, FeatureSpec(), columns))
