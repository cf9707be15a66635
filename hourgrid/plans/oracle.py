"""DuckDB SQL that states each catalog query independently of the operators."""

from __future__ import annotations

from statistics import NormalDist

from hourgrid.plans import catalog as c

# Shared table expressions ------------------------------------------------------

_EVENTS = """
ev AS (
  SELECT 'B' || CAST(user_id % 5 AS VARCHAR) AS building_id,
         date_trunc('hour', ts) AS timestamp_hour,
         CAST(ts AS DATE) AS event_date,
         left(CAST(ts AS VARCHAR), 19) AS timestamp_str,
         event_type, value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events
)"""

_CONSUMPTION = """
consumption AS (
  SELECT building_id, timestamp_hour, sum(value) AS consumption_kwh
  FROM ev WHERE event_type IN ('click', 'view', 'purchase') GROUP BY ALL
)"""

_SOLAR = """
solar AS (
  SELECT building_id, timestamp_hour, sum(value) AS solar_kwh
  FROM ev WHERE event_type = 'signup' GROUP BY ALL
)"""

_WEATHER = """
weather AS (
  SELECT building_id, timestamp_hour, avg(value) AS temperature_c,
         avg(value * 10) AS solar_irradiance_ghi, avg(k) AS humidity
  FROM ev WHERE event_type = 'error' GROUP BY ALL
)"""

_CALENDAR = """
calendar AS (
  SELECT DISTINCT event_date,
         CAST(CASE WHEN dayofweek(event_date) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER)
           AS is_holiday_flag
  FROM ev
)"""

_PANEL = """
panel AS (
  SELECT c.building_id, c.timestamp_hour,
         coalesce(c.consumption_kwh, 0) AS consumption_kwh,
         coalesce(s.solar_kwh, 0) AS solar_kwh,
         w.temperature_c, w.solar_irradiance_ghi, w.humidity,
         coalesce(k.is_holiday_flag, 0) AS is_holiday_flag
  FROM consumption c
  LEFT JOIN solar s USING (building_id, timestamp_hour)
  LEFT JOIN weather w USING (building_id, timestamp_hour)
  LEFT JOIN calendar k ON k.event_date = CAST(c.timestamp_hour AS DATE)
)"""

_FEATURES = f"""
features AS (
  SELECT *, CASE WHEN timestamp_hour < TIMESTAMP '{c.SPLIT}' THEN 'train' ELSE 'eval' END
           AS split
  FROM (
    SELECT building_id, timestamp_hour, consumption_kwh, solar_kwh, temperature_c,
           solar_irradiance_ghi, humidity, is_holiday_flag,
           CAST(hour(timestamp_hour) AS INTEGER) AS hour_of_day,
           CAST(dayofweek(timestamp_hour) + 1 AS INTEGER) AS day_of_week,
           CAST(day(timestamp_hour) AS INTEGER) AS day_of_month,
           CAST(month(timestamp_hour) AS INTEGER) AS month_of_year,
           lag(consumption_kwh, 24) OVER w AS consumption_lag_24h,
           lag(temperature_c, 24) OVER w AS temp_lag_24h,
           avg(consumption_kwh) OVER r AS consumption_roll_avg_24h,
           stddev_samp(consumption_kwh) OVER r AS consumption_roll_std_24h
    FROM panel
    WHERE timestamp_hour >= TIMESTAMP '{c.TRAIN_START}'
      AND timestamp_hour < DATE '{c.TRAIN_END}' + INTERVAL 1 DAY
    WINDOW w AS (PARTITION BY building_id ORDER BY timestamp_hour),
           r AS (PARTITION BY building_id ORDER BY timestamp_hour
                 ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
  )
  WHERE temperature_c IS NOT NULL AND solar_irradiance_ghi IS NOT NULL
    AND humidity IS NOT NULL AND consumption_lag_24h IS NOT NULL
    AND temp_lag_24h IS NOT NULL AND consumption_roll_std_24h IS NOT NULL
)"""

_HISTORY = f"""
history AS (
  SELECT * FROM panel
  WHERE timestamp_hour >= DATE '{c.INFERENCE_START}' - INTERVAL {c.LOOKBACK} DAY
    AND timestamp_hour < TIMESTAMP '{c.INFERENCE_START}'
),
future AS (
  SELECT b.building_id, h.timestamp_hour
  FROM (SELECT DISTINCT building_id FROM history) b,
       (SELECT unnest(generate_series(
          TIMESTAMP '{c.INFERENCE_START}',
          TIMESTAMP '{c.INFERENCE_START}' + INTERVAL {c.HORIZON - 1} HOUR,
          INTERVAL 1 HOUR)) AS timestamp_hour) h
),
frame AS (
  SELECT building_id, timestamp_hour, consumption_kwh, temperature_c,
         solar_irradiance_ghi, humidity, is_holiday_flag
  FROM history
  UNION ALL
  SELECT f.building_id, f.timestamp_hour, CAST(NULL AS DOUBLE), w.temperature_c,
         w.solar_irradiance_ghi, w.humidity, coalesce(k.is_holiday_flag, 0)
  FROM future f
  LEFT JOIN weather w USING (building_id, timestamp_hour)
  LEFT JOIN calendar k ON k.event_date = CAST(f.timestamp_hour AS DATE)
)"""

_INFERENCE = f"""
inference AS (
  SELECT building_id, timestamp_hour, coalesce(temperature_c, 0) AS temperature_c,
         CAST(hour(timestamp_hour) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(timestamp_hour) + 1 AS INTEGER) AS day_of_week,
         coalesce(consumption_lag_24h, 0) AS consumption_lag_24h,
         coalesce(solar_irradiance_ghi, 0) AS solar_irradiance_ghi,
         coalesce(humidity, 0) AS humidity, is_holiday_flag
  FROM (
    SELECT *, lag(consumption_kwh, 24) OVER
             (PARTITION BY building_id ORDER BY timestamp_hour) AS consumption_lag_24h
    FROM frame
  )
  WHERE timestamp_hour >= TIMESTAMP '{c.INFERENCE_START}'
)"""

_NAIVE = """
naive AS (
  SELECT building_id, timestamp_hour, consumption_kwh, yhat,
         yhat * CAST(0.9 AS DOUBLE) AS yhat_lower,
         yhat * CAST(1.1 AS DOUBLE) AS yhat_upper
  FROM (
    SELECT *, lag(consumption_kwh, 24) OVER
             (PARTITION BY building_id ORDER BY timestamp_hour) AS yhat
    FROM consumption
  )
),
errors AS (
  SELECT building_id, abs(consumption_kwh - yhat) AS e, abs(consumption_kwh) AS y
  FROM naive WHERE yhat IS NOT NULL
)"""

_LONG = """
long AS (
  SELECT timestamp_hour AS time, building_id AS dim_building_id,
         'forecast' AS measure_name, yhat AS measure_value FROM naive
  UNION ALL
  SELECT timestamp_hour, building_id, 'forecast_lower', yhat_lower FROM naive
  UNION ALL
  SELECT timestamp_hour, building_id, 'forecast_upper', yhat_upper FROM naive
)"""

_TO_CONSUMPTION = (_EVENTS, _CONSUMPTION)
_TO_PANEL = (_EVENTS, _CONSUMPTION, _SOLAR, _WEATHER, _CALENDAR, _PANEL)
_TO_FEATURES = (*_TO_PANEL, _FEATURES)
_TO_FRAME = (*_TO_PANEL, _HISTORY)
_TO_INFERENCE = (*_TO_FRAME, _INFERENCE)
_TO_NAIVE = (*_TO_CONSUMPTION, _NAIVE)
_TO_LONG = (*_TO_NAIVE, _LONG)


def _sql(tables: tuple[str, ...], body: str) -> str:
    return "WITH " + ",".join(tables) + body


def _round(expression: str) -> str:
    return f"round({expression} + {c.TIE_NUDGE!r}, 6)"


def _rounded(*names: str) -> str:
    return ", ".join(f"{_round(name)} AS {name}" for name in names)


# Query bodies -------------------------------------------------------------------

_PANEL_COLUMNS = "building_id, timestamp_hour, " + _rounded(
    "consumption_kwh", "solar_kwh", "temperature_c", "solar_irradiance_ghi", "humidity"
)
_PANEL_SELECT = f"""
SELECT {_PANEL_COLUMNS}, is_holiday_flag,
       CAST(year(timestamp_hour) AS INTEGER) AS year,
       CAST(month(timestamp_hour) AS INTEGER) AS month,
       CAST(day(timestamp_hour) AS INTEGER) AS day
FROM panel"""
_PANEL_RANGE = f"""{_PANEL_SELECT}
WHERE timestamp_hour >= TIMESTAMP '{c.RANGE_START}'
  AND timestamp_hour < DATE '{c.RANGE_END}' + INTERVAL 1 DAY"""

_LAGS = (
    ("consumption_kwh", "consumption", (24, 48, 168)),
    ("temperature_c", "temp", (24, 48, 168)),
    ("solar_irradiance_ghi", "ghi", (24,)),
)
_SUFFIXES = (
    ("avg", "avg"),
    ("stddev_samp", "std"),
    ("min", "min"),
    ("max", "max"),
)
_ORDERED = "PARTITION BY building_id ORDER BY timestamp_hour"


def _row_lags() -> str:
    items = [
        f"{_round(f'lag({column}, {k}) OVER ({_ORDERED})')} AS {prefix}_lag_{k}h"
        for column, prefix, ks in _LAGS
        for k in ks
    ]
    return f"\nSELECT building_id, timestamp_hour, {', '.join(items)} FROM panel"


def _hour_lags() -> str:
    items, joins = [], []
    for k in (24, 48, 168):
        joins.append(
            f"LEFT JOIN panel p{k} ON p{k}.building_id = p.building_id "
            f"AND p{k}.timestamp_hour = p.timestamp_hour - INTERVAL {k} HOUR"
        )
    for column, prefix, ks in _LAGS:
        items += [f"{_round(f'p{k}.{column}')} AS {prefix}_lag_{k}h" for k in ks]
    return (
        f"\nSELECT p.building_id, p.timestamp_hour, {', '.join(items)} FROM panel p "
        + " ".join(joins)
    )


def _rolling(frame: str, source: str, suffixes, with_temperature: bool) -> str:
    def over(call: str, hours: int) -> str:
        return _round(f"{call} OVER ({_ORDERED} {frame.format(k=hours - 1)})")

    items = [
        f"{over(f'{agg}(consumption_kwh)', k)} AS consumption_roll_{suffix}_{k}h"
        for k in (3, 24, 168)
        for agg, suffix in suffixes
    ]
    if with_temperature:
        items.append(f"{over('avg(temperature_c)', 24)} AS temp_roll_avg_24h")
    return f"\nSELECT building_id, timestamp_hour, {', '.join(items)} FROM {source}"


_ROWS = "ROWS BETWEEN {k} PRECEDING AND CURRENT ROW"
_HOURS = "RANGE BETWEEN INTERVAL {k} HOUR PRECEDING AND CURRENT ROW"

_METRICS = """avg(e) AS mae, sqrt(avg(e * e)) AS rmse,
       CASE WHEN count(*) > 0 THEN
         coalesce(avg(e / nullif(y, 0)) * 100, CAST('inf' AS DOUBLE)) END AS mape,
       count(*) AS n"""
_OVERALL = f"(SELECT {_METRICS} FROM errors)"
_BY_BUILDING = f"(SELECT building_id, {_METRICS} FROM errors GROUP BY building_id)"

_RUN = c.REGISTRY_RUN
_REGISTRY = f"""
SELECT '{_RUN["group"]}/{_RUN["run_id"]}/' || building_id AS model_package_id,
       '{_RUN["group"]}' AS model_package_group, building_id,
       'Training days {_RUN["start"]} .. {_RUN["end"]}; commit {_RUN["commit"]}; '
         || 'features from {_RUN["feature_source"]}; evaluation: Success'
         AS description,
       'PendingManualApproval' AS approval_status, '{_RUN["commit"]}' AS commit_id,
       '{_RUN["model_path"]}' AS model_path, TIMESTAMP '{_RUN["created_at"]}' AS created_at,
       'EvaluationSplitDate={_RUN["split"]};EvaluationStatus=Success'
         || ';Evaluation_mae=' || printf('%.6f', mae)
         || ';Evaluation_mape=' || printf('%.6f', mape)
         || ';Evaluation_rmse=' || printf('%.6f', rmse)
         || ';FeatureSourcePath={_RUN["feature_source"]};GitCommit={_RUN["commit"]}'
         || ';Hyperparameter_xgb_eta=0.1;Hyperparameter_xgb_max_depth=5'
         || ';TrainingEndDate={_RUN["end"]};TrainingStartDate={_RUN["start"]}'
         AS properties
FROM {_BY_BUILDING}"""

_FEATURE_COLUMNS = (
    _PANEL_COLUMNS
    + ", is_holiday_flag, hour_of_day, day_of_week, day_of_month, month_of_year, "
    + _rounded(
        "consumption_lag_24h",
        "temp_lag_24h",
        "consumption_roll_avg_24h",
        "consumption_roll_std_24h",
    )
)

_STUMP = f"""
train AS (
  SELECT hour_of_day, consumption_kwh AS y, avg(consumption_kwh) OVER () AS start
  FROM features WHERE split = 'train'
),
cuts AS (
  SELECT h.hour_of_day AS cut,
         sum(CASE WHEN t.hour_of_day <= h.hour_of_day THEN y - start ELSE 0 END) AS low_sum,
         count(CASE WHEN t.hour_of_day <= h.hour_of_day THEN 1 END) AS low_n,
         sum(CASE WHEN t.hour_of_day > h.hour_of_day THEN y - start ELSE 0 END) AS high_sum,
         count(CASE WHEN t.hour_of_day > h.hour_of_day THEN 1 END) AS high_n,
         min(start) AS start
  FROM (SELECT DISTINCT hour_of_day FROM train) h, train t
  GROUP BY h.hour_of_day
),
stump AS (
  SELECT *, sign(low_sum) * greatest(abs(low_sum) - {c.STUMP_SETTINGS["xgb_alpha"]}, 0) / (low_n + 1) AS low,
         sign(high_sum) * greatest(abs(high_sum) - {c.STUMP_SETTINGS["xgb_alpha"]}, 0) / (high_n + 1) AS high
  FROM cuts WHERE high_n > 0
  ORDER BY low_sum * low_sum / low_n + high_sum * high_sum / high_n DESC LIMIT 1
),
predicted AS (
  SELECT building_id, timestamp_hour, consumption_kwh,
         start + CAST({c.STUMP_SETTINGS["xgb_eta"]} AS DOUBLE)
           * CASE WHEN hour_of_day <= cut THEN low ELSE high END AS yhat
  FROM features, stump WHERE split = 'eval'
),
errors AS (
  SELECT abs(consumption_kwh - yhat) AS e, abs(consumption_kwh) AS y FROM predicted
)"""
_LINE = f"""
line AS (
  SELECT building_id, regr_slope(consumption_kwh, h) AS slope,
         regr_intercept(consumption_kwh, h) AS intercept
  FROM (SELECT *, epoch(timestamp_hour) / 3600 - epoch(TIMESTAMP '{c.TRAIN_START}') / 3600 AS h FROM panel)
  WHERE timestamp_hour >= TIMESTAMP '{c.TRAIN_START}' AND timestamp_hour < TIMESTAMP '{c.INFERENCE_START}'
  GROUP BY building_id
),
spread AS (
  SELECT building_id, sqrt(avg(power(consumption_kwh - intercept - slope * h, 2))) AS sigma
  FROM (SELECT *, epoch(timestamp_hour) / 3600 - epoch(TIMESTAMP '{c.TRAIN_START}') / 3600 AS h FROM panel)
  JOIN line USING (building_id)
  WHERE timestamp_hour >= TIMESTAMP '{c.TRAIN_START}' AND timestamp_hour < TIMESTAMP '{c.INFERENCE_START}'
  GROUP BY building_id
)"""


def _line_over(source: str) -> str:
    # The upper and lower bounds hold 80 % of a normal spread.
    half = NormalDist().inv_cdf(0.9)
    yhat = f"intercept + slope * (epoch(timestamp_hour) - epoch(TIMESTAMP '{c.TRAIN_START}')) / 3600"
    return f"""
SELECT building_id, timestamp_hour, {_round(yhat)} AS yhat,
       {_round(f"({yhat}) - sigma * {half!r}")} AS yhat_lower,
       {_round(f"({yhat}) + sigma * {half!r}")} AS yhat_upper
FROM {source} LEFT JOIN line USING (building_id) LEFT JOIN spread USING (building_id)"""


SQL: dict[str, str] = {
    "src_date_filter": _sql(
        (_EVENTS,),
        f"""
SELECT building_id, timestamp_str, value AS aggregated_kwh,
       CAST(event_date AS VARCHAR) AS date_partition_col
FROM ev WHERE event_type IN ('click', 'view', 'purchase')
  AND event_date BETWEEN DATE '{c.FILTER_START}' AND DATE '{c.FILTER_END}'""",
    ),
    "hourly_consumption": _sql(
        _TO_CONSUMPTION,
        f"\nSELECT building_id, timestamp_hour, {_rounded('consumption_kwh')}"
        " FROM consumption",
    ),
    "hourly_solar": _sql(
        (_EVENTS, _SOLAR),
        f"\nSELECT building_id, timestamp_hour, {_rounded('solar_kwh')} FROM solar",
    ),
    "hourly_weather": _sql(
        (_EVENTS, _WEATHER),
        "\nSELECT building_id, timestamp_hour, "
        + _rounded("temperature_c", "solar_irradiance_ghi", "humidity")
        + " FROM weather",
    ),
    "calendar_daily": _sql((_EVENTS, _CALENDAR), "\nSELECT * FROM calendar"),
    "building_ids": _sql(_TO_PANEL, "\nSELECT DISTINCT building_id FROM panel"),
    "panel": _sql(_TO_PANEL, _PANEL_SELECT),
    "panel_range": _sql(_TO_PANEL, _PANEL_RANGE),
    "panel_roundtrip": _sql(_TO_PANEL, _PANEL_RANGE),
    "panel_incremental": _sql(_TO_PANEL, _PANEL_SELECT),
    "json_ingest": _sql(_TO_PANEL, _PANEL_SELECT),
    "json_rejects": _sql(
        (_EVENTS,),
        f"""
SELECT 'consumption' AS feed, CAST(event_date AS VARCHAR) AS source_day, count(*) AS n
FROM ev WHERE event_type IN ('click', 'view', 'purchase')
  AND substr(timestamp_str, 18, 2) = '{c.BROKEN_SECOND}'
GROUP BY ALL""",
    ),
    "time_features": _sql(
        _TO_PANEL,
        """
SELECT building_id, timestamp_hour,
       CAST(hour(timestamp_hour) AS INTEGER) AS hour_of_day,
       CAST(dayofweek(timestamp_hour) + 1 AS INTEGER) AS day_of_week,
       CAST(day(timestamp_hour) AS INTEGER) AS day_of_month,
       CAST(month(timestamp_hour) AS INTEGER) AS month_of_year,
       CAST(CASE WHEN dayofweek(timestamp_hour) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER)
         AS is_weekend
FROM panel""",
    ),
    "interaction_feature": _sql(
        _TO_PANEL,
        """
SELECT building_id, timestamp_hour,
       {temp_x_hour} AS temp_x_hour
FROM panel""".format(temp_x_hour=_round("temperature_c * hour(timestamp_hour)")),
    ),
    "lag_features": _sql(_TO_PANEL, _row_lags()),
    "rolling_features": _sql(
        _TO_CONSUMPTION, _rolling(_ROWS, "consumption", _SUFFIXES[:2], False)
    ),
    "rolling_features_full": _sql(_TO_PANEL, _rolling(_ROWS, "panel", _SUFFIXES, True)),
    "rolling_time_based": _sql(_TO_PANEL, _rolling(_HOURS, "panel", _SUFFIXES, True)),
    "lag_time_based": _sql(_TO_PANEL, _hour_lags()),
    "train_features": _sql(
        _TO_FEATURES, f"\nSELECT {_FEATURE_COLUMNS}, split FROM features"
    ),
    "train_eval_split": _sql(
        _TO_FEATURES,
        f"""
SELECT building_id, timestamp_hour, {_rounded("consumption_kwh")}, split AS side
FROM features""",
    ),
    "split_sizes": _sql(
        _TO_FEATURES, "\nSELECT split, count(*) AS n FROM features GROUP BY split"
    ),
    "split_bounds": _sql(
        _TO_FEATURES,
        """
SELECT split, min(timestamp_hour) AS first_hour, max(timestamp_hour) AS last_hour
FROM features GROUP BY split""",
    ),
    "future_frame": _sql(_TO_FRAME, "\nSELECT building_id, timestamp_hour FROM future"),
    "inference_frame": _sql(
        _TO_FRAME,
        "\nSELECT building_id, timestamp_hour, is_holiday_flag, "
        + _rounded("consumption_kwh", "temperature_c", "solar_irradiance_ghi", "humidity")
        + " FROM frame",
    ),
    "inference_features": _sql(
        _TO_INFERENCE,
        "\nSELECT building_id, timestamp_hour, hour_of_day, day_of_week, is_holiday_flag, "
        + _rounded(
            "temperature_c", "consumption_lag_24h", "solar_irradiance_ghi", "humidity"
        )
        + " FROM inference",
    ),
    "latest_forecast_hour": _sql(
        _TO_INFERENCE,
        """
SELECT building_id, timestamp_hour FROM inference
ORDER BY timestamp_hour DESC, building_id LIMIT 1""",
    ),
    "forecast_metrics": _sql(
        _TO_NAIVE, f"\nSELECT {_rounded('mae', 'rmse', 'mape')}, n FROM {_OVERALL}"
    ),
    "forecast_metrics_by_building": _sql(
        _TO_NAIVE,
        f"\nSELECT building_id, {_rounded('mae', 'rmse', 'mape')}, n FROM {_BY_BUILDING}",
    ),
    "eval_report": _sql(
        _TO_NAIVE,
        f"""
SELECT {_rounded("mae", "rmse", "mape")}, n AS num_eval_records,
       CASE WHEN n = 0 THEN 'Error' ELSE 'Success' END AS status,
       CASE WHEN n = 0 THEN 'No matching actuals and predictions' END AS error_message
FROM {_OVERALL}""",
    ),
    "quality_gate": _sql(
        _TO_NAIVE,
        f"""
SELECT building_id, {_rounded("mae", "rmse", "mape")}, n,
       coalesce(mape <= 20 AND rmse <= 5, false) AS passed
FROM {_BY_BUILDING}""",
    ),
    "forecast_long": _sql(
        _TO_LONG,
        f"""
SELECT time, dim_building_id, measure_name, {_rounded("measure_value")} FROM long""",
    ),
    "measure_counts": _sql(
        _TO_LONG,
        """
SELECT dim_building_id, count(DISTINCT measure_name) AS n_measures, count(*) AS n_rows
FROM long GROUP BY dim_building_id""",
    ),
    "serve_forecast_day": _sql(
        _TO_LONG,
        f"""
SELECT time, measure_name, {_rounded("measure_value")} FROM long
WHERE dim_building_id = '{c.SERVED_BUILDING}' AND measure_name = 'forecast'
  AND time >= TIMESTAMP '{c.INFERENCE_START}'
  AND time < DATE '{c.INFERENCE_START}' + INTERVAL 1 DAY
ORDER BY time""",
    ),
    "multi_file_union": _sql(
        _TO_NAIVE,
        f"""
SELECT building_id, timestamp_hour, {_rounded("yhat", "yhat_lower", "yhat_upper")}
FROM naive""",
    ),
    "latest_approved": """
SELECT model_package_id, model_package_group, 'Approved' AS approval_status, created_at
FROM (
  SELECT o_orderkey AS model_package_id, o_orderpriority AS model_package_group,
         o_orderdate AS created_at,
         row_number() OVER (PARTITION BY o_orderpriority
                            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderstatus = 'F'
) WHERE rn = 1""",
    "registry_rows": _sql(_TO_NAIVE, _REGISTRY),
    "registry_approved": _sql(
        _TO_NAIVE,
        f"""
SELECT '{_RUN["group"]}/run-1/' || max(building_id) AS model_package_id,
       '{_RUN["group"]}' AS model_package_group, 'Approved' AS approval_status,
       TIMESTAMP '2024-02-01' AS created_at, 'models/run=run-1' AS model_path
FROM {_BY_BUILDING}""",
    ),
    "quality_gate_split": _sql(
        _TO_NAIVE,
        f"""
SELECT building_id, {_rounded("mae", "rmse", "mape")}, n,
       coalesce(mape <= {c.SPLIT_LIMITS.max_mape} AND rmse <= {c.SPLIT_LIMITS.max_rmse}, false) AS passed
FROM {_BY_BUILDING}""",
    ),
    "measures_republish": _sql(
        _TO_LONG,
        f"""
SELECT time, dim_building_id, measure_name,
       {_round(f"measure_value * CASE WHEN time >= TIMESTAMP '{c.SPLIT}' THEN 2 ELSE 1 END")} AS measure_value
FROM long""",
    ),
    "feature_roundtrip": _sql(
        _TO_FEATURES, f"\nSELECT {_FEATURE_COLUMNS}, split FROM features"
    ),
    "train_stump": _sql(
        (*_TO_FEATURES, _STUMP),
        f"""
SELECT building_id, timestamp_hour, {_round("yhat")} AS yhat,
       {_round("yhat")} AS yhat_lower, {_round("yhat")} AS yhat_upper
FROM predicted""",
    ),
    "train_evaluate": _sql(
        (*_TO_FEATURES, _STUMP),
        f"""
SELECT {_rounded("mae", "rmse", "mape")}, n AS num_eval_records, 'Success' AS status,
       CAST(NULL AS VARCHAR) AS error_message
FROM {_OVERALL}""",
    ),
    "model_roundtrip": _sql((*_TO_PANEL, _LINE), _line_over("panel")),
    "forecast_roundtrip": _sql((*_TO_INFERENCE, _LINE), _line_over("inference")),
    "trend_fit": _sql(
        _TO_CONSUMPTION,
        f"""
SELECT building_id,
       {_round("regr_slope(consumption_kwh, h)")} AS slope,
       {_round("regr_intercept(consumption_kwh, h)")} AS intercept,
       count(consumption_kwh) AS n_obs
FROM (
  SELECT *, CAST(date_diff('hour', TIMESTAMP '{c.TREND_ORIGIN}', timestamp_hour) AS DOUBLE)
           AS h
  FROM consumption
) GROUP BY building_id""",
    ),
}
