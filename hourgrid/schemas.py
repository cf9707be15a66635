"""Explicit schemas. Nothing in this package infers a schema from files."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


STRING, DOUBLE, INT = T.StringType(), T.DoubleType(), T.IntegerType()
# Hours are wall-clock values: NTZ keeps every result independent of the session zone.
HOUR = T.TimestampNTZType()

RAW_CONSUMPTION = _struct(
    ("building_id", STRING),
    ("timestamp_str", STRING),
    ("aggregated_kwh", DOUBLE),
    ("date_partition_col", STRING),
)
RAW_SOLAR = _struct(
    ("building_id", STRING),
    ("timestamp_str", STRING),
    ("generated_kwh", DOUBLE),
    ("date_partition_col", STRING),
)
RAW_WEATHER = _struct(
    ("building_id", STRING),
    ("timestamp_str", STRING),
    ("temp_c", DOUBLE),
    ("ghi", DOUBLE),
    ("humidity_percent", DOUBLE),
    ("date_partition_col", STRING),
)
# is_holiday arrives as true/false or 0/1; reading it as text accepts both.
RAW_CALENDAR = _struct(
    ("date_str", STRING),
    ("is_holiday", STRING),
    ("event_name", STRING),
)
WEATHER_FORECAST = _struct(
    ("building_id", STRING),
    ("timestamp_hour_str", STRING),
    ("temp_fcst", DOUBLE),
    ("ghi_fcst", DOUBLE),
    ("humidity_fcst", DOUBLE),
)

PANEL_VALUES = _struct(
    ("building_id", STRING),
    ("timestamp_hour", HOUR),
    ("consumption_kwh", DOUBLE),
    ("solar_kwh", DOUBLE),
    ("temperature_c", DOUBLE),
    ("solar_irradiance_ghi", DOUBLE),
    ("humidity", DOUBLE),
    ("is_holiday_flag", INT),
)
PANEL_PARTITIONS = ("year", "month", "day")
PANEL = T.StructType(
    PANEL_VALUES.fields + [T.StructField(name, INT) for name in PANEL_PARTITIONS]
)
PANEL_COLUMNS = tuple(PANEL_VALUES.fieldNames())

FORECAST = _struct(
    ("building_id", STRING),
    ("timestamp_hour", HOUR),
    ("yhat", DOUBLE),
    ("yhat_lower", DOUBLE),
    ("yhat_upper", DOUBLE),
)
FORECAST_COLUMNS = tuple(FORECAST.fieldNames())

MEASURES = _struct(
    ("time", HOUR),
    ("dim_building_id", STRING),
    ("measure_name", STRING),
    ("measure_value", DOUBLE),
)

EVALUATION_REPORT = T.StructType(
    [
        T.StructField(
            "metrics", _struct(("mae", DOUBLE), ("rmse", DOUBLE), ("mape", DOUBLE))
        ),
        T.StructField("num_eval_records", T.LongType()),
        T.StructField("status", STRING),
        T.StructField("error_message", STRING),
    ]
)

MODEL_METADATA = T.StructType(
    [
        T.StructField("model_type", STRING),
        T.StructField("feature_columns", T.ArrayType(STRING)),
        T.StructField("target_column", STRING),
        T.StructField("layout", STRING),
        T.StructField("feature_spec", STRING),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("model_package_id", STRING),
        T.StructField("model_package_group", STRING),
        T.StructField("building_id", STRING),
        T.StructField("description", STRING),
        T.StructField("approval_status", STRING),
        T.StructField("commit_id", STRING),
        T.StructField("model_path", STRING),
        T.StructField("created_at", HOUR),
        T.StructField("properties", T.MapType(STRING, STRING)),
    ]
)
