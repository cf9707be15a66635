"""Raw feeds derived from the generated ``events`` table.

Gives the query catalog realistic raw inputs: same columns and text formats as
the JSON feeds, so the whole ingest path is exercised over the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string"
)
ORDERS_SCHEMA = (
    "o_orderkey bigint, o_orderstatus string, o_orderdate timestamp_ntz,"
    " o_orderpriority string"
)

# How event types and users map to feeds and buildings.
CONSUMPTION_TYPES = ("click", "view", "purchase")
SOLAR_TYPE = "signup"
WEATHER_TYPE = "error"
BUILDINGS = 5


@dataclass(frozen=True)
class RawFeeds:
    consumption: DataFrame
    solar: DataFrame
    weather: DataFrame
    calendar: DataFrame


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")


def _building() -> Column:
    return F.concat(F.lit("B"), (F.col("user_id") % BUILDINGS).cast("string"))


def _timestamp_text() -> Column:
    return F.substring(F.col("ts").cast("string"), 1, 19)


def _weather_values() -> dict[str, Column]:
    return {
        "temp": F.col("value"),
        "ghi": F.col("value") * 10,
        "humidity": F.get_json_object("props", "$.k").try_cast("double"),
    }


def raw_feeds(spark: SparkSession, folder: str) -> RawFeeds:
    events = _events(spark, folder)
    key = [_building().alias("building_id"), _timestamp_text().alias("timestamp_str")]
    day = F.to_date("ts").cast("string").alias("date_partition_col")
    weather = _weather_values()
    return RawFeeds(
        consumption=events.where(F.col("event_type").isin(*CONSUMPTION_TYPES)).select(
            *key, F.col("value").alias("aggregated_kwh"), day
        ),
        solar=events.where(F.col("event_type") == SOLAR_TYPE).select(
            *key, F.col("value").alias("generated_kwh"), day
        ),
        weather=events.where(F.col("event_type") == WEATHER_TYPE).select(
            *key,
            weather["temp"].alias("temp_c"),
            weather["ghi"].alias("ghi"),
            weather["humidity"].alias("humidity_percent"),
            day,
        ),
        calendar=_calendar(events),
    )


def _calendar(events: DataFrame) -> DataFrame:
    weekend = F.dayofweek("date").isin(1, 7)
    return (
        events.select(F.to_date("ts").alias("date"))
        .distinct()
        .select(
            F.col("date").cast("string").alias("date_str"),
            weekend.cast("int").alias("is_holiday"),
            F.when(weekend, "weekend").otherwise("weekday").alias("event_name"),
        )
    )


def raw_weather_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly weather averages in the shape of a forecast feed."""
    weather = _weather_values()
    hour = F.concat(F.substring(F.col("ts").cast("string"), 1, 13), F.lit(":00:00"))
    return (
        _events(spark, folder)
        .where(F.col("event_type") == WEATHER_TYPE)
        .groupBy(_building().alias("building_id"), hour.alias("timestamp_hour_str"))
        .agg(
            F.avg(weather["temp"]).alias("temp_fcst"),
            F.avg(weather["ghi"]).alias("ghi_fcst"),
            F.avg(weather["humidity"]).alias("humidity_fcst"),
        )
    )


def registry_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as registry entries: priority = group, status F = approved."""
    orders = spark.read.schema(ORDERS_SCHEMA).parquet(f"{folder}/orders.parquet")
    return orders.select(
        F.col("o_orderkey").alias("model_package_id"),
        F.col("o_orderpriority").alias("model_package_group"),
        F.when(F.col("o_orderstatus") == "F", "Approved")
        .otherwise("PendingManualApproval")
        .alias("approval_status"),
        F.col("o_orderdate").alias("created_at"),
    )
