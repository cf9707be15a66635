"""Raw feeds to one row per (building, hour), and one row per calendar date.

Every roll-up is a plain hash aggregate, so each task combines its own rows
before the shuffle: a building that holds a third of the raw rows still sends at
most one partial row per hour and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.clock import parse_date, parse_hour
from hourgrid.functions.numeric import as_flag

PANEL_KEY = ("building_id", "timestamp_hour")


def between_dates(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Both bounds inclusive, on the feed's own date column (prunes partitions)."""
    return raw.where(F.col("date_partition_col").between(start, end))


def _hourly(raw: DataFrame, *aggregates: Column) -> DataFrame:
    # Grouping by the final join key lets the panel joins reuse this shuffle.
    hour = parse_hour("timestamp_str").alias("timestamp_hour")
    return raw.groupBy("building_id", hour).agg(*aggregates)


def hourly_consumption(raw: DataFrame) -> DataFrame:
    return _hourly(raw, F.sum("aggregated_kwh").alias("consumption_kwh"))


def hourly_solar(raw: DataFrame) -> DataFrame:
    return _hourly(raw, F.sum("generated_kwh").alias("solar_kwh"))


def hourly_weather(raw: DataFrame) -> DataFrame:
    return _hourly(
        raw,
        F.avg("temp_c").alias("temperature_c"),
        F.avg("ghi").alias("solar_irradiance_ghi"),
        F.avg("humidity_percent").alias("humidity"),
    )


def calendar_daily(raw: DataFrame) -> DataFrame:
    """One row per date; a date counts as a holiday when any of its events does."""
    return (
        raw.select(
            parse_date("date_str").alias("event_date"),
            as_flag("is_holiday").alias("flag"),
        )
        .where(F.col("event_date").isNotNull())
        .groupBy("event_date")
        .agg(F.max("flag").alias("is_holiday_flag"))
    )


def building_ids(panel: DataFrame) -> DataFrame:
    return panel.select("building_id").distinct()
