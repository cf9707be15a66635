"""Joining the hourly feeds into the panel."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.clock import as_datetime, moment
from hourgrid.operators import rollup
from hourgrid.schemas import PANEL_COLUMNS, PANEL_PARTITIONS


def with_holiday_flag(hours: DataFrame, calendar: DataFrame) -> DataFrame:
    """Attach the calendar's flag; dates it does not list count as working days.

    The broadcast side holds one row per DATE parsed from a four-digit year, so at
    most 3.66 million small rows whatever the volume of the feeds.
    """
    dates = F.broadcast(calendar.withColumnRenamed("is_holiday_flag", "_holiday"))
    return (
        hours.withColumn("_date", F.to_date("timestamp_hour"))
        .join(dates, F.col("_date") == F.col("event_date"), "left")
        .withColumn("is_holiday_flag", F.coalesce("_holiday", F.lit(0)))
        .drop("_date", "event_date", "_holiday")
    )


def with_date_parts(hours: DataFrame) -> DataFrame:
    ts = F.col("timestamp_hour")
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    return hours.withColumns(parts)


def build_panel(
    consumption: DataFrame, solar: DataFrame, weather: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Raw feeds to panel rows. Consumption decides which hours exist.

    The three roll-ups are hash partitioned by the join key already, so the joins
    add no shuffle, and keys are unique on every side, so no final distinct.
    """
    key = list(rollup.PANEL_KEY)
    joined = (
        rollup.hourly_consumption(consumption)
        .join(rollup.hourly_solar(solar), key, "left")
        .join(rollup.hourly_weather(weather), key, "left")
        .withColumns(
            {
                "consumption_kwh": F.coalesce("consumption_kwh", F.lit(0.0)),
                "solar_kwh": F.coalesce("solar_kwh", F.lit(0.0)),
            }
        )
    )
    flagged = with_holiday_flag(joined, rollup.calendar_daily(calendar))
    return with_date_parts(flagged).select(*PANEL_COLUMNS, *PANEL_PARTITIONS)


def panel_range(
    panel: DataFrame, start: str | date, end: str | date, time: str = "timestamp_hour"
) -> DataFrame:
    """Hours of the days ``start`` to ``end``, both inclusive."""
    after_last = as_datetime(end) + timedelta(days=1)
    return panel.where(
        (F.col(time) >= moment(start)) & (F.col(time) < moment(after_last))
    )
