"""Forecast rows to the long measure table, and reading it back."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.clock import as_datetime, moment

# Measure names of the published table.
MEASURES = {
    "yhat": "forecast",
    "yhat_lower": "forecast_lower",
    "yhat_upper": "forecast_upper",
}


def forecast_long(
    forecasts: DataFrame, measures: Mapping[str, str] = MEASURES
) -> DataFrame:
    """One row per forecast and measure. NULL values stay, NULL keys go."""
    named = forecasts.select(
        F.col("timestamp_hour").cast("timestamp_ntz").alias("time"),
        F.col("building_id").alias("dim_building_id"),
        *[F.col(column).alias(name) for column, name in measures.items()],
    ).dropna(subset=["time", "dim_building_id"])
    return named.unpivot(
        ["time", "dim_building_id"],
        list(measures.values()),
        "measure_name",
        "measure_value",
    )


def measure_counts(long: DataFrame) -> DataFrame:
    return long.groupBy("dim_building_id").agg(
        F.countDistinct("measure_name").alias("n_measures"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def serve_forecast(
    long: DataFrame,
    building_id: str,
    start: str,
    hours: int = 24,
    measure: str = "forecast",
    limit: int | None = None,
) -> DataFrame:
    """One building's measure over ``[start, start + hours)``, earliest first.

    All its hours, unless the caller sets a ``limit``.
    """
    first = as_datetime(start)
    last = first + timedelta(hours=hours)
    rows = long.where(
        (F.col("dim_building_id") == building_id)
        & (F.col("measure_name") == measure)
        & (F.col("time") >= moment(first))
        & (F.col("time") < moment(last))
    )
    if "date" in long.columns:
        # Partition column of the stored table: read only the days asked for.
        bounds = (F.lit(d.date().isoformat()).cast("date") for d in (first, last))
        rows = rows.where(F.col("date").between(*bounds))
    served = rows.select("time", "measure_name", "measure_value").orderBy("time")
    return served if limit is None else served.limit(limit)


def latest_hour(frame: DataFrame, time: str = "timestamp_hour") -> DataFrame:
    """The row with the last hour (ties: first building)."""
    return frame.orderBy(F.col(time).desc(), F.col("building_id")).limit(1)
