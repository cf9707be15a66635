"""What each source day contributes to each hour: sums and counts that add up.

A late record is filed under a later day than its hour. Averages and sums of an hour can
then only be known from all days that hold records of it. So the sums and counts of every
(source day, building, hour) are kept, and an hour's values are merged from them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.clock import parse_hour
from hourgrid.operators.panel import with_date_parts, with_holiday_flag
from hourgrid.schemas import PANEL_COLUMNS, PANEL_PARTITIONS

#: Feed column and the values kept of it, by feed.
_VALUES: Mapping[str, Mapping[str, str]] = {
    "consumption": {"aggregated_kwh": "consumption"},
    "solar": {"generated_kwh": "solar"},
    "weather": {"temp_c": "temperature", "ghi": "irradiance", "humidity_percent": "humidity"},
}
KEY = ("source_day", "building_id", "timestamp_hour")
NAMES = tuple(name for columns in _VALUES.values() for name in columns.values())
ADDED = tuple(f"{name}_{part}" for name in NAMES for part in ("sum", "n"))
#: Column of a raw feed that holds a line which is no record.
CORRUPT = "_corrupt_line"
PARTITIONS = ("source_day", "hour_day")
SCHEMA = ", ".join(
    [
        "building_id string, timestamp_hour timestamp_ntz, records bigint, rejected bigint",
        *(f"{name}_sum double, {name}_n bigint" for name in NAMES),
        "source_day string, hour_day date",
    ]
)


def _rows(raw: DataFrame, feed: str) -> DataFrame:
    """A feed's rows with the values of all feeds, its own filled in.

    A line that is no record (``CORRUPT``, where the feed has that column) has no key and
    no values; it only counts as rejected.
    """
    own = {name: column for column, name in _VALUES[feed].items()}
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    return raw.select(
        F.col("date_partition_col").alias("source_day"),
        F.when(~bad, F.col("building_id")).alias("building_id"),
        F.when(~bad, parse_hour("timestamp_str")).alias("timestamp_hour"),
        F.when(bad, 0).otherwise(int(feed == "consumption")).alias("_records"),
        bad.cast("int").alias("_rejected"),
        *(
            (F.when(~bad, F.col(own[name])) if name in own else F.lit(None)).cast("double").alias(name)
            for name in NAMES
        ),
    )


def contributions(consumption: DataFrame, solar: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per source day, building and hour, partitioned by source day and hour day.

    The feeds are unioned before they are aggregated: one shuffle of partial sums.
    ``records`` counts consumption records, values or not: they decide which hours exist.
    ``rejected`` counts lines that are no records, in the same pass.
    """
    rows = _rows(consumption, "consumption")
    for feed, raw in (("solar", solar), ("weather", weather)):
        rows = rows.unionByName(_rows(raw, feed))
    added: list[Column] = []
    for name in NAMES:
        added += [F.sum(name).alias(f"{name}_sum"), F.count(name).alias(f"{name}_n")]
    summed = rows.groupBy(*KEY).agg(
        F.sum("_records").alias("records"), F.sum("_rejected").alias("rejected"), *added
    )
    day = F.to_date("timestamp_hour").alias("hour_day")
    return summed.select(
        "building_id", "timestamp_hour", "records", "rejected", *ADDED, "source_day", day
    )


def merged_hours(kept: DataFrame) -> DataFrame:
    """Hours with their values, from the contributions of all source days."""
    totals = kept.groupBy("building_id", "timestamp_hour").agg(
        F.sum("records").alias("records"), *(F.sum(name).alias(name) for name in ADDED)
    )
    # Rows without a key meet no solar or weather rows, as in a join of the feeds.
    keyed = F.col("building_id").isNotNull() & F.col("timestamp_hour").isNotNull()

    def total(name: str) -> Column:
        return F.coalesce(F.col(f"{name}_sum"), F.lit(0.0))

    def mean(name: str) -> Column:
        return F.when(keyed & (F.col(f"{name}_n") > 0), F.col(f"{name}_sum") / F.col(f"{name}_n"))

    return totals.where("records > 0").select(
        "building_id",
        "timestamp_hour",
        total("consumption").alias("consumption_kwh"),
        F.when(keyed, total("solar")).otherwise(0.0).alias("solar_kwh"),
        mean("temperature").alias("temperature_c"),
        mean("irradiance").alias("solar_irradiance_ghi"),
        mean("humidity").alias("humidity"),
    )


def merged_panel(kept: DataFrame, calendar: DataFrame) -> DataFrame:
    """The panel of the hours that ``kept`` holds contributions of; ``calendar`` by date."""
    hours = with_date_parts(with_holiday_flag(merged_hours(kept), calendar))
    return hours.select(*PANEL_COLUMNS, *PANEL_PARTITIONS)
