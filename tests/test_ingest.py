from __future__ import annotations

from datetime import datetime

import pytest
from frames import calendar, consumption, solar, weather
from pyspark.sql import types as T

from hourgrid import schemas
from hourgrid.operators import rollup
from hourgrid.operators.panel import build_panel


def test_panel_of_one_hour(spark):
    panel = build_panel(
        consumption(
            spark,
            *[("north", f"2025-08-06 09:{m}:30", kwh) for m, kwh in ((10, 4.25), (31, 0.5), (52, 3.0))],
        ),
        solar(spark, ("north", "2025-08-06 09:00:00", 2.5), ("north", "2025-08-06 09:59:59", 0.25)),
        weather(
            spark,
            *[("north", f"2025-08-06 09:{m}:00", t, 2 * t, t + 30) for m, t in (("07", 22.0), (47, 25.0))],
        ),
        calendar(spark, ("2025-08-06", 1, "fair"), ("2025-08-07", 0, "day")),
    )
    (row,) = panel.collect()
    assert row.asDict() == {
        "building_id": "north",
        "timestamp_hour": datetime(2025, 8, 6, 9),
        "consumption_kwh": 7.75,
        "solar_kwh": 2.75,
        "temperature_c": 23.5,
        "solar_irradiance_ghi": 47.0,
        "humidity": 53.5,
        "is_holiday_flag": 1,
        "year": 2025,
        "month": 8,
        "day": 6,
    }
    assert [(f.name, f.dataType) for f in panel.schema] == [
        (f.name, f.dataType) for f in schemas.PANEL
    ]
    required = {f.name for f in panel.schema if not f.nullable}
    assert {"consumption_kwh", "solar_kwh", "is_holiday_flag"} <= required


def test_missing_sources_leave_defaults(spark):
    panel = build_panel(
        consumption(spark, ("north", "2025-08-06 22:40:00", 0.75)),
        solar(spark),
        weather(spark, ("north", "2025-08-06 22:05:00", -3.5, 0.0, 81.0)),
        calendar(spark),
    )
    (row,) = panel.collect()
    assert (row.solar_kwh, row.temperature_c, row.is_holiday_flag) == (0.0, -3.5, 0)


def test_two_events_on_a_date_keep_one_row_per_hour(spark):
    panel = build_panel(
        consumption(spark, ("B1", "2025-08-10 14:15:00", 1.5)),
        solar(spark),
        weather(spark),
        calendar(spark, ("2025-08-10", 0, "sale"), ("2025-08-10", 1, "holiday")),
    )
    (row,) = panel.collect()
    assert row.is_holiday_flag == 1


def test_hours_without_consumption_do_not_appear(spark):
    panel = build_panel(
        consumption(spark, ("B1", "2025-08-10 14:15:00", None)),
        solar(spark, ("B1", "2025-08-10 20:00:00", 3.0)),
        weather(spark),
        calendar(spark),
    )
    (row,) = panel.collect()
    assert (row.timestamp_hour.hour, row.consumption_kwh) == (14, 0.0)


@pytest.mark.parametrize(
    ("text", "hour"),
    [
        ("2025-08-10 14:59:59", datetime(2025, 8, 10, 14)),
        ("2025-02-30 14:00:00", None),
        ("2025-08-10 24:00:00", None),
        ("2025-08-10 14:60:00", None),
        ("2025-08-10T14:00:00", None),
        ("2025-8-10 14:00:00", None),
        ("yesterday", None),
        (None, None),
    ],
)
def test_malformed_timestamps_become_null(spark, text, hour):
    raw = spark.createDataFrame([("B1", text, 1.0, "2025-08-10")], schemas.RAW_CONSUMPTION)
    (row,) = rollup.hourly_consumption(raw).collect()
    assert row.timestamp_hour == hour


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Paris"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    # 02:30 does not exist in New York on 2025-03-09, nor in Paris on 2025-03-30;
    # 01:30 occurs twice there in autumn.
    stamps = ["2025-03-09 02:30:00", "2025-03-30 02:30:00", "2025-11-02 01:30:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = consumption(spark, *[("B1", s, 1.0) for s in stamps])
        hours = {
            r.h
            for r in rollup.hourly_consumption(raw)
            .selectExpr("cast(timestamp_hour as string) h")
            .collect()
        }
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert hours == {s[:13] + ":00:00" for s in stamps}


@pytest.mark.parametrize(
    ("kind", "value"),
    [
        (T.BooleanType(), True),
        (T.IntegerType(), 1),
        (T.StringType(), "true"),
        (T.StringType(), "1"),
    ],
)
def test_holiday_flag_types(spark, kind, value):
    schema = T.StructType(
        [
            T.StructField("date_str", T.StringType()),
            T.StructField("is_holiday", kind),
            T.StructField("event_name", T.StringType()),
        ]
    )
    raw = spark.createDataFrame([("2025-08-10", value, "x")], schema)
    (row,) = rollup.calendar_daily(raw).collect()
    assert row.is_holiday_flag == 1


def test_date_filter_is_inclusive(spark):
    raw = consumption(
        spark, *[("B1", f"2025-08-{d:02d} 10:00:00", 1.0) for d in range(8, 13)]
    )
    kept = rollup.between_dates(raw, "2025-08-09", "2025-08-11")
    assert {r.date_partition_col[-2:] for r in kept.collect()} == {"09", "10", "11"}


def test_result_does_not_change_with_partitioning(spark):
    rows = [
        (f"B{i % 3}", f"2025-08-{1 + i % 9:02d} {i % 24:02d}:15:00", float(i))
        for i in range(600)
    ]
    results = []
    for parts in (1, 7):
        hours = rollup.hourly_consumption(consumption(spark, *rows).repartition(parts))
        results.append(sorted(map(tuple, hours.collect())))
    assert results[0] == results[1]
