"""Wall-clock time on TIMESTAMP_NTZ."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The raw feeds' formats, yyyy-MM-dd HH:mm:ss and yyyy-MM-dd. Day and
# month ranges are left to the cast.
TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} ([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_timestamp(text: Column | str) -> Column:
    """Text to NTZ; malformed text gives NULL.

    Casting straight to NTZ avoids the detour over the session zone, which would
    move hours that a daylight-saving change skips.
    """
    text = _col(text)
    return F.when(text.rlike(TIMESTAMP_SHAPE), text.try_cast("timestamp_ntz"))


def parse_date(text: Column | str) -> Column:
    text = _col(text)
    return F.when(text.rlike(DATE_SHAPE), text.try_cast("date"))


def parse_hour(text: Column | str) -> Column:
    """Text to the start of its hour; malformed text gives NULL.

    Cutting the text before the cast truncates and parses in one step, which is
    what every raw row pays for.
    """
    text = _col(text)
    start = F.concat(F.substring(text, 1, 13), F.lit(":00:00"))
    return F.when(text.rlike(TIMESTAMP_SHAPE), start.try_cast("timestamp_ntz"))


def hour_index(ts: Column | str) -> Column:
    """Whole hours since 1970-01-01 00:00 as BIGINT: the axis for range frames."""
    ts = _col(ts)
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * F.lit(24).cast("bigint") + F.hour(ts)


def hour_index_of(moment: datetime) -> int:
    return int((moment - datetime(1970, 1, 1)) / timedelta(hours=1))


def moment(value: str | date | datetime) -> Column:
    """An NTZ literal; text avoids any conversion through the driver's zone."""
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def as_datetime(value: str | date | datetime) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


CALENDAR_PARTS = {
    "hour_of_day": F.hour,
    "day_of_week": F.dayofweek,  # 1 = Sunday
    "day_of_month": F.dayofmonth,
    "month_of_year": F.month,
    "is_weekend": lambda ts: F.dayofweek(ts).isin(1, 7).cast("int"),
}


def calendar_part(name: str, ts: Column | str) -> Column:
    if name not in CALENDAR_PARTS:
        raise ValueError(f"Unknown time feature: {name}")
    return CALENDAR_PARTS[name](_col(ts))
