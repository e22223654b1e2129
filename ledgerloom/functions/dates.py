"""Date arithmetic with the warehouse's meaning.

YEAR and MONTH differences count calendar boundaries (31 Dec to 1 Jan is one year); hour differences
count whole elapsed hours. Timestamps are wall-clock (``timestamp_ntz``), so no result depends on the
session time zone. Differences and date parts are bigint, the warehouse's only integer.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.config import BUSINESS_ZONE


def date_lit(d: date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def ts_lit(ts: datetime | str) -> Column:
    text = ts if isinstance(ts, str) else ts.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def calendar_years(end: Column, start: Column) -> Column:
    return (F.year(end) - F.year(start)).cast("bigint")


def calendar_months(end: Column, start: Column) -> Column:
    return calendar_years(end, start) * 12 + F.month(end) - F.month(start)


def whole_hours(end: Column, start: Column) -> Column:
    return F.timestamp_diff("HOUR", start, end)


def date_part(field: str, c: Column) -> Column:
    """A calendar or clock field as a number; DAYOFWEEK numbers Sunday as 1."""
    return F.date_part(F.lit(field), c).cast("bigint")


def is_business_day(d: Column) -> Column:
    """Monday to Friday; there is no holiday calendar. ``dayofweek`` numbers Sunday as 1."""
    return ~F.dayofweek(d).isin(1, 7)


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def partition_key(d: Column, granularity: str = "MONTH") -> Column:
    """Integer partition value of a date: yyyymm by month, yyyymmdd by day."""
    month = F.year(d) * 100 + F.month(d)
    if granularity == "MONTH":
        return month
    if granularity == "DAY":
        return month * 100 + F.dayofmonth(d)
    raise ValueError(f"unknown partition granularity {granularity!r}; use MONTH or DAY")


def to_business_time(ts: Column) -> Column:
    """UTC wall time to the bank's wall time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(BUSINESS_ZONE), ts)
