"""Service days, shifts, clock texts over 24 hours and local time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.functions.casts import as_column, java_format

SERVICE_DAY_START_HOURS = 4
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def utc_to_local(ts: Column | str, zone: str) -> Column:
    return F.from_utc_timestamp(as_column(ts), zone)


def shift(ts: Column | str, n: Column | int, unit: str) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.timestamp_add(unit.upper(), n.cast("int"), as_column(ts))


def shift_trunc(ts: Column | str, n: Column | int, unit: str, part: str) -> Column:
    return F.date_trunc(part, shift(ts, n, unit))


def service_date(ts: Column | str) -> Column:
    """The operating day, which starts at four in the morning."""
    return shift_trunc(ts, -SERVICE_DAY_START_HOURS, "hour", "day").cast("date")


def _clock_part(c: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, r"^\s*(\d{1,3}):([0-5]?\d):([0-5]?\d)\s*$", group), F.lit("")).try_cast("int")


def clock_seconds(c: Column | str) -> Column:
    """``26:30:00`` -> 95400; NULL if it is no clock text."""
    c = as_column(c)
    return _clock_part(c, 1) * 3600 + _clock_part(c, 2) * 60 + _clock_part(c, 3)


def clock_interval(c: Column | str) -> Column:
    c = as_column(c)
    return F.make_dt_interval(F.lit(0), _clock_part(c, 1), _clock_part(c, 2), _clock_part(c, 3).cast("decimal(18,6)"))


def diff(unit: str, start: Column | str, end: Column | str) -> Column:
    """Whole units from ``start`` to ``end``, both first cut to seconds."""
    a, b = (F.date_trunc("second", as_column(c)) for c in (start, end))
    return F.timestamp_diff(unit.upper(), a, b)


def format_ts(ts: Column | str, posix: str) -> Column:
    return F.date_format(as_column(ts), java_format(posix))


def local_noon(date: Column | str, zone: str) -> Column:
    """Noon of the local date, as a UTC instant."""
    d = as_column(date)
    return F.to_utc_timestamp(F.make_timestamp(F.year(d), F.month(d), F.day(d), F.lit(12), F.lit(0), F.lit(0)), zone)


def service_anchor(date: Column | str, zone: str) -> Column:
    """Twelve hours before local noon: midnight but on days when clocks change."""
    return shift(local_noon(date, zone), -12, "hour")


def today(zone: str, as_of: str | None = None) -> Column:
    return F.lit(as_of).cast("date") if as_of else F.to_date(F.from_utc_timestamp(F.current_timestamp(), zone))


def iso_dow(d: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(as_column(d)) + 1


def time_period(hour: Column, date: Column) -> Column:
    """Part of the day; Saturdays and Sundays are one period."""
    h = lambda a, b: (hour >= a) & (hour < b)
    return F.when(F.weekday(date) >= 5, "Weekend").when(h(4, 7), "Early Morning").when(h(7, 9), "AM Peak").when(h(9, 16), "Midday").when(h(16, 18), "PM Peak").when(h(18, 22), "Evening").otherwise("Late Night")
