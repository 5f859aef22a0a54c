"""Column functions on dates, plus plan-time calendar helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def local_solar_ts(date: Column, hhmm: Column, lon: Column) -> Column:
    """UTC date and time moved by whole hours of longitude; ties go to the even hour."""
    hours = F.substring(hhmm, 1, 2).cast("int") + F.rint(lon / 15.0).cast("int")
    minutes = F.substring(hhmm, 3, 2).cast("int")
    return date.cast("timestamp") + F.make_dt_interval(F.lit(0), hours, minutes, F.lit(0).cast("decimal(18,6)"))


def yyyyddd_to_date(text: Column) -> Column:
    """``2026100`` -> 2026-04-10."""
    return F.to_date(text.cast("string"), "yyyyDDD")


def date_to_yyyyddd(date: Column) -> Column:
    return F.date_format(date, "yyyyDDD")


def doy(date: Column) -> Column:
    return F.dayofyear(date)


def days_in_year(date: Column) -> Column:
    return F.dayofyear(F.make_date(F.year(date), F.lit(12), F.lit(31)))


def days_since(date: Column, epoch: str = "1990-01-01") -> Column:
    return F.datediff(date, F.lit(epoch).cast("date"))


def yyyymmdd(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def month_count(start: Column, end: Column) -> Column:
    """Number of calendar months touched by [start, end]."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start) + 1


def local_hour(hour: Column, lon: Column) -> Column:
    """Hour of the local day 0-23 for a UTC hour at a longitude."""
    return F.floor(hour + F.pmod(lon + 360.0, F.lit(360.0)) / 15.0).cast("int") % 24


def snap_months(start: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    """Shrink a period to whole months; a period that holds none is an error."""
    first = start if start.day == 1 else (start.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    last = end if (end + dt.timedelta(days=1)).day == 1 else end.replace(day=1) - dt.timedelta(days=1)
    if last < first:
        raise ValueError(f"no whole month between {start} and {end}")
    return first, last


def parse_years(spec: str) -> list[int]:
    """``2002-2004`` or ``2002,2005`` (or a mix) -> list of years."""
    years: list[int] = []
    for part in spec.split(","):
        lo, _, hi = part.strip().partition("-")
        years.extend(range(int(lo), int(hi or lo) + 1))
    return years
