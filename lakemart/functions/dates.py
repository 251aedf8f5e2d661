"""Date keys, ISO weekdays, cursor starts and elapsed time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def date_key(day: Column | str) -> Column:
    """Integer YYYYMMDD."""
    day = F.col(day) if isinstance(day, str) else day
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_key(year: Column | str = "year", month: Column | str = "month") -> Column:
    """Integer YYYYMM01, the key month facts use."""
    year = F.col(year) if isinstance(year, str) else year
    month = F.col(month) if isinstance(month, str) else month
    return year * 10000 + month * 100 + 1


def month_date(year: Column | str = "year", month: Column | str = "month") -> Column:
    """First day of the month."""
    year = F.col(year) if isinstance(year, str) else year
    month = F.col(month) if isinstance(month, str) else month
    return F.make_date(year, month, F.lit(1))


def iso_weekday(day: Column | str) -> Column:
    """Monday 1 … Sunday 7."""
    return F.weekday(day) + 1


def cursor_start(text: Column | str) -> Column:
    """A configured start value, ISO first, month/day/year otherwise; null if neither fits."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit("M/d/yyyy")))


def elapsed_hours(start: Column, end: Column, digits: int = 1) -> Column:
    """Hours from start to end, rounded."""
    seconds = (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)
    return F.round(seconds / F.lit(3600.0), digits)


def time_slice(df: DataFrame, name: str, unit: str = "month") -> Column:
    """The unit of time (``hour``, ``day``, ``month``, ``year``) a column lies in; it never falls as the column rises.

    Text is taken to be ISO times, of which as many characters are used as name the unit. Numbers are seconds.
    """
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.date_trunc(unit, col)
    if isinstance(kind, T.StringType):
        return F.substring(col, 1, _ISO_CHARS[unit])
    if isinstance(kind, T.NumericType):
        return F.floor(col / F.lit(_SECONDS[unit])).cast("long")
    raise TypeError(f"{name} has no order in time: {kind.simpleString()}")


_ISO_CHARS = {"hour": 13, "day": 10, "month": 7, "year": 4}
_SECONDS = {"hour": 3600, "day": 86_400, "month": 30 * 86_400, "year": 365 * 86_400}
