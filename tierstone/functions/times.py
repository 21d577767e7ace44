"""Time expressions: Column in, Column out."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIENNA = "Europe/Vienna"

# Sentinels and output format of the gold models.
OPEN_END = "9999-12-31"
LAST_REAL_YEAR = 9999
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'.000Z'"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of: Column | date | str | None) -> Column:
    """The run date: a literal when given (so that it folds and is pushed), else today."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def as_of_timestamp(as_of: Column | datetime | str | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")


def open_end() -> Column:
    """``valid_to`` of a current history row."""
    return F.lit(OPEN_END).cast("timestamp")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds between two timestamps, in minutes; negative when reversed."""
    return (F.unix_timestamp(col_of(end)) - F.unix_timestamp(col_of(start))) / 60


def with_duration_minutes(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    return df.withColumn(out, minutes_between(start, end))


def with_date(df: DataFrame, ts: str, out: str) -> DataFrame:
    return df.withColumn(out, F.to_date(ts))


def local_time(ts: Column | str, zone: str = VIENNA) -> Column:
    """UTC instant to the wall clock of ``zone``, daylight saving included."""
    return F.from_utc_timestamp(col_of(ts).cast("timestamp"), zone)


def hour_key(ts: Column | str, zone: str = VIENNA) -> Column:
    """``YYYYMMDDHH`` of the local hour, as an int."""
    local = local_time(ts, zone) if zone != "UTC" else col_of(ts)
    parts = ((F.year, 1_000_000), (F.month, 10_000), (F.day, 100), (F.hour, 1))
    total = None
    for part, weight in parts:
        term = part(local) * F.lit(weight)
        total = term if total is None else total + term
    return total.cast("int")


def hour_key_floor(day: Column) -> Column:
    """Smallest hour key of a date; comparing against it keeps the key column bare."""
    return (F.year(day) * 1_000_000 + F.month(day) * 10_000 + F.day(day) * 100).cast("int")


def hour_key_date(key: Column | str) -> Column:
    return F.to_date(F.floor(col_of(key) / 100).cast("string"), "yyyyMMdd")


def iso_utc(ts: Column | str) -> Column:
    return F.date_format(col_of(ts), ISO_UTC)


def null_if_sentinel(ts: Column | str) -> Column:
    """NULL for far-future placeholder dates."""
    c = col_of(ts)
    return F.when(F.year(c) <= LAST_REAL_YEAR, c)
