"""Incremental scan filters: high-water mark and look-back windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.functions.times import as_of_date, col_of, hour_key_floor


def watermark(target: DataFrame, column: str) -> DataFrame:
    """One row: the largest value loaded so far, NULL where there is none."""
    return target.agg(F.max(column).alias("watermark"))


def above_watermark(source: DataFrame, target: DataFrame, column: str = "updated_at",
                    inclusive: bool = False) -> DataFrame:
    """Source rows newer than anything in the target; all rows if the target has no mark.

    The mark stays a scalar subquery inside the plan, in the bare form Spark pushes to
    the scan; whether there is one is asked beforehand, so a first load has no filter and
    loses neither NULL nor old times. Against a mark NULL times are not newer.
    ``inclusive`` also re-reads rows that tie with the mark, which is safe in front of a
    merge.
    """
    if target.where(F.col(column).isNotNull()).isEmpty():
        return source
    mark = watermark(target, column).scalar()
    return source.filter(F.col(column) >= mark if inclusive else F.col(column) > mark)


def lookback_start(days: int, as_of: Column | date | str | None = None) -> Column:
    """Midnight UTC ``days`` before the run date."""
    return F.date_sub(as_of_date(as_of), days)


def since_lookback(df: DataFrame, ts: str, days: int = 2, as_of: Column | date | str | None = None) -> DataFrame:
    return df.filter(F.col(ts) >= lookback_start(days, as_of).cast("timestamp"))


def in_hour_lookback(key: Column | str, days: int = 2, as_of: Column | date | str | None = None) -> Column:
    """Hour keys of the last ``days`` days: a plain comparison, so it reaches the scan."""
    return col_of(key) >= hour_key_floor(lookback_start(days, as_of))


def since_hour_lookback(df: DataFrame, key: str = "sk_date_time", days: int = 2,
                        as_of: Column | date | str | None = None) -> DataFrame:
    return df.filter(in_hour_lookback(key, days, as_of))
