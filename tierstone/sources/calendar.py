"""Hourly calendar in several time zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.functions.times import VIENNA, hour_key, local_time

# Default range and zones.
FIRST_DAY = "2025-01-01"
LAST_DAY = "2026-12-31"
ZONES = ("UTC", VIENNA)


def hours_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row ``ts_utc`` per UTC hour from the first to the last day's end.

    Days are spread over tasks before they become hours.
    """
    day = F.explode(F.sequence(F.to_date(first), F.to_date(last), F.expr("interval 1 day"))).alias("day")
    hour = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    days = bounds.select(day)
    return days.select("day", hour).select(
        F.make_timestamp(F.year("day"), F.month("day"), F.day("day"), F.col("hour"), F.lit(0), F.lit(0)).alias("ts_utc")
    )


def in_zones(hours: DataFrame, zones: Sequence[str] = ZONES) -> DataFrame:
    """Each UTC hour once per zone, with the local calendar parts.

    ``ts_utc`` keeps the two local hours of a clock change apart; (hour key, zone) is
    not unique there.
    """
    rows = hours.withColumn("timezone", F.explode(F.array(*[F.lit(z) for z in zones])))
    local = None
    key = None
    for z in zones:
        is_zone = F.col("timezone") == z
        here = F.col("ts_utc") if z == "UTC" else local_time("ts_utc", z)
        local = F.when(is_zone, here) if local is None else local.when(is_zone, here)
        key = F.when(is_zone, hour_key("ts_utc", z)) if key is None else key.when(is_zone, hour_key("ts_utc", z))
    rows = rows.withColumn("_local", local)
    return rows.select(
        key.alias("sk_date_time"),
        F.to_date("_local").alias("date"),
        F.hour("_local").cast("tinyint").alias("hour"),
        F.day("_local").cast("tinyint").alias("day"),
        F.month("_local").cast("tinyint").alias("month"),
        F.year("_local").cast("int").alias("year"),
        F.quarter("_local").cast("tinyint").alias("quarter"),
        "timezone",
        "ts_utc",
    )


def hour_spine(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY,
               zones: Sequence[str] = ZONES) -> DataFrame:
    return in_zones(hours_between(spark.range(1), F.lit(first), F.lit(last)), zones)


def distinct_hours(calendar: DataFrame, zone: str = VIENNA) -> DataFrame:
    """One row per local hour of a zone: the join side for fact tables."""
    rows = calendar.filter(F.col("timezone") == zone)
    return rows.drop("ts_utc", "timezone").dropDuplicates(["sk_date_time"])
