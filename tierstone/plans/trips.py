"""Bike trips: bronze, silver, daily gold tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.functions.times import with_date, with_duration_minutes
from tierstone.sources.trips_csv import read_trips_csv, read_trips_rescued

# Silver contract and run-metadata keys.
SILVER_COLUMNS = (
    "ride_id", "trip_start_date", "started_at", "ended_at",
    "start_station_name", "end_station_name", "trip_duration_mins", "metadata",
)
METADATA_KEYS = ("pipeline_id", "run_id", "task_id", "processed_timestamp")


def run_metadata(pipeline_id: str, run_id: str, task_id: str, processed: datetime | str,
                 time_key: str = "processed_timestamp") -> Column:
    """The run's identity as a map column."""
    values = {"pipeline_id": pipeline_id, "run_id": run_id, "task_id": task_id, time_key: str(processed)}
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.create_map(*pairs)


def bronze(spark: SparkSession, path: str, metadata: Column | None = None,
           schema: T.StructType | None = None, rescued: bool = False) -> DataFrame:
    """Trips as landed; ``rescued`` keeps the raw text of values that do not parse, and reads columns by their names."""
    rows = read_trips_rescued(spark, path, schema) if rescued else read_trips_csv(spark, path, schema)
    return rows if metadata is None else rows.withColumn("metadata", metadata)


def silver(trips: DataFrame, metadata: Column | None = None) -> DataFrame:
    """Duration, start date and the contract columns; ``metadata`` only where given."""
    rows = with_duration_minutes(trips, "started_at", "ended_at", "trip_duration_mins")
    rows = with_date(rows, "started_at", "trip_start_date")
    columns = list(SILVER_COLUMNS)
    if metadata is None:
        columns.remove("metadata")
    else:
        rows = rows.withColumn("metadata", metadata)
    return rows.select(*columns)


def _rounded(measure: Column) -> Column:
    return F.round(measure, 2)


def daily_ride_summary(trips: DataFrame) -> DataFrame:
    minutes = "trip_duration_mins"
    return trips.groupBy("trip_start_date").agg(
        _rounded(F.max(minutes)).alias("max_trip_duration_mins"),
        _rounded(F.min(minutes)).alias("min_trip_duration_mins"),
        _rounded(F.avg(minutes)).alias("avg_trip_duration_mins"),
        F.count("ride_id").alias("total_trips"),
    )


def daily_station_performance(trips: DataFrame) -> DataFrame:
    return trips.groupBy("trip_start_date", "start_station_name").agg(
        _rounded(F.avg("trip_duration_mins")).alias("avg_trip_duration_mins"),
        F.count("ride_id").alias("total_trips"),
    )
