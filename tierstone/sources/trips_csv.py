"""CSV landing of bike trips."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.operators.enforce import RESCUED, rescue
from tierstone.sources.tables import file_paths, first_line

# Columns of the trip files, all nullable. Coordinates are doubles; pass
# another schema to read them as the whole-number decimals some tables declare.
_COLUMNS = {
    "ride_id": T.StringType(),
    "rideable_type": T.StringType(),
    "started_at": T.TimestampType(),
    "ended_at": T.TimestampType(),
    "start_station_name": T.StringType(),
    "start_station_id": T.StringType(),
    "end_station_name": T.StringType(),
    "end_station_id": T.StringType(),
    "start_lat": T.DoubleType(),
    "start_lng": T.DoubleType(),
    "end_lat": T.DoubleType(),
    "end_lng": T.DoubleType(),
    "member_casual": T.StringType(),
}
COORDINATES = ("start_lat", "start_lng", "end_lat", "end_lng")


def trip_schema(coordinate: T.DataType | None = None) -> T.StructType:
    return T.StructType([
        T.StructField(name, coordinate if coordinate is not None and name in COORDINATES else kind)
        for name, kind in _COLUMNS.items()
    ])


def read_trips_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   header: bool = True) -> DataFrame:
    """Trips with a fixed schema; a value that does not parse becomes NULL."""
    return spark.read.schema(schema or trip_schema()).csv(path, header=header)


# Key of the rescue map for lines that do not have one value for each column.
BROKEN_LINE = "_line"


def headers(spark: SparkSession, path: str, threads: int = 32) -> dict[tuple[str, ...], list[str]]:
    """The files of a landing by their header; only first lines are read."""
    files = file_paths(spark, path, ".csv")
    with ThreadPoolExecutor(threads) as pool:
        lines = list(pool.map(lambda file: first_line(spark, file), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line:
            found.setdefault(tuple(next(csv.reader([line]))), []).append(file)
    return found


def read_trips_rescued(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Trips by the column names of each file's header, in any order, with the raw text of what does not parse.

    Columns that a file lacks are NULL, unknown ones are left out. ``_rescued`` maps a column
    to the text that did not convert, and ``_line`` to a line with too few or too many values.
    """
    schema, parts = schema or trip_schema(), []
    for names, files in sorted(headers(spark, path).items()):
        text = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(BROKEN_LINE, T.StringType())])
        rows = spark.read.schema(text).option("columnNameOfCorruptRecord", BROKEN_LINE).option("columnPruning", False).csv(
            files, header=True, enforceSchema=False)
        broken = F.when(F.col(BROKEN_LINE).isNotNull(), F.create_map(F.lit(BROKEN_LINE), F.col(BROKEN_LINE)))
        parts.append(rescue(rows.withColumn(RESCUED, broken), schema))
    if not parts:
        empty = T.StructType([*schema.fields, T.StructField(RESCUED, T.MapType(T.StringType(), T.StringType()))])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, parts)
