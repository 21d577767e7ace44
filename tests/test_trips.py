from datetime import date, datetime

from pyspark.sql import types as T

from tierstone.operators import quality
from tierstone.plans import trips
from tierstone.operators.enforce import RESCUED, rescue, split_rescued
from tierstone.sources.trips_csv import BROKEN_LINE, read_trips_csv, read_trips_rescued, trip_schema

DAY = date(2024, 8, 3)


def test_silver_contract_and_metadata(spark):
    raw = spark.createDataFrame(
        [("r1", datetime(2024, 8, 3, 9, 40), datetime(2024, 8, 3, 9, 57), "A", "B", "x")],
        "ride_id string, started_at timestamp, ended_at timestamp, start_station_name string, "
        "end_station_name string, extra_col string")
    out = trips.silver(raw, trips.run_metadata("p1", "r1", "t1", "2024-08-04T01:30:00"))
    assert quality.column_contract(out, trips.SILVER_COLUMNS) == []
    row = out.first()
    assert (row.trip_duration_mins, row.trip_start_date) == (17.0, DAY)
    assert row.metadata == {"pipeline_id": "p1", "run_id": "r1", "task_id": "t1", "processed_timestamp": "2024-08-04T01:30:00"}
    assert quality.missing_map_keys(out, "metadata", trips.METADATA_KEYS).isEmpty()
    assert "metadata" not in trips.silver(raw).columns


def test_daily_summary(spark):
    first, second = date(2023, 12, 31), date(2024, 2, 29)
    df = spark.createDataFrame(
        [("ride-a", first, 4.5), ("ride-b", second, 61.25), ("ride-c", first, 7.25), ("ride-d", first, 0.5), ("ride-e", second, -3.0)],
        "ride_id string, trip_start_date date, trip_duration_mins double")
    rows = {tuple(r) for r in trips.daily_ride_summary(df).collect()}
    assert rows == {(first, 7.25, 0.5, 4.08, 3), (second, 61.25, -3.0, 29.13, 2)}


def test_daily_summary_rounds(spark):
    df = spark.createDataFrame([("7", DAY, 3.3349), ("8", DAY, 5.5)],
                               "ride_id string, trip_start_date date, trip_duration_mins double")
    assert trips.daily_ride_summary(df).first().avg_trip_duration_mins == 4.42


def test_station_performance_keeps_the_null_station(spark):
    df = spark.createDataFrame([("r1", DAY, "Pier", 3.5), ("r2", DAY, "Mill", 12.0), ("r3", DAY, "Pier", 8.0), ("r4", DAY, None, 5.0)],
                               "ride_id string, trip_start_date date, start_station_name string, trip_duration_mins double")
    rows = {tuple(r) for r in trips.daily_station_performance(df).collect()}
    assert rows == {(DAY, "Pier", 5.75, 2), (DAY, "Mill", 12.0, 1), (DAY, None, 5.0, 1)}


def test_csv_is_permissive(spark, tmp_path):
    names = ",".join(trip_schema().fieldNames())
    (tmp_path / "t.csv").write_text(
        f"{names}\nr1,bike,2025-03-01 10:00:00,not a time,A,1,B,2,40.7287,-74.01,40.7,-74.0,member\n")
    row = read_trips_csv(spark, str(tmp_path)).first()
    assert (row.ride_id, row.started_at, row.ended_at, row.start_lat) == ("r1", datetime(2025, 3, 1, 10), None, 40.7287)
    whole = read_trips_csv(spark, str(tmp_path), trip_schema(T.DecimalType())).first()
    assert int(whole.start_lat) == 41


def test_csv_keeps_what_does_not_parse(spark, tmp_path):
    (tmp_path / "one.csv").write_text(
        "ride_id,started_at,start_lat,surplus\nr1,2024-01-01 10:00:00,40.5,x\nr2,soon,north,y\nr3,2024-01-01 10:00:00\n")
    (tmp_path / "two.csv").write_text("start_lat,ride_id\n41.5,r4\n1,r5,too many\n")
    (tmp_path / "empty.csv").write_text("")
    found = {r.ride_id: r for r in read_trips_rescued(spark, str(tmp_path)).collect()}
    assert [f for f in found["r1"].asDict()][:-1] == trip_schema().fieldNames()
    assert (found["r1"].start_lat, found["r1"].started_at, found["r1"][RESCUED]) == (40.5, datetime(2024, 1, 1, 10), None)
    assert (found["r2"].start_lat, found["r2"].started_at, found["r2"][RESCUED]) == (None, None, {"started_at": "soon", "start_lat": "north"})
    assert found["r3"][RESCUED] == {BROKEN_LINE: "r3,2024-01-01 10:00:00"} and found["r4"].start_lat == 41.5
    assert found["r5"][RESCUED] == {BROKEN_LINE: "1,r5,too many"}
    assert read_trips_rescued(spark, str(tmp_path / "none")).count() == 0


def test_rescued_rows_are_split_in_one_pass(spark):
    raw = spark.createDataFrame([("a", "1", 5), ("b", "x", 5), ("c", None, 5)], "k string, n string, m int")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("gone", T.DateType())])
    good, bad = split_rescued(rescue(raw, schema))
    assert good.columns == ["k", "n", "gone"] and sorted(map(tuple, good.collect())) == [("a", 1, None), ("c", None, None)]
    assert [tuple(r) for r in bad.collect()] == [("b", None, None, {"n": "x"})]
