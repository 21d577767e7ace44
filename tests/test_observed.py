"""Counts taken by the job that writes, not by one of their own."""

import uuid

from pyspark.sql import functions as F

from test_streaming import Lake

from tierstone.operators import merge, quality
from tierstone.operators.merge import classify_upsert, observed_changes, overwrite_table, upsert_metrics
from tierstone.session import scratch_dir
from tierstone.streaming import bronze, silver


def refuse(*_, **__):
    raise AssertionError("counted by another scan")


def test_ingest_counts_while_writing(spark, monkeypatch):
    lake = Lake(spark)
    lake.land([("a", "1", 1, "x"), ("b", "1", 1, "x")])
    lake.land([("c", "1", 1, "x")])
    monkeypatch.setattr(bronze, "_read_folder", refuse)
    assert lake.ingest() == bronze.IngestReport(3, 2)


def test_upserts_count_while_writing_and_again_in_a_replay(spark, monkeypatch):
    lake = Lake(spark)
    lake.land([("a", "1", 1, "x"), ("b", "1", 1, "x")])
    lake.ingest()

    def crash(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(silver, "upsert_metrics", refuse)
    with monkeypatch.context() as broken:
        broken.setattr(silver, "replace_partitions", crash)
        try:
            lake.merge()
        except Exception as error:
            assert "executor lost" in str(error)
    report = lake.merge()
    assert (report.inserted, report.updated, report.unchanged) == (2, 0, 0)


def jobs(spark, action):
    """Spark jobs that an action starts."""
    group = f"observed-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, group)
    action()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_checks_need_no_job_of_their_own(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    checks = [quality.RowCheck("k_is_small", F.col("k") > 1), quality.RowCheck("id_known", F.col("id").isNull(), "warn")]
    root, found = scratch_dir(spark, "observed"), []
    watched = quality.ObservedChecks(df, checks)
    plain = jobs(spark, lambda: overwrite_table(df, f"{root}/a"))
    assert jobs(spark, lambda: (overwrite_table(watched.rows, f"{root}/b"), found.append(watched.seen.get))) == plain
    assert found == [{"rows": 100, "_0": 33, "_1": 0}]
    expected = sorted(map(tuple, quality.run_row_checks(df, checks).collect()))
    assert sorted(map(tuple, watched.report().collect())) == expected


def test_observed_changes_equal_the_metrics(spark):
    target = spark.createDataFrame([("a", "de", 1), ("b", "de", 2)], "k string, country_code string, version int")
    source = spark.createDataFrame([("a", "de", 2), ("b", "de", 2), ("c", "de", 1)], "k string, country_code string, version int")
    changes = classify_upsert(target, source, ["k", "country_code"], "version")
    watched, seen = observed_changes(changes)
    assert watched.count() == 3 and seen.get == upsert_metrics(changes).first().asDict() == {"inserted": 1, "updated": 1, "unchanged": 1}
    assert merge.ACTION in watched.columns
