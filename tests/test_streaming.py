"""Landing, bronze and silver: replays, new files, new columns, crashes."""

import os
import pathlib
import shutil
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tierstone.contracts import contract
from tierstone.session import scratch_dir
from tierstone.sources.tables import child_names, has_files, is_complete
from tierstone.streaming import bronze, silver

SPEC = contract("ig_player_tag")
TABLE = "ig_player_tag"


class Lake:
    def __init__(self, spark):
        self.spark, self.root = spark, scratch_dir(spark, "test-stream")
        self.silver = f"{self.root}/silver/{TABLE}"

    def landing(self, country="de"):
        return bronze.landing_dir(f"{self.root}/landing", country, TABLE)

    def land(self, rows, country="de", **extra):
        df = self.spark.createDataFrame(rows, "tag_id string, version string, is_active int, tag_category string")
        df.withColumns({k: F.lit(v) for k, v in extra.items()}).coalesce(1).write.mode("append").parquet(self.landing(country))

    def bronze(self, country="de"):
        return bronze.bronze_dir(f"{self.root}/bronze", country, TABLE)

    def mark(self, layer, country="de"):
        return f"{self.root}/checkpoints/{layer}/{country}"

    def ingest(self, country="de"):
        return bronze.ingest(self.spark, country, self.landing(country), self.bronze(country), self.mark("bronze", country))

    def merge(self, country="de", **how):
        return silver.upsert_stream(self.spark, SPEC, country, self.bronze(country), self.mark("bronze", country),
                                    self.silver, self.mark("silver", country), now="2024-01-01 00:00:00", **how)

    def rows(self):
        df = silver.read_silver(self.spark, self.silver, SPEC)
        assert df.columns == [*SPEC.schema.fieldNames(), silver.AUDIT_COLUMN]
        return sorted((r.tag_id, r.country_code, r.version, r.tag_category) for r in df.collect())


@pytest.fixture()
def lake(spark):
    return Lake(spark)


def test_empty_source_is_a_no_op(lake, spark):
    assert lake.ingest() == bronze.IngestReport(0, 0)
    assert not has_files(spark, lake.landing())
    assert lake.merge().batches == []
    assert lake.rows() == []


def test_drain_idle_new_file_new_column(lake, spark):
    lake.land([("a", "1", 1, "x"), ("b", "1", 1, "x")])
    assert lake.ingest() == bronze.IngestReport(2, 1)
    assert lake.ingest() == bronze.IngestReport(0, 0)
    lake.land([("c", "1", 1, "x")], tag_creator_id="late column")
    assert lake.ingest() == bronze.IngestReport(1, 1)
    rows = bronze.read_bronze(spark, lake.bronze(), lake.mark("bronze"))
    got = {r.tag_id: r for r in rows.collect()}
    future = datetime.now(timezone.utc) + timedelta(days=1)
    assert bronze.read_bronze(spark, lake.bronze(), lake.mark("bronze"), future).isEmpty(), "old files are not opened"
    assert (got["a"].tag_creator_id, got["c"].tag_creator_id) == (None, "late column")
    assert got["a"].country_code == "de" and got["a"].input_file_name.endswith(".parquet") and got["a"].bronze_inserted_at


def test_versions_across_batches_and_countries(lake):
    lake.land([("a", "9", 1, "x"), ("a", "10", 1, "y"), ("b", "2", 1, "x")])
    lake.land([("a", "1", 1, "at")], "at")
    for country in ("de", "at"):
        lake.ingest(country)
        lake.merge(country)
    assert lake.rows() == [("a", "at", 1, "at"), ("a", "de", 10, "y"), ("b", "de", 2, "x")], "text versions compare as numbers"
    lake.land([("a", "3", 1, "stale"), ("b", "3", 1, "new"), ("c", "1", 1, "x")])
    lake.ingest()
    report = lake.merge()
    assert (report.inserted, report.updated, report.unchanged) == (1, 1, 1)
    assert lake.rows() == [("a", "at", 1, "at"), ("a", "de", 10, "y"), ("b", "de", 3, "new"), ("c", "de", 1, "x")]
    assert lake.merge().batches == []


def test_replayed_batch_changes_nothing(lake, spark):
    lake.land([("a", "1", 1, "x"), ("b", "1", 1, "x")])
    lake.ingest()
    lake.merge()
    before = lake.rows()
    shutil.rmtree(f"{lake.mark('silver')}/stream".removeprefix("file:"))  # forget the progress, keep the stage
    report = lake.merge()
    assert lake.rows() == before and (report.inserted, report.unchanged) == (0, 2)
    report = silver.UpsertReport()
    batch = bronze.read_bronze(spark, lake.bronze(), lake.mark("bronze"))
    silver.upsert_batch(SPEC, "de", lake.silver, f"{lake.root}/other-stage", report)(batch, 7)
    assert lake.rows() == before and (report.inserted, report.unchanged) == (0, 2)


def test_reset_checkpoint_with_new_rows_uses_no_old_stage(lake, spark):
    lake.land([("a", "1", 1, "x"), ("b", "1", 1, "x")])
    lake.ingest()
    lake.merge()
    shutil.rmtree(f"{lake.mark('silver')}/stream".removeprefix("file:"))
    lake.land([("a", "2", 1, "y")])
    lake.ingest()
    lake.merge()
    assert lake.rows() == [("a", "de", 2, "y"), ("b", "de", 1, "x")]
    stage = f"{lake.mark('silver')}/stage"
    assert len(child_names(spark, stage)) == 1 and len(child_names(spark, f"{stage}/{child_names(spark, stage)[0]}")) == 1


def _rows_of(lake, spark):
    return {r.tag_id: r for r in bronze.read_bronze(spark, lake.bronze(), lake.mark("bronze")).collect()}


def test_an_old_file_with_a_new_column_keeps_it(lake, spark):
    lake.land([("a", "1", 1, "x")])
    lake.ingest()
    lake.land([("b", "1", 1, "x")], late="kept")
    folder = pathlib.Path(lake.landing().removeprefix("file:"))
    for path in folder.glob("*.parquet"):
        os.utime(path, (0, path.stat().st_mtime - 3 * 3600))
    assert lake.ingest() == bronze.IngestReport(1, 1)
    assert _rows_of(lake, spark)["b"].late == "kept"


def test_a_file_that_lands_during_the_run_keeps_its_columns(lake, spark, monkeypatch):
    lake.land([("a", "1", 1, "x")])
    before = bronze.has_files

    def late(*args):
        found = before(*args)
        lake.land([("b", "1", 1, "x")], late="kept")
        return found

    monkeypatch.setattr(bronze, "has_files", late)
    assert lake.ingest() == bronze.IngestReport(2, 2)
    assert _rows_of(lake, spark)["b"].late == "kept"


def test_types_widen_and_misfits_are_kept_as_text(lake, spark):
    def land(value, kind):
        spark.createDataFrame([(kind, value)], f"tag_id string, amount {kind}").coalesce(1).write.mode("append").parquet(lake.landing())

    land(1, "int")
    lake.ingest()
    land(2**40, "long")
    land(7, "int")
    lake.ingest()
    got = bronze.read_bronze(spark, lake.bronze(), lake.mark("bronze")).select("amount").collect()
    assert sorted(r[0] for r in got) == [1, 7, 2**40]
    land("many", "string")
    lake.ingest()
    got = bronze.read_bronze(spark, lake.bronze(), lake.mark("bronze")).select("amount", "amount_as_text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, None), (2**40, None), (7, None), (None, "many")], key=repr)


def test_nested_landing_folders_are_read(lake, spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "tag_id string, version int")
    rows.coalesce(1).write.parquet(f"{lake.landing()}/2024/01/01")
    rows.withColumn("day", F.lit("2024-01-02")).write.partitionBy("day").mode("append").parquet(lake.landing())
    assert lake.ingest().rows == 4
    days = bronze.read_bronze(spark, lake.bronze(), lake.mark("bronze")).groupBy("day").count().collect()
    assert sorted((str(r[0]), r[1]) for r in days) == [("2024-01-02", 2), ("None", 2)]


def test_replayed_load_is_counted_and_not_doubled(lake, spark, monkeypatch):
    lake.land([("a", "1", 1, "x"), ("b", "1", 1, "x")])
    read = bronze.read_text

    def crash(session, path):
        if path.endswith("_SUCCESS"):  # the batch is written, but not yet committed to the stream
            raise RuntimeError("driver lost")
        return read(session, path)

    with monkeypatch.context() as m:
        m.setattr(bronze, "read_text", crash)
        with pytest.raises(Exception, match="driver lost"):
            lake.ingest()
    assert bronze.read_text is read
    assert lake.ingest() == bronze.IngestReport(2, 1)
    assert sorted(_rows_of(lake, spark)) == ["a", "b"]
    assert bronze.read_bronze(spark, lake.bronze(), lake.mark("bronze")).count() == 2


def test_crash_between_stage_and_table_loses_nothing(lake, spark, monkeypatch):
    lake.land([("a", "1", 1, "x")])
    lake.ingest()
    lake.merge()
    lake.land([("a", "2", 1, "y"), ("b", "1", 1, "x")])
    lake.ingest()

    def crash(df, path, partition_by):
        shutil.rmtree(f"{path}/country_code=de".removeprefix("file:"))  # the old partition is already gone
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(silver, "replace_partitions", crash)
        with pytest.raises(Exception, match="executor lost"):
            lake.merge()
    assert lake.rows() == []
    report = lake.merge()
    assert (report.inserted, report.updated) == (1, 1)
    assert lake.rows() == [("a", "de", 2, "y"), ("b", "de", 1, "x")]


def test_malformed_values_are_quarantined(lake, spark):
    lake.land([("a", "1", 1, "x"), ("b", "oops", 1, "x")])
    lake.ingest()
    lake.merge(mode="try")
    assert lake.rows() == [("a", "de", 1, "x"), ("b", "de", None, "x")]
    query = child_names(spark, f"{lake.mark('silver')}/stage/quarantine")[0]
    kept = spark.read.parquet(f"{lake.mark('silver')}/stage/quarantine/{query}/batch=0")
    assert [(r.tag_id, r.version) for r in kept.collect()] == [("b", "oops")]
    assert is_complete(spark, f"{lake.mark('silver')}/stage/{query}/batch=0/changes")


def test_small_batches_give_the_same_table(lake):
    for i in range(3):
        lake.land([("a", str(i), 1, f"v{i}"), (f"k{i}", "1", 1, "x")])
    lake.ingest()
    report = lake.merge(max_files_per_batch=1)
    assert lake.rows() == [("a", "de", 2, "v2"), ("k0", "de", 1, "x"), ("k1", "de", 1, "x"), ("k2", "de", 1, "x")]
    assert report.inserted == 4


def test_buckets_limit_the_rewrite(lake, spark):
    def files():
        return {f.rsplit("/", 2)[1]: f for f in spark.read.parquet(lake.silver).inputFiles()}

    lake.land([(f"k{i}", "1", 1, "x") for i in range(40)])
    lake.ingest()
    lake.merge(buckets=8)
    before = files()
    assert len(before) == 8
    lake.land([("k3", "2", 1, "y"), ("k4", "0", 1, "stale")])
    lake.ingest()
    report = lake.merge(buckets=8)
    assert (report.inserted, report.updated, report.unchanged) == (0, 1, 1)
    after = files()
    assert sum(before[b] != after[b] for b in before) == 1, "only the changed key's bucket is rewritten"
    assert lake.rows() == sorted([(f"k{i}", "de", 2 if i == 3 else 1, "y" if i == 3 else "x") for i in range(40)])
