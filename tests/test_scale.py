"""Sizes of tasks: how scans are split, how landings are written, how wide sorted rows are."""

from pyspark.sql import functions as F

from tierstone import session
from tierstone.operators import outbox
from tierstone.plans import gallery
from tierstone.sources import warehouse
from tierstone.sources.tables import file_paths

LIMIT = "spark.sql.files.maxPartitionBytes"


def test_scans_are_split_finely_but_a_smaller_limit_stays(spark):
    spark.conf.set(LIMIT, "128m")
    session.prepare(spark)
    assert int(spark.conf.get(LIMIT)) == session.SCAN_BYTES
    spark.conf.set(LIMIT, "1m")
    session.prepare(spark)
    assert spark.conf.get(LIMIT) == "1m"
    spark.conf.unset(LIMIT)


def test_a_landing_of_one_file_is_read_by_many_tasks(spark):
    streams = gallery.RoundStreams(spark, "unused")
    rows = spark.range(0, 400, 1, 8).select(
        "id", F.expr("spark_partition_id()").alias("task"), F.when(F.col("id") % 2 == 0, "de").otherwise("at").alias("country_code"))
    streams.land(rows, one_file=True)
    folder = f"{streams.root}/landing/{streams.table}"
    found = file_paths(spark, folder, ".parquet")
    assert [sum(f"country_code={c}/" in f for f in found) for c in ("de", "at", "dk")] == [1, 1, 0]
    stored = spark.read.parquet(folder)
    assert stored.count() == 400 and stored.select("task").distinct().count() == 8


def test_error_texts_are_cut_before_they_are_sorted(spark, monkeypatch):
    def attempts(spark, folder):
        return spark.createDataFrame(
            [(1, "u", "de", 404, "x" * 5000, "2024-01-01"), (2, "u", "de", 404, "y" * 5000, "2024-01-02")],
            "event_id long, online_customer_id string, country_code string, status int, body string, attempted_at string")

    monkeypatch.setattr(warehouse, "attempts", attempts)
    results = gallery.delivery_results(spark, "unused")
    assert [r.error for r in results.collect()] == ["y" * outbox.ERROR_LENGTH]


def test_micro_batches_leave_no_shuffle_files_and_the_session_as_it_was(spark):
    root = session.scratch_dir(spark, "test-tidy")
    spark.range(3).write.parquet(f"{root}/in")
    before, seen = spark.conf.get(session.CLEANUP_CONF), []

    def run(batch, batch_id):
        seen.append((batch.sparkSession.conf.get(session.CLEANUP_CONF), batch.repartition(2).count()))

    stream = spark.readStream.schema("id long").parquet(f"{root}/in").writeStream.trigger(availableNow=True)
    stream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(session.tidy(run)).start().awaitTermination()
    assert seen == [("true", 3)] and spark.conf.get(session.CLEANUP_CONF) == before


def test_landings_are_packed_tightly(spark):
    streams = gallery.RoundStreams(spark, "unused")
    streams.land(spark.range(9).withColumn("country_code", F.lit("de")))
    found = file_paths(spark, streams.root, ".parquet")
    assert found and all(f.endswith(".zstd.parquet") for f in found)
