import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.contracts import TableContract, contract
from tierstone.operators import merge
from tierstone.operators.enforce import enforce_schema, latest_per_key, malformed_rows, stamp
from tierstone.session import scratch_dir
from tierstone.sources.tables import path_exists

KEYS = ["pk", "country_code"]
SCHEMA = "pk string, country_code string, version int, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def upsert_in_python(target, source):
    stored = {r[:2]: r for r in target if r[0] is not None}
    loose = [r for r in target if r[0] is None]
    for r in source:
        if r[0] is None:
            loose.append(r)
        elif r[:2] not in stored:
            stored[r[:2]] = r
        elif r[2] is not None and stored[r[:2]][2] is not None and r[2] > stored[r[:2]][2]:
            stored[r[:2]] = r
    return sorted([*stored.values(), *loose], key=repr)


CASES_TARGET = [("newer", "de", 1, "t"), ("equal", "de", 2, "t"), ("older", "de", 3, "t"), ("nullsrc", "de", 1, "t"),
                ("nulltgt", "de", None, "t"), ("only", "de", 1, "t"), ("two", "de", 1, "t"), ("two", "at", 5, "t"), (None, "de", 1, "t")]
CASES_SOURCE = [("newer", "de", 2, "s"), ("equal", "de", 2, "s"), ("older", "de", 2, "s"), ("nullsrc", "de", None, "s"),
                ("nulltgt", "de", 9, "s"), ("new", "de", 1, "s"), ("two", "de", 2, "s"), ("two", "at", 2, "s"), (None, "de", 2, "s")]


def test_upsert_cases(spark):
    target, source = frame(spark, CASES_TARGET), frame(spark, CASES_SOURCE)
    assert rows_of(merge.upsert(target, source, KEYS, "version")) == upsert_in_python(CASES_TARGET, CASES_SOURCE)
    changes = merge.classify_upsert(target, source, KEYS, "version")
    assert rows_of(merge.apply_changes(target, changes, KEYS)) == upsert_in_python(CASES_TARGET, CASES_SOURCE)
    counts = merge.upsert_metrics(changes).first()
    assert (counts.inserted, counts.updated, counts.unchanged) == (2, 2, 5)


def test_upsert_is_idempotent_and_order_independent(spark):
    rng = random.Random(3)
    log = [(f"k{rng.randrange(12)}", rng.choice(["de", "at"]), i, f"v{i}") for i in range(60)]
    parts = [log[:20], log[20:40], log[40:]]
    results = []
    for order in ([0, 1, 2], [2, 0, 1], [1, 1, 2, 0, 2]):
        state = frame(spark, [])
        for i in order:
            batch = latest_per_key(frame(spark, parts[i]), KEYS, "version")
            state = spark.createDataFrame(merge.upsert(state, batch, KEYS, "version").collect(), SCHEMA)
        results.append(rows_of(state))
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == len({r[:2] for r in log})


def test_latest_per_key_breaks_ties_the_same_way(spark):
    rows = [("a", "de", 1, "x"), ("a", "de", 2, "b"), ("a", "de", 2, "c"), ("b", "de", None, "n"), ("b", "de", 0, "m")]
    for seed in range(3):
        shuffled = random.Random(seed).sample(rows, len(rows))
        got = rows_of(latest_per_key(frame(spark, shuffled).repartition(3), KEYS, "version"))
        assert got == [("a", "de", 2, "c"), ("b", "de", 0, "m")]


def test_latest_per_key_limits_groups_before_the_shuffle(spark, plan_of):
    plan = plan_of(latest_per_key(frame(spark, CASES_SOURCE), KEYS, "version"))
    assert "row_number(), 1, Partial" in plan


def test_keyed_merge(spark):
    target, source = frame(spark, [("a", "de", 5, "t"), ("b", "de", 5, "t")]), frame(spark, [("a", "de", 1, "s"), ("c", "de", 1, "s")])
    assert rows_of(merge.keyed_merge(target, source, KEYS)) == [("a", "de", 1, "s"), ("b", "de", 5, "t"), ("c", "de", 1, "s")]
    doubled = source.unionByName(source)
    with pytest.raises(ValueError, match="several rows per key"):
        merge.keyed_merge(target, doubled, KEYS, check_unique=True)


def test_replace_window_removes_vanished_groups(spark):
    target = frame(spark, [("a", "de", 1, "t"), ("b", "de", 9, "t"), ("c", "de", None, "t")])
    out = merge.replace_window(target, frame(spark, [("d", "de", 9, "s")]), F.col("version") >= 5)
    assert rows_of(out) == [("a", "de", 1, "t"), ("c", "de", None, "t"), ("d", "de", 9, "s")]


def test_enforce_schema(spark):
    spec = contract("ig_player_tag")
    df = spark.createDataFrame([("t1", "12", "1", "x")], "tag_id string, version string, is_active string, rogue string")
    out = enforce_schema(df, spec.schema)
    assert out.schema.fieldNames() == spec.schema.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in spec.schema]
    row = out.first()
    assert (row.tag_id, row.version, row.is_active, row.player_id) == ("t1", 12, 1, None)
    assert enforce_schema(df, T.StructType([])).columns == df.columns


def test_malformed_values(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])
    df = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None)], "id string, n string")
    assert rows_of(enforce_schema(df, schema, "try")) == [("a", 1), ("b", None), ("c", None)]
    assert rows_of(malformed_rows(df, schema)) == [("b", "x")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        enforce_schema(df, schema).collect()


def test_stamp(spark):
    row = stamp(frame(spark, [("a", "xx", 1, "t")]), "de", "2024-01-01 00:00:00").first()
    assert row.country_code == "de" and str(row.last_update) == "2024-01-01 00:00:00"


def test_merge_table_rewrites_touched_partitions_only(spark):
    root = scratch_dir(spark, "test")
    path, stage = f"{root}/t", f"{root}/stage"
    merge.merge_table(spark, path, frame(spark, [("a", "de", 1, "t"), ("b", "at", 1, "t")]), KEYS, ["country_code"], stage)
    before = {f for f in spark.read.parquet(path).filter("country_code = 'at'").inputFiles() if "country_code=at" in f}
    merge.merge_table(spark, path, frame(spark, [("a", "de", 2, "s"), ("c", "de", 1, "s")]), KEYS, ["country_code"], stage)
    got = rows_of(spark.read.parquet(path).select("pk", "country_code", "version", "v"))
    assert got == [("a", "de", 2, "s"), ("b", "at", 1, "t"), ("c", "de", 1, "s")]
    after = {f for f in spark.read.parquet(path).filter("country_code = 'at'").inputFiles() if "country_code=at" in f}
    assert before == after


def test_interrupted_merge_is_finished_first(spark):
    root = scratch_dir(spark, "test")
    path, stage = f"{root}/t", f"{root}/stage"
    rows = frame(spark, [("a", "de", 1, "t")])
    merge.overwrite_table(frame(spark, [("b", "at", 1, "t")]), path, ["country_code"])
    rows.write.parquet(f"{stage}/result")  # an earlier run got this far and lost the country "de"
    merge.merge_table(spark, path, frame(spark, [("c", "de", 1, "s")]), KEYS, ["country_code"], stage)
    assert rows_of(spark.read.parquet(path).select("pk", "v")) == [("a", "t"), ("b", "t"), ("c", "s")]
    assert not path_exists(spark, stage)


def test_merged_partitions_are_moved_and_not_written_again(spark, monkeypatch):
    root = scratch_dir(spark, "test")
    path, stage = f"{root}/t", f"{root}/stage"
    merge.overwrite_table(frame(spark, [("a", "de", 1, "t"), ("b", "at", 1, "t"), ("d", None, 1, "t")]), path, ["country_code"])
    monkeypatch.setattr(merge, "replace_partitions", None)
    move, moved = merge.move_path, []

    def broken(spark, source, target):
        if moved:
            raise RuntimeError("lost the driver")
        moved.append(move(spark, source, target))

    rows = frame(spark, [("a", "de", 2, "s"), ("c", "dk", 1, "s"), ("e", None, 1, "s")])
    with monkeypatch.context() as crash:  # one of three partitions is in place
        crash.setattr(merge, "move_path", broken)
        with pytest.raises(RuntimeError):
            merge.merge_table(spark, path, rows, KEYS, ["country_code"], stage)
    merge.finish_stage(spark, path, ["country_code"], stage)
    got = sorted((r.pk, r.country_code or "", r.version, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", "de", 2, "s"), ("b", "at", 1, "t"), ("c", "dk", 1, "s"), ("d", "", 1, "t"), ("e", "", 1, "s")]
    assert not path_exists(spark, stage)


def test_rows_that_lie_together_are_written_without_a_shuffle(spark, plan_of):
    df = frame(spark, [("a", "de", 1, "t")])
    assert "Exchange" in plan_of(merge._sized_for(df, ["country_code"]))
    assert "Exchange" not in plan_of(merge._sized_for(df, ["country_code"], clustered=True))


def test_unfinished_table_is_not_merged_into(spark):
    root = scratch_dir(spark, "test")
    rows = frame(spark, [("a", "de", 1, "t")])
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/t")

    def load(**how):
        merge.load_incremental(spark, f"{root}/t", lambda loaded: rows, KEYS, ["country_code"], f"{root}/stage", **how)

    with pytest.raises(RuntimeError, match="full refresh"):
        load()
    load(full_refresh=True)
    load()
    assert spark.read.parquet(f"{root}/t").count() == 1


def test_incremental_load(spark):
    root = scratch_dir(spark, "test")
    source = [("a", "de", 1, "x"), ("b", "de", 2, "x")]

    def build(loaded):
        rows = frame(spark, source)
        return rows if loaded is None else rows.filter(F.col("version") > loaded.agg(F.max("version")).scalar())

    def load(**how):
        merge.load_incremental(spark, f"{root}/t", build, KEYS, ["country_code"], f"{root}/stage", **how)
        return rows_of(spark.read.parquet(f"{root}/t").select("pk", "country_code", "version", "v"))

    assert load() == source
    source = [("a", "de", 3, "y"), ("b", "de", 2, "ignored"), ("c", "at", 4, "y")]
    assert load() == [("a", "de", 3, "y"), ("b", "de", 2, "x"), ("c", "at", 4, "y")]
    assert load() == [("a", "de", 3, "y"), ("b", "de", 2, "x"), ("c", "at", 4, "y")]
    assert load(full_refresh=True) == sorted(source)


def test_merge_into_needs_a_catalog_with_row_level_operations(spark):
    spark.sql("drop table if exists plain_target")
    frame(spark, CASES_TARGET).write.saveAsTable("plain_target")
    spec = TableContract("pk", frame(spark, []).schema)
    with pytest.raises(Exception, match="UNSUPPORTED|not support"):
        merge.merge_into_catalog("plain_target", frame(spark, CASES_SOURCE), spec)
    spark.sql("drop table plain_target")
