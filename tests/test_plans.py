"""Plan shapes that have to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tierstone.operators import incremental, merge
from tierstone.operators.history import build_history, snapshot
from tierstone.plans import facts, marts
from tierstone.session import materialise, scratch_dir

@pytest.fixture(scope="module")
def stored(spark):
    """Silver-like tables on disk, so that filters can reach a scan."""
    root = scratch_dir(spark, "test-plans")
    n = spark.range(1000)
    n.select(F.col("id").cast("string").alias("transaction_id"), F.col("id").cast("string").alias("player_id"),
             F.lit("g").alias("game_id"), F.lit("de").alias("country_code"), F.lit("EUR").alias("currency_code"),
             F.lit("BET").alias("transaction_type"), F.lit("SUCCEEDED").alias("transaction_status"),
             F.timestamp_seconds(F.col("id") * 3600).alias("created_at"),
             *[F.lit(1).cast("decimal(34,4)").alias(c) for c in ("amount_eur", "amount_real_eur", "amount_bonus_eur")],
             F.lit("wide").alias("unused")).write.parquet(f"{root}/txn")
    n.select(F.col("id").cast("string").alias("tag_id"), F.col("id").cast("string").alias("player_id"), F.lit("de").alias("country_code"),
             F.lit("User").alias("target_type"), F.lit("TEST").alias("tag_category"), F.lit(0).alias("is_active")).write.parquet(f"{root}/tags")
    n.select(F.lit("g").alias("game_id"), F.lit("de").alias("country_code"), F.lit("v").alias("vertical"), F.lit("s").alias("studio"),
             F.lit("t").alias("type")).limit(1).write.parquet(f"{root}/games")
    n.select((F.col("id") + 2025010100).cast("int").alias("sk_date_time"), F.lit("g").alias("sk_game"), F.lit("de").alias("country_code"),
             F.lit("p").alias("sk_player"), F.col("id").cast("string").alias("round_id"), F.lit(1).alias("is_promotional"),
             F.lit(1).alias("bet_count"), F.lit(1).alias("win_count"), F.timestamp_seconds("id").alias("updated_at"),
             *[F.lit(1).cast("decimal(34,4)").alias(f"{c}_amount_eur") for c in ("bet", "win", "bonus_bet", "bonus_win", "tax")]
             ).write.parquet(f"{root}/rounds")
    return lambda name: spark.read.parquet(f"{root}/{name}")


def test_kpi_fact_pushes_filters_and_prunes_columns(plan_of, stored):
    plan = plan_of(facts.fact_txn_kpi(stored("txn"), stored("tags"), stored("games"), incremental=True, as_of="1970-01-20"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "transaction_status" in line)
    assert "EqualTo(transaction_status,SUCCEEDED)" in scan and "GreaterThanOrEqual(created_at,1970-01-18" in scan
    assert "unused" not in scan
    before_join = plan[plan.index("partial_sum"):]
    assert "Join" not in before_join.splitlines()[0]
    assert plan.index("BroadcastHashJoin") < plan.index("partial_sum"), "rows are aggregated below the joins"


def test_tags_are_scanned_once(plan_of, stored):
    plan = plan_of(facts.fact_txn_kpi(stored("txn"), stored("tags"), stored("games")))
    assert len(re.findall(r"FileScan parquet \[[^\]]*tag_category", plan)) == 1


def test_hour_lookback_reaches_the_scan(plan_of, stored):
    plan = plan_of(marts.mart_gameround_hourly(stored("rounds"), incremental=True, as_of="2025-01-20"))
    assert "GreaterThanOrEqual(sk_date_time,2025011800)" in plan


def test_watermark_is_a_pushed_subquery(stored):
    rounds = stored("rounds")
    df = incremental.above_watermark(rounds, rounds.filter("sk_date_time < 2025010200"), "updated_at")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at,ScalarSubquery" in text
    assert df.count() == 900


def test_distinct_players_count_in_two_steps(plan_of, stored):
    """Players are first made distinct per group, so a hot hour is not counted by one task."""
    plan = plan_of(marts.mart_gameround_hourly(stored("rounds")))
    assert "hashpartitioning(sk_date_time" in plan and re.search(r"hashpartitioning\([^)]*sk_player", plan)
    assert "Expand" not in plan


def test_small_change_set_leaves_the_target_unshuffled(spark, plan_of, stored):
    target = stored("txn").select("transaction_id", "country_code", F.lit(1).alias("version"), "amount_eur")
    source = target.limit(5)
    plan = plan_of(merge.apply_changes(target, source.withColumn(merge.ACTION, F.lit("update")), ["transaction_id", "country_code"]))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "hashpartitioning" not in plan


def test_ordinary_history_takes_one_window_shuffle_after_dedup(spark, plan_of, stored):
    log = stored("txn").select("player_id", "country_code", "created_at", "amount_eur")
    plan = plan_of(build_history(log, ["player_id", "country_code"], "created_at"))
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_snapshot_shares_one_partitioning(spark, plan_of, stored):
    """Each frame is shuffled by key for its join; the aggregate and the window after it are not."""
    keys = ["player_id", "country_code"]
    log = stored("txn").select(*keys, "created_at", "amount_eur")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = materialise(build_history(log, keys, "created_at"), "test-history")
        plan = plan_of(snapshot(built, log, keys, "created_at", run_at="2024-01-01 00:00:00"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 6


def test_hot_keys_of_a_snapshot_are_dealt_by_slot(spark, plan_of, stored):
    """Even after joins that deal rows by key, the window reads rows dealt by key and slot."""
    keys = ["player_id", "country_code"]
    log = stored("txn").select(F.lit("hot").alias("player_id"), "country_code", "created_at", "amount_eur")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = materialise(build_history(log, keys, "created_at"), "test-history")
        plan = plan_of(snapshot(built, log, keys, "created_at", run_at="2024-01-01 00:00:00", rows_per_slot=100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"Exchange hashpartitioning\([^)]*_slot[^)]*\), REPARTITION_BY_COL", plan)
