"""Groups recomputed because their rows changed."""

import random

import pytest
from pyspark.sql import functions as F

from tierstone.operators import touched
from tierstone.plans import marts
from tierstone.session import scratch_dir
from tierstone.sources.tables import child_names

ROWS = "id int, hour int, amount int"
GRAIN = ["hour"]


def totals(rows):
    return rows.groupBy("hour").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))


def collected(df):
    return sorted((tuple(r) for r in df.select("hour", "amount", "n").collect()), key=repr)


class Mart:
    """Totals by hour, stored by ten hours."""

    def __init__(self, spark):
        self.spark, self.root = spark, scratch_dir(spark, "test-touched")
        self.path, self.stage = f"{self.root}/mart", f"{self.root}/stage"

    def run(self, before, after, full_refresh=False):
        now = self.spark.createDataFrame(after, ROWS)
        changed = set(before) ^ set(after)
        stale = touched.touched_groups(GRAIN, self.spark.createDataFrame([r for r in changed if r in before], ROWS),
                                       self.spark.createDataFrame([r for r in changed if r in after], ROWS))

        def build(groups):
            return totals(now if groups is None else touched.rows_of_groups(now, groups, GRAIN))

        touched.maintain(self.spark, self.path, build, lambda stored: stale, GRAIN, "part", F.expr("hour div 10").cast("int"), self.stage, full_refresh)
        return collected(self.spark.read.parquet(self.path)) == collected(totals(now))


@pytest.fixture()
def mart(spark):
    return Mart(spark)


def test_random_changes_give_the_full_result(mart):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, *range(40)]), rng.randrange(9)) for i in range(80)]
    assert mart.run([], rows)
    for _ in range(4):
        after = [(i, rng.choice([None, *range(40)]) if rng.random() < 0.1 else h, a) for i, h, a in rows if rng.random() < 0.9]
        assert mart.run(rows, after)
        rows = after


def test_only_touched_partitions_are_written_and_empty_ones_go(mart, spark):
    rows = [(i, i, 1) for i in range(30)]
    mart.run([], rows)
    files = {p: child_names(spark, f"{mart.path}/{p}") for p in child_names(spark, mart.path) if "=" in p}
    after = [r for r in rows if not 10 <= r[1] < 20] + [(99, 0, 5)]
    assert mart.run(rows, after)
    left = {p: child_names(spark, f"{mart.path}/{p}") for p in child_names(spark, mart.path) if "=" in p}
    assert set(left) == {"part=0", "part=2"} and left["part=2"] == files["part=2"] and left["part=0"] != files["part=0"]
    assert mart.run(after, after) and mart.run(after, rows, full_refresh=True)


def test_interrupted_swap_is_published_by_the_next_run(mart, monkeypatch):
    rows = [(i, i, 1) for i in range(30)]
    after = rows[:10] + [(7, 25, 100)]
    mart.run([], rows)

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(touched, "replace_partitions", crash)
        with pytest.raises(RuntimeError):
            mart.run(rows, after)
    assert mart.run(after, after)


def test_swap_of_frames_keeps_null_groups_apart(spark):
    target = spark.createDataFrame([(None, 1, 1), (1, 1, 1), (2, 1, 1)], "hour int, amount int, n int")
    stale = spark.createDataFrame([(None,), (2,)], "hour int")
    rebuilt = spark.createDataFrame([(None, 7, 7)], "hour int, amount int, n int")
    assert collected(touched.swap_groups(target, rebuilt, stale, GRAIN)) == [(1, 1, 1), (None, 7, 7)]


def test_many_partitions_prune_by_one_list(spark, plan_of):
    root = scratch_dir(spark, "test-days")
    spark.range(3000).select(F.col("id").cast("int").alias("hour"), F.lit(1).alias("amount"), F.lit(1).alias("n"),
                             (F.col("id") % 40).cast("int").alias("part")).coalesce(1).write.partitionBy("part").parquet(f"{root}/t")
    days = spark.range(3000).select(F.col("id").cast("int").alias("part"))
    rows = spark.read.parquet(f"{root}/t").filter(touched._in_partitions(days, ["part"]))
    assert rows.count() == 3000 and "PartitionFilters: []" not in plan_of(rows)


def fact_of(spark, players, days):
    return spark.range(players * days).select(
        F.concat(F.lit("r"), F.col("id")).alias("round_id"), (F.lit(2024010100) + (F.col("id") % days) * 100).cast("int").alias("sk_date_time"),
        F.md5((F.col("id") % players).cast("string")).alias("sk_player"), F.lit("g").alias("sk_game"), F.lit("de").alias("country_code"),
        *[F.lit(1).alias(c) for c in ("is_promotional", "bet_count", "win_count")],
        *[F.lit("1.5").cast("decimal(34,4)").alias(c) for c in (
            "bet_amount_eur", "win_amount_eur", "bonus_bet_amount_eur", "bonus_win_amount_eur", "tax_amount_eur")])


@pytest.mark.parametrize("players, days", [(50, 3), (40_000, 7)])
def test_sketches_of_players_roll_up_within_their_error(spark, players, days):
    fact = fact_of(spark, players, days)
    mart = marts.mart_gameround_hourly(fact, player_sketch=True)
    whole = marts.roll_up(mart, F.lit("all")).collect()[0]
    assert whole.rounds == players * days and abs(whole.active_players - players) <= 0.04 * players
    daily = marts.roll_up(mart, F.expr("sk_date_time div 100")).collect()
    exact = {r.d: r.n for r in fact.groupBy(F.expr("sk_date_time div 100").alias("d")).agg(F.count_distinct("sk_player").alias("n")).collect()}
    assert len(daily) == days and all(abs(r.active_players - exact[r.span]) <= 0.04 * exact[r.span] + 1 for r in daily)


def test_roll_up_reads_the_mart_alone(spark, plan_of):
    root = scratch_dir(spark, "test-rollup")
    marts.mart_gameround_hourly(fact_of(spark, 20, 3), player_sketch=True).write.parquet(f"{root}/mart")
    plan = plan_of(marts.roll_up(spark.read.parquet(f"{root}/mart"), F.lit(1)))
    assert plan.count("FileScan") == 1 and "sk_player#" not in plan
