"""Named runs of every operator and model over the tables of one folder.

Each entry takes (spark, folder) and returns a DataFrame. Frames that several branches
of one plan read are written once to the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.contracts import COUNTRIES, TENANT, contract
from tierstone.functions import kpi
from tierstone.functions.keys import surrogate_key
from tierstone.functions.text import clean_str, truncated
from tierstone.functions.times import VIENNA, hour_key, iso_utc, minutes_between
from tierstone.operators import history, incremental, merge, outbox, overlaps, quality, timeline, touched
from tierstone.operators.enforce import RESCUED, enforce_schema, latest_per_key, stamp
from tierstone.operators.history_table import HistoryTable
from tierstone.plans import dimensions, facts, marts, trips
from tierstone.session import COMPRESSION, materialise, prepare, scratch_dir
from tierstone.sources import calendar, warehouse
from tierstone.sources.tables import read_table
from tierstone.sources.trips_csv import trip_schema
from tierstone.streaming import bronze, silver, silver_log as change_log

Query = Callable[[SparkSession, str], DataFrame]

# The clock of all runs, and the day that splits "loaded earlier" from "arrived since".
NOW = "2024-02-01 00:00:00"
EVENTS_AS_OF = "2024-01-20"
ORDERS_AS_OF = "2001-06-01"
SPLIT = "1999-01-01"

QUERIES: dict[str, Query] = {}


def entry_point(fn: Query) -> Query:
    """Register a run; its output uses types that print alike in other engines."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return plain_types(fn(spark, folder))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def plain_types(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType)):
            c = c.cast("int")
        columns.append(c.alias(field.name))
    return df.select(*columns)


# --- shared inputs ---------------------------------------------------------------------

ROUND_KEYS = ["round_id", "country_code"]
TAG_KEYS = ["tag_id", "country_code"]
PLAYER_KEYS = ["player_id", "country_code"]
LIMIT_KEYS = ["limit_id", "country_code"]


def rounds(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(warehouse.rounds_log(spark, folder), ROUND_KEYS, "version")


def tags(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(warehouse.tags_log(spark, folder), TAG_KEYS, "modified_at")


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue side of the game dimension: what facts look up."""
    return warehouse.games(spark, folder).select(
        "game_id", "country_code", F.col("game_vertical").alias("vertical"),
        F.col("game_studio").alias("studio"), F.col("game_type").alias("type"))


def full_payments(spark: SparkSession, folder: str) -> DataFrame:
    return enforce_schema(warehouse.payments(spark, folder), contract("ig_payment").schema)


def payment_methods(payments: DataFrame) -> DataFrame:
    return materialise(dimensions.dim_payment_method(payments), "methods")


def payments_fact(spark: SparkSession, folder: str) -> DataFrame:
    rows = full_payments(spark, folder)
    return facts.fact_payments(rows, payment_methods(rows), now=NOW)


def rounds_fact(spark: SparkSession, folder: str) -> DataFrame:
    return facts.fact_gameround(rounds(spark, folder))


def player_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.build_history(warehouse.players_log(spark, folder), PLAYER_KEYS, "changed_at")


def tag_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.build_history(warehouse.tags_log(spark, folder), TAG_KEYS, "modified_at")


# --- bike trips ------------------------------------------------------------------------


@entry_point
def trip_silver(spark: SparkSession, folder: str) -> DataFrame:
    metadata = trips.run_metadata("trips", "run-1", "silver", NOW)
    rows = trips.silver(warehouse.trips(spark, folder), metadata)
    return rows.withColumns({k: F.col("metadata")[k] for k in trips.METADATA_KEYS}).drop("metadata")


@entry_point
def daily_ride_summary(spark: SparkSession, folder: str) -> DataFrame:
    return trips.daily_ride_summary(trips.silver(warehouse.trips(spark, folder)))


@entry_point
def station_performance(spark: SparkSession, folder: str) -> DataFrame:
    return trips.daily_station_performance(trips.silver(warehouse.trips(spark, folder)))


@entry_point
def csv_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Trips written as CSV, half of them with their columns in reverse and some with bad values, read back with the fixed schema."""
    def degrees(base: float, station: str) -> Column:
        return F.lit(base) + F.col(station).cast("double") / 1000

    def spoiled(value: Column, station: str, divisor: int, text: str) -> Column:
        return F.when(F.col(station).cast("int") % divisor == 0, text).otherwise(value.cast("string"))

    rows, end = warehouse.trips(spark, folder), F.col("end_station_id").cast("int")
    rows = rows.withColumns({
        "start_lat": spoiled(degrees(40.0, "start_station_id"), "start_station_id", 13, "unknown"),
        "start_lng": degrees(-74.0, "start_station_id"), "end_lat": degrees(40.0, "end_station_id"), "end_lng": degrees(-74.0, "end_station_id"),
        "ended_at": spoiled(F.col("ended_at"), "end_station_id", 17, "n/a"),
        "member_casual": F.when(end % 2 == 0, "member").otherwise("casual"),
    }).select(*trip_schema().fieldNames())
    path = scratch_dir(spark, "trips-csv")
    rows.filter(end % 3 != 0).write.csv(f"{path}/a", header=True)
    rows.filter(end % 3 == 0).select(*reversed(rows.columns)).write.csv(f"{path}/b", header=True)
    stored = trips.bronze(spark, path, trips.run_metadata("trips", "run-1", "bronze", NOW), rescued=True)
    lost = F.transform(F.array_sort(F.map_entries(RESCUED)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return stored.withColumns({"task_id": F.col("metadata")["task_id"], "rescued": F.array_join(lost, ";")}).drop("metadata", RESCUED)


@entry_point
def overwrite_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze to silver to gold through overwritten tables."""
    root = scratch_dir(spark, "trips")
    merge.overwrite_table(trips.silver(warehouse.trips(spark, folder)), f"{root}/silver")
    merge.overwrite_table(trips.daily_ride_summary(read_table(spark, f"{root}/silver")), f"{root}/daily")
    merge.overwrite_table(trips.daily_ride_summary(read_table(spark, f"{root}/silver")), f"{root}/daily")
    return read_table(spark, f"{root}/daily")


# --- KPI fact and its parts --------------------------------------------------------------


def _txn_kpi(spark: SparkSession, folder: str, **how) -> DataFrame:
    return facts.fact_txn_kpi(warehouse.transactions(spark, folder), tags(spark, folder),
                              catalog(spark, folder), now=NOW, **how)


@entry_point
def fact_txn_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return _txn_kpi(spark, folder)


@entry_point
def fact_txn_kpi_lookback(spark: SparkSession, folder: str) -> DataFrame:
    return _txn_kpi(spark, folder, incremental=True, as_of=EVENTS_AS_OF)


@entry_point
def fact_txn_kpi_window(spark: SparkSession, folder: str) -> DataFrame:
    """The look-back hours of a loaded fact deleted and rebuilt."""
    target = materialise(_txn_kpi(spark, folder), "kpi").withColumn("last_update", F.lit("2024-01-01").cast("timestamp"))
    rebuilt = _txn_kpi(spark, folder, incremental=True, as_of=EVENTS_AS_OF)
    first = hour_key(incremental.lookback_start(2, EVENTS_AS_OF).cast("timestamp"))
    return merge.replace_window(target, rebuilt, F.col("sk_date_time") >= first)


@entry_point
def kpi_table(spark: SparkSession, folder: str) -> DataFrame:
    """The KPI fact as a table by day: a full load up to a day, then two identical look-back runs."""
    root = scratch_dir(spark, "kpi-table")
    sources = (warehouse.transactions(spark, folder), tags(spark, folder), catalog(spark, folder))
    known = sources[0].filter(F.col("created_at") < F.lit(EVENTS_AS_OF).cast("timestamp"))

    def build(loaded: DataFrame | None) -> DataFrame:
        if loaded is None:
            fact = facts.fact_txn_kpi(known, *sources[1:], now=NOW)
        else:
            fact = facts.fact_txn_kpi(*sources, incremental=True, as_of=EVENTS_AS_OF, now=NOW)
        return fact.withColumn("kpi_day", F.floor(F.col("sk_date_time") / 100).cast("int"))

    for _ in range(3):
        merge.load_incremental(spark, f"{root}/fact", build, ["sk_txn_kpi"], ["kpi_day"], f"{root}/stage")
    return read_table(spark, f"{root}/fact").drop("kpi_day")


@entry_point
def net_of_reversals(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.transactions(spark, folder).groupBy("player_id", "country_code").agg(
        kpi.net_bets("amount_eur").alias("bets_eur"), kpi.net_wins("amount_eur").alias("wins_eur"))


@entry_point
def promo_wins(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.transactions(spark, folder).groupBy("player_id", "country_code").agg(
        kpi.promo_wins("amount_bonus_eur").alias("promo_wins_bonus_eur"),
        kpi.promo_wins("amount_real_eur", "amount_bonus_eur").alias("total_promo_wins_eur"))


@entry_point
def player_flags(spark: SparkSession, folder: str) -> DataFrame:
    return facts.player_flags(tags(spark, folder))


@entry_point
def exclude_tagged(spark: SparkSession, folder: str) -> DataFrame:
    rows = warehouse.transactions(spark, folder).select("transaction_id", "player_id", "country_code", "amount_eur")
    return facts.without_tagged(rows, tags(spark, folder))


@entry_point
def safe_ratio(spark: SparkSession, folder: str) -> DataFrame:
    bet, win = F.sum("bet_amount_eur"), F.sum("win_amount_eur")
    return rounds(spark, folder).groupBy("game_id", "win_count").agg(kpi.safe_ratio(win, bet).alias("win_rate"))


# --- other facts and marts ---------------------------------------------------------------


@entry_point
def fact_payments(spark: SparkSession, folder: str) -> DataFrame:
    return payments_fact(spark, folder)


@entry_point
def fact_payments_lookback(spark: SparkSession, folder: str) -> DataFrame:
    rows = full_payments(spark, folder)
    return facts.fact_payments(rows, payment_methods(rows), incremental=True, lookback_days=30, as_of=ORDERS_AS_OF, now=NOW)


@entry_point
def fact_gameround(spark: SparkSession, folder: str) -> DataFrame:
    return rounds_fact(spark, folder)


@entry_point
def fact_gameround_increment(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds above the high-water mark, merged on (round, country)."""
    stored = materialise(rounds(spark, folder), "rounds")
    loaded = facts.fact_gameround(stored).filter(F.col("updated_at") < F.lit(SPLIT).cast("timestamp"))
    fresh = facts.fact_gameround(stored, loaded)
    return merge.keyed_merge(loaded, fresh, ROUND_KEYS)


@entry_point
def fact_game_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return facts.fact_game_revenue(warehouse.transactions(spark, folder))


def _stored_model(spark: SparkSession, name: str, build: Callable[[DataFrame | None], DataFrame], everything: DataFrame,
                  keys: list[str], partition: Column, clustered: bool = False) -> DataFrame:
    """A model as a table: loaded, merged, run idle, and then refreshed in full; the rows before and after the refresh."""
    root = scratch_dir(spark, name)

    def run(model: Callable[[DataFrame | None], DataFrame], full_refresh: bool = False) -> None:
        merge.load_incremental(spark, f"{root}/table", lambda loaded: model(loaded).withColumn("part", partition), keys, ["part"],
                               f"{root}/stage", full_refresh, clustered)

    for _ in range(3):
        run(build)
    merged = materialise(read_table(spark, f"{root}/table"), f"{name}-merged")
    run(lambda _: everything, full_refresh=True)
    both = merged.withColumn("refreshed", F.lit(0)).unionByName(read_table(spark, f"{root}/table").withColumn("refreshed", F.lit(1)))
    return both.drop("part")


@entry_point
def game_revenue_table(spark: SparkSession, folder: str) -> DataFrame:
    """Game revenue merged on the transaction, by day."""
    rows = warehouse.transactions(spark, folder)
    known = rows.filter(F.col("created_at") < F.lit(EVENTS_AS_OF).cast("timestamp"))

    def build(loaded: DataFrame | None) -> DataFrame:
        return facts.fact_game_revenue(known if loaded is None else incremental.since_lookback(rows, "created_at", 2, EVENTS_AS_OF))

    day = F.floor(F.col("sk_date_time") / 100).cast("int")
    return _stored_model(spark, "game-revenue", build, facts.fact_game_revenue(rows), ["transaction_id"], day)


@entry_point
def fact_gameround_table(spark: SparkSession, folder: str) -> DataFrame:
    """Closed rounds merged on round and country, by month of ingestion; later runs read above the stored high-water mark."""
    # Open rounds never get into the table; closed ones are dealt by month once, before their hashed keys, for all writes.
    closed = rounds(spark, folder).filter(F.col("is_closed") == 1).withColumn("sk_date_time", hour_key("ingested_at"))
    month = F.floor(F.col("sk_date_time") / 10000).cast("int")
    latest = materialise(closed.withColumn("part", month).hint("rebalance", "part").drop("sk_date_time", "part"), "rounds")
    known = latest.filter(F.col("updated_at") < F.lit(SPLIT).cast("timestamp"))

    def build(loaded: DataFrame | None) -> DataFrame:
        return facts.fact_gameround(known) if loaded is None else facts.fact_gameround(latest, loaded, inclusive=True)

    return _stored_model(spark, "gamerounds", build, facts.fact_gameround(latest), ROUND_KEYS, month, clustered=True)


@entry_point
def mart_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mart_gameround_hourly(rounds_fact(spark, folder))


@entry_point
def mart_hourly_increment(spark: SparkSession, folder: str) -> DataFrame:
    """Look-back hours aggregated again and merged into the earlier mart."""
    fact = materialise(rounds_fact(spark, folder), "rounds")
    earlier = marts.mart_gameround_hourly(fact.filter(F.col("created_at") < F.lit(ORDERS_AS_OF).cast("timestamp")))
    late = marts.mart_gameround_hourly(fact, incremental=True, as_of=ORDERS_AS_OF)
    return merge.keyed_merge(earlier, late, marts.HOURLY_GRAIN)


@entry_point
def revenue_per_player(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.mart_gameround_hourly(rounds_fact(spark, folder), zero_fill=True, revenue_per_player=True)
    return mart.select(*marts.HOURLY_GRAIN, "promo_rounds", "active_players", "revenue_per_player")


@entry_point
def active_players_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Months rolled up from the hourly mart, their estimated players held against the exact count of the rounds."""
    fact = materialise(rounds_fact(spark, folder), "rounds-fact")
    mart = materialise(marts.mart_gameround_hourly(fact, player_sketch=True), "mart")
    month = F.floor(F.col("sk_date_time") / 10000).cast("int")
    exact = fact.groupBy(month.alias("month"), "country_code").agg(F.count_distinct("sk_player").alias("players"))
    rows = marts.roll_up(mart, month, out="month").join(exact, ["month", "country_code"], "left")
    near = F.abs(F.col("active_players") - F.col("players")) <= F.greatest(F.lit(1), 0.04 * F.col("players"))
    return rows.select("month", "country_code", "rounds", "bet_eur", "ggr_eur", "players", near.alias("estimate_is_near"))


# --- groups that late changes touch ------------------------------------------------------


@entry_point
def fact_payments_late(spark: SparkSession, folder: str) -> DataFrame:
    """The stored payment fact after payments succeeded, failed and changed their hour long after the first load."""
    now = materialise(full_payments(spark, folder), "payments")
    last = F.right("payment_id", F.lit(1))
    late, other = last == "3", last == "5"
    before = now.withColumns({
        "status_code": F.when(late, "PENDING").when(other, "SUCCEEDED").otherwise(F.col("status_code")),
        "succeeded_at": F.when(other, F.col("created_at") - F.make_interval(days=F.lit(40))).otherwise(F.col("succeeded_at")),
    })
    methods, root = payment_methods(now), scratch_dir(spark, "payments-late")
    grain, month = ["sk_payment", "sk_date_time"], F.floor(F.col("sk_date_time") / 10000).cast("int")

    def run(rows: DataFrame, changed: DataFrame) -> None:
        def build(groups: DataFrame | None) -> DataFrame:
            fact = facts.fact_payments(rows, methods, now=NOW)
            return fact if groups is None else touched.rows_of_groups(fact, groups, grain)

        def stale(stored: DataFrame) -> DataFrame:
            ids = changed.select(surrogate_key("payment_id", "country_code").alias("sk_payment"))
            return touched.touched_groups(grain, stored.join(ids, "sk_payment", "left_semi"), facts.fact_payments(changed, methods))

        touched.maintain(spark, f"{root}/fact", build, stale, grain, "month", month, f"{root}/stage")

    run(before, before.limit(0))
    run(now, now.filter(late | other))
    run(now, now.limit(0))
    return read_table(spark, f"{root}/fact").drop("month")


@entry_point
def kpi_late_tags(spark: SparkSession, folder: str) -> DataFrame:
    """The stored KPI fact after later transactions, and after players were tagged as testers, or not any more."""
    transactions, games = warehouse.transactions(spark, folder), catalog(spark, folder)
    log, day = warehouse.tags_log(spark, folder), F.floor(F.col("sk_date_time") / 100).cast("int")
    early = log.filter(F.col("modified_at") < F.lit(SPLIT).cast("timestamp"))
    tags_before, tags_now = (materialise(latest_per_key(rows, TAG_KEYS, "modified_at"), "tags") for rows in (early, log))
    fresh = F.col("created_at") >= F.lit(EVENTS_AS_OF).cast("timestamp")
    root, grain = scratch_dir(spark, "kpi-late"), ["sk_date_time", *PLAYER_KEYS]

    def run(rows: DataFrame, tagged: DataFrame, changed: DataFrame, changed_tags: DataFrame) -> None:
        keyed = rows.withColumn("sk_date_time", hour_key("created_at"))

        def build(groups: DataFrame | None) -> DataFrame:
            source = rows if groups is None else touched.rows_of_groups(keyed, groups, grain).drop("sk_date_time")
            return facts.fact_txn_kpi(source, tagged, games, now=NOW)

        def stale(stored: DataFrame) -> DataFrame:
            players = changed_tags.select(*PLAYER_KEYS).distinct()
            return touched.touched_groups(
                grain, facts.succeeded_game_transactions(changed), facts.succeeded_game_transactions(rows).join(players, PLAYER_KEYS, "left_semi"),
                stored.join(players, PLAYER_KEYS, "left_semi"))

        touched.maintain(spark, f"{root}/fact", build, stale, grain, "kpi_day", day, f"{root}/stage")

    run(transactions.filter(~fresh), tags_before, transactions.limit(0), log.limit(0))
    run(transactions, tags_now, transactions.filter(fresh), log.filter(F.col("modified_at") >= F.lit(SPLIT).cast("timestamp")))
    return read_table(spark, f"{root}/fact").drop("kpi_day")


@entry_point
def mart_hourly_late(spark: SparkSession, folder: str) -> DataFrame:
    """The stored hourly mart after rounds got new versions: they move to another hour, open again, or are new."""
    log = warehouse.rounds_log(spark, folder)
    late = F.col("created_at") >= F.lit(SPLIT).cast("timestamp")
    before, now = (materialise(facts.fact_gameround(latest_per_key(rows, ROUND_KEYS, "version")), "rounds-fact") for rows in (log.filter(~late), log))
    changed = materialise(log.filter(late).select(*ROUND_KEYS).distinct(), "changed-rounds")
    root, month = scratch_dir(spark, "mart-late"), F.floor(F.col("sk_date_time") / 10000).cast("int")

    def run(fact: DataFrame, stale: DataFrame) -> None:
        def build(groups: DataFrame | None) -> DataFrame:
            return marts.mart_gameround_hourly(fact if groups is None else touched.rows_of_groups(fact, groups, marts.HOURLY_GRAIN))

        touched.maintain(spark, f"{root}/mart", build, lambda stored: stale, marts.HOURLY_GRAIN, "month", month, f"{root}/stage")

    images = [fact.join(changed, ROUND_KEYS, "left_semi") for fact in (before, now)]
    run(before, before.select(*marts.HOURLY_GRAIN).limit(0))
    run(now, touched.touched_groups(marts.HOURLY_GRAIN, *images))
    return read_table(spark, f"{root}/mart").drop("month")


# --- dimensions --------------------------------------------------------------------------


def order_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly calendar over the days that have orders."""
    bounds = warehouse.table(spark, folder, "orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return calendar.in_zones(calendar.hours_between(bounds, F.col("first"), F.col("last")))


@entry_point
def dim_date_time(spark: SparkSession, folder: str) -> DataFrame:
    return order_calendar(spark, folder)


@entry_point
def distinct_hours(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.distinct_hours(order_calendar(spark, folder), VIENNA)


@entry_point
def dim_game(spark: SparkSession, folder: str) -> DataFrame:
    rows = enforce_schema(warehouse.games(spark, folder), contract("ig_game_catalog").schema)
    brand = enforce_schema(warehouse.brand_games(spark, folder), contract("ig_brand_game_catalog").schema)
    return dimensions.dim_game(rows, brand)


@entry_point
def dim_payment_method(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_payment_method(warehouse.payments(spark, folder))


# --- expressions -------------------------------------------------------------------------


@entry_point
def hour_keys(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return warehouse.table(spark, folder, "events").select(
        "event_id", hour_key(ts).alias("vienna_key"), hour_key(ts, "UTC").alias("utc_key"),
        minutes_between(F.date_trunc("day", ts), ts).alias("minutes_of_day"), iso_utc(ts).alias("iso_text"))


@entry_point
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.payments(spark, folder).select(
        "payment_id", surrogate_key("payment_id", "country_code").alias("sk_payment"),
        surrogate_key("payment_method", "provider_name", "gateway_name", "payment_type").alias("sk_method"))


@entry_point
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean_str(F.concat(F.lit(" \t"), F.col("text"), F.lit("\n ")))
    rows = warehouse.table(spark, folder, "documents").select("doc_id", cleaned.alias("_c"))
    return rows.select("doc_id", F.md5("_c").alias("cleaned_md5"), F.length("_c").alias("cleaned_length"),
                       F.md5(truncated("_c", 2000)).alias("head_md5"))


# --- enforcement and upserts ---------------------------------------------------------------


@entry_point
def enforced_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Text-typed rounds with one column missing and one extra, brought to the contract."""
    raw = warehouse.rounds_log(spark, folder)
    raw = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns if c != "finished_at"],
                     F.lit("x").alias("rogue"))
    return stamp(enforce_schema(raw, contract("ig_round").schema), now=NOW)


@entry_point
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    return rounds(spark, folder)


def _split_rounds(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rounds known before the split day, and what arrived since, both latest per key."""
    log = warehouse.rounds_log(spark, folder)
    early = F.col("created_at") < F.lit(SPLIT).cast("timestamp")
    return (latest_per_key(log.filter(early), ROUND_KEYS, "version"),
            latest_per_key(log.filter(~early), ROUND_KEYS, "version"))


@entry_point
def upsert_versioned(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _split_rounds(spark, folder)
    return merge.upsert(target, source, ROUND_KEYS, "version")


@entry_point
def upsert_stale(spark: SparkSession, folder: str) -> DataFrame:
    """Older versions arriving late change nothing that is stored, and add what is new."""
    late, current = (materialise(part, "rounds") for part in _split_rounds(spark, folder))
    changes = materialise(merge.classify_upsert(current, late, ROUND_KEYS, "version"), "changes")
    return merge.apply_changes(current, changes, ROUND_KEYS)


@entry_point
def upsert_counts(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _split_rounds(spark, folder)
    return merge.upsert_metrics(merge.classify_upsert(target, source, ROUND_KEYS, "version"))


@entry_point
def keyed_merge(spark: SparkSession, folder: str) -> DataFrame:
    return merge.keyed_merge(*_split_rounds(spark, folder), ROUND_KEYS)


# --- history -------------------------------------------------------------------------------


@entry_point
def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    return tag_history(spark, folder)


@entry_point
def scd2_players(spark: SparkSession, folder: str) -> DataFrame:
    return player_history(spark, folder)


@entry_point
def scd2_limits(spark: SparkSession, folder: str) -> DataFrame:
    return history.build_history(warehouse.limits_log(spark, folder), LIMIT_KEYS, "modified_at")


def _tag_snapshot(spark: SparkSession, folder: str, drop_inactive: bool) -> DataFrame:
    """Tag history up to the split day, then one snapshot run over the latest state."""
    log = warehouse.tags_log(spark, folder)
    before = log.filter(F.col("modified_at") < F.lit(SPLIT).cast("timestamp"))
    stored = materialise(history.build_history(before, TAG_KEYS, "modified_at"), "tag-history")
    source = materialise(tags(spark, folder), "tags")
    if drop_inactive:
        source = source.filter(F.col("is_active") == 1)
    return history.snapshot(stored, source, TAG_KEYS, "modified_at", run_at=NOW)


@entry_point
def scd2_step(spark: SparkSession, folder: str) -> DataFrame:
    return _tag_snapshot(spark, folder, drop_inactive=False)


@entry_point
def scd2_hard_delete(spark: SparkSession, folder: str) -> DataFrame:
    return _tag_snapshot(spark, folder, drop_inactive=True)


@entry_point
def scd2_table(spark: SparkSession, folder: str) -> DataFrame:
    """The stored tag history after three runs: the early state, a later one without inactive tags, all tags again."""
    log = warehouse.tags_log(spark, folder)
    early = log.filter(F.col("modified_at") < F.lit(SPLIT).cast("timestamp"))
    late = materialise(tags(spark, folder), "tags")
    table = HistoryTable(spark, f"{scratch_dir(spark, 'tag-history')}/tags", TAG_KEYS, "modified_at", log.schema, buckets=4)
    table.step(materialise(latest_per_key(early, TAG_KEYS, "modified_at"), "early-tags"), run_at=SPLIT)
    table.step(late.filter(F.col("is_active") == 1), run_at=NOW)
    table.step(late, run_at=NOW)
    table.step(late, run_at=NOW)
    return table.read()


@entry_point
def current_rows(spark: SparkSession, folder: str) -> DataFrame:
    return history.current_rows(player_history(spark, folder)).select(*PLAYER_KEYS, "account_tier", "valid_from")


@entry_point
def point_in_time_join(spark: SparkSession, folder: str) -> DataFrame:
    """Each purchase with the limit in force at that moment."""
    limits = history.build_history(warehouse.limits_log(spark, folder), LIMIT_KEYS, "modified_at")
    return timeline.as_of_join(warehouse.purchases(spark, folder), limits, PLAYER_KEYS, "happened_at",
                               ["limit_value", "valid_from"])


@entry_point
def classification_at(spark: SparkSession, folder: str) -> DataFrame:
    """Each purchase with the classifications active at that moment."""
    log = warehouse.classifications_log(spark, folder)
    spans = history.build_history(log, TAG_KEYS, "modified_at").filter(F.col("is_active") == 1)
    labels = {f"CLASS_{i}": f"class_{i}" for i in range(3)}
    return timeline.active_flags_at(warehouse.purchases(spark, folder), spans, PLAYER_KEYS, "happened_at",
                                    "tag_category", labels)


@entry_point
def rows_in_force(spark: SparkSession, folder: str) -> DataFrame:
    """Each purchase with all classifications and limits in force at that moment, a row for each."""
    spans = history.build_history(warehouse.classifications_log(spark, folder), TAG_KEYS, "modified_at").filter(F.col("is_active") == 1)
    limits = history.build_history(warehouse.limits_log(spark, folder), LIMIT_KEYS, "modified_at")
    every = spans.select(*PLAYER_KEYS, F.col("tag_category").alias("in_force"), "valid_from", "valid_to").unionByName(
        limits.select(*PLAYER_KEYS, F.lit("LIMIT").alias("in_force"), "valid_from", "valid_to"))
    return overlaps.rows_in_force(warehouse.purchases(spark, folder), materialise(every, "intervals"), PLAYER_KEYS, "happened_at",
                                  ["in_force", "valid_from"])


# --- incremental filters ---------------------------------------------------------------------


@entry_point
def high_water_mark(spark: SparkSession, folder: str) -> DataFrame:
    rows = warehouse.payments(spark, folder)
    loaded = rows.filter(F.col("created_at") < F.lit(SPLIT).cast("timestamp"))
    return incremental.above_watermark(rows, loaded, "created_at").select("payment_id", "created_at")


@entry_point
def high_water_mark_empty(spark: SparkSession, folder: str) -> DataFrame:
    """A first load: rows without a time and from before 1970 are loaded too."""
    last = F.right("payment_id", F.lit(1))
    rows = warehouse.payments(spark, folder).select("payment_id", F.when(last == "7", F.lit("1960-05-01").cast("timestamp"))
                                                    .when(last != "3", F.col("created_at")).alias("created_at"))
    return incremental.above_watermark(rows, rows.filter("false"), "created_at")


@entry_point
def lookback_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    rows = incremental.since_lookback(warehouse.transactions(spark, folder), "created_at", 2, EVENTS_AS_OF)
    return rows.select("transaction_id", "created_at", "amount_eur")


@entry_point
def lookback_hour_key(spark: SparkSession, folder: str) -> DataFrame:
    fact = payments_fact(spark, folder).select("sk_payment", "sk_date_time", "amount_eur")
    return incremental.since_hour_lookback(fact, "sk_date_time", 30, ORDERS_AS_OF)


# --- player summary and outbox -----------------------------------------------------------------


def _histories(spark: SparkSession, folder: str, before: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Player and tag histories, of all changes or of those before a time."""
    logs = []
    for log, keys, at in ((warehouse.players_log, PLAYER_KEYS, "changed_at"), (warehouse.tags_log, TAG_KEYS, "modified_at")):
        rows = log(spark, folder)
        if before is not None:
            rows = rows.filter(F.col(at) < F.lit(before).cast("timestamp"))
        logs.append(materialise(history.build_history(rows, keys, at), "history"))
    return logs[0], logs[1]


def staged_outbox(spark: SparkSession, folder: str) -> DataFrame:
    players = materialise(player_history(spark, folder), "players")
    tagged = materialise(tag_history(spark, folder), "tags")
    return marts.player_summary(players, tagged, sent_at=NOW)


@entry_point
def tag_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rows = marts.tag_rollup(tag_history(spark, folder))
    names = F.transform("tag_categories", lambda t: t["tag_category"])
    return rows.withColumn("tag_categories", F.array_join(names, ","))


def _loaded_earlier(spark: SparkSession, folder: str) -> DataFrame:
    """The outbox that the model had staged before the split."""
    return materialise(marts.player_summary(*_histories(spark, folder, SPLIT), sent_at=NOW), "outbox")


@entry_point
def changed_entities(spark: SparkSession, folder: str) -> DataFrame:
    return marts.changed_players(*_histories(spark, folder), _loaded_earlier(spark, folder))


@entry_point
def player_summary(spark: SparkSession, folder: str) -> DataFrame:
    return staged_outbox(spark, folder)


@entry_point
def player_summary_increment(spark: SparkSession, folder: str) -> DataFrame:
    return marts.player_summary(*_histories(spark, folder), _loaded_earlier(spark, folder), sent_at=NOW)


@entry_point
def outbox_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """The outbox as a table: staged, delivered, staged for later changes, and a quiet last run."""
    root = scratch_dir(spark, "outbox")
    path, keys = f"{root}/outbox", list(outbox.OUTBOX_KEYS)

    def fold(rows: DataFrame, step: str) -> DataFrame:
        merge.merge_table(spark, path, materialise(rows, step), keys, ["country_code"], f"{root}/stage-{step}")
        return read_table(spark, path)

    now = _histories(spark, folder)
    stored = fold(_loaded_earlier(spark, folder), "first")
    stored = fold(outbox.apply_results(stored, delivery_results(spark, folder), now=NOW), "delivered")
    stored = fold(marts.player_summary(*now, stored, sent_at=NOW), "changed")
    again = marts.player_summary(*now, stored, sent_at=NOW).count()
    return stored.withColumn("staged_again", F.lit(again).cast("bigint"))


@entry_point
def outbox_classify(spark: SparkSession, folder: str) -> DataFrame:
    return outbox.classify_attempts(warehouse.attempts(spark, folder).drop("body"))


def delivery_results(spark: SparkSession, folder: str) -> DataFrame:
    """Last attempt per outbox row, as ok and error text.

    Texts are cut to what the outbox keeps, and columns left out, before rows are sorted.
    """
    tried = warehouse.attempts(spark, folder).select(
        *outbox.OUTBOX_KEYS, "attempted_at", "event_id", "status", truncated("body", outbox.ERROR_LENGTH).alias("body"))
    last = latest_per_key(tried, list(outbox.OUTBOX_KEYS), "attempted_at", ["event_id"])
    return last.select(*outbox.OUTBOX_KEYS, (F.col("status") == outbox.STATUS_OK).alias("ok"),
                       F.col("body").alias("error"))


def delivered_outbox(spark: SparkSession, folder: str) -> DataFrame:
    return outbox.apply_results(staged_outbox(spark, folder), delivery_results(spark, folder), now=NOW)


@entry_point
def outbox_pending(spark: SparkSession, folder: str) -> DataFrame:
    return outbox.pending(delivered_outbox(spark, folder), include_failed=False).select(
        *outbox.OUTBOX_KEYS, "source_updated_at", "dispatched_at")


@entry_point
def outbox_apply(spark: SparkSession, folder: str) -> DataFrame:
    rows = delivered_outbox(spark, folder)
    return rows.select(*outbox.OUTBOX_KEYS, "dispatched_at", F.md5("dispatch_error").alias("error_md5"),
                       F.length("dispatch_error").alias("error_length"))


@entry_point
def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    return outbox.dead_letters(delivered_outbox(spark, folder)).select(*outbox.OUTBOX_KEYS, "source_updated_at")


@entry_point
def dispatch_summary(spark: SparkSession, folder: str) -> DataFrame:
    return outbox.dispatch_summary(delivery_results(spark, folder), elapsed_seconds=10.0)


# --- data quality --------------------------------------------------------------------------------


@entry_point
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.not_null(warehouse.payments(spark, folder), "gateway_name").select("payment_id", "payment_method")


@entry_point
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.unique(warehouse.rounds_log(spark, folder), ROUND_KEYS)


@entry_point
def dq_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return quality.accepted_values(warehouse.payments(spark, folder), "payment_type", ["DEPOSIT", "WITHDRAWAL", "REFUND"])


@entry_point
def dq_accepted_ci(spark: SparkSession, folder: str) -> DataFrame:
    return quality.accepted_values(warehouse.payments(spark, folder), "payment_type", ["deposit", "Refund"], ignore_case=True)


@entry_point
def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    child = facts.succeeded_game_transactions(warehouse.transactions(spark, folder))
    keyed = child.select(surrogate_key("game_id", "country_code").alias("sk_game"))
    parent = catalog(spark, folder).select(surrogate_key("game_id", "country_code").alias("sk_game"))
    return quality.relationships(keyed, "sk_game", parent, "sk_game")


@entry_point
def dq_formula(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds whose stored revenue differs from bet minus win: here tax was added on purpose."""
    fact = rounds_fact(spark, folder)
    stored = fact.withColumn("ggr_eur", F.col("ggr_eur") + F.col("tax_amount_eur"))
    failing = quality.formula_mismatch(stored, "ggr_eur", F.col("bet_amount_eur") - F.col("win_amount_eur"))
    return failing.select(*ROUND_KEYS, "ggr_eur", "expected", "deviation")


@entry_point
def dq_positive(spark: SparkSession, folder: str) -> DataFrame:
    return quality.not_positive(rounds(spark, folder), "bet_amount_eur").select(*ROUND_KEYS, "bet_amount_eur")


@entry_point
def dq_future(spark: SparkSession, folder: str) -> DataFrame:
    return quality.future_hour_keys(payments_fact(spark, folder), as_of=ORDERS_AS_OF).select(
        "sk_payment", "sk_date_time", "created_at")


@entry_point
def dq_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return quality.bad_share(warehouse.trips(spark, folder), F.col("started_at") > F.col("ended_at"))


@entry_point
def dq_order(spark: SparkSession, folder: str) -> DataFrame:
    daily = trips.daily_ride_summary(trips.silver(warehouse.trips(spark, folder)))
    shifted = daily.withColumn("avg_trip_duration_mins", F.col("avg_trip_duration_mins") * 3)
    return quality.out_of_order(shifted, "min_trip_duration_mins", "avg_trip_duration_mins", "max_trip_duration_mins")


@entry_point
def dq_map_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Trips from unnamed stations carry metadata without a run id."""
    whole = trips.run_metadata("trips", "run-1", "silver", NOW)
    partial = F.create_map(F.lit("pipeline_id"), F.lit("trips"))
    rows = warehouse.trips(spark, folder)
    rows = rows.withColumn("metadata", F.when(F.col("start_station_name").isNull(), partial).otherwise(whole))
    return quality.missing_map_keys(rows, "metadata", trips.METADATA_KEYS).select("ride_id", "start_station_id")


def payment_checks() -> list[quality.RowCheck]:
    return [
        quality.RowCheck("sk_payment_not_null", F.col("sk_payment").isNull()),
        quality.RowCheck("amount_positive", F.col("amount_eur") <= 0),
        quality.RowCheck("country_accepted", ~F.col("country_code").isin(*COUNTRIES)),
        quality.RowCheck("method_known", F.col("sk_payment_method").isNull(), "warn"),
    ]


@entry_point
def dq_observed(spark: SparkSession, folder: str) -> DataFrame:
    """The same row checks, counted while the fact is written."""
    watched = quality.ObservedChecks(payments_fact(spark, folder), payment_checks())
    merge.overwrite_table(watched.rows, f"{scratch_dir(spark, 'payments')}/fact", ["country_code"])
    return watched.report()


@entry_point
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """Row checks of the payment fact in one pass, and its key checks."""
    fact = materialise(payments_fact(spark, folder), "payments-fact")
    hours = calendar.distinct_hours(order_calendar(spark, folder), VIENNA)
    keys = quality.tally({
        "sk_payment_unique": ("error", quality.unique(fact, "sk_payment")),
        "hour_in_calendar": ("warn", quality.relationships(fact, "sk_date_time", hours, "sk_date_time")),
        "table_not_empty": ("error", quality.empty_table(fact)),
    })
    return quality.run_row_checks(fact, payment_checks()).unionByName(keys)


# --- streaming -----------------------------------------------------------------------------------


class RoundStreams:
    """Landing, bronze and silver folders of the rounds table for all countries."""

    table = "ig_round"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.root = scratch_dir(spark, "streams")
        self.spec = contract(self.table)
        self.silver_path = f"{self.root}/silver/{self.table}"
        self.log_path = f"{self.root}/silver-log/{self.table}"
        self.buckets = 4

    def land(self, rows: DataFrame, one_file: bool = False) -> None:
        """New files per country; the country is part of the folder, not of the rows.

        Each country is written by itself, so no task sorts its rows by country first. With
        ``one_file`` all tasks read, and one task for each country writes.
        """
        def write(country: str) -> None:
            own = rows.filter(F.col(TENANT) == country).drop(TENANT)
            if not own.isEmpty():
                (own.repartition(1) if one_file else own).write.mode("append").option("compression", COMPRESSION).parquet(f"{self.root}/landing/{self.table}/{TENANT}={country}")

        self.for_each_country(write)

    def _checkpoint(self, layer: str, country: str) -> str:
        return f"{self.root}/checkpoints/{layer}/{country}/{self.table}"

    def ingest(self, country: str) -> bronze.IngestReport:
        return bronze.ingest(self.spark, country, f"{self.root}/landing/{self.table}/country_code={country}",
                             bronze.bronze_dir(f"{self.root}/bronze", country, self.table),
                             self._checkpoint("bronze", country))

    def merge(self, country: str) -> silver.UpsertReport:
        return silver.upsert_stream(
            self.spark, self.spec, country, bronze.bronze_dir(f"{self.root}/bronze", country, self.table),
            self._checkpoint("bronze", country), self.silver_path, self._checkpoint("silver", country), now=NOW,
            buckets=self.buckets)

    def append(self, country: str, compact_share: float | None = change_log.COMPACT_SHARE) -> change_log.SilverLog:
        """The same merge into the change-log layout."""
        return change_log.append_stream(
            self.spark, self.spec, country, bronze.bronze_dir(f"{self.root}/bronze", country, self.table),
            self._checkpoint("bronze", country), self.log_path, self._checkpoint("silver-log", country), now=NOW,
            buckets=self.buckets, compact_share=compact_share)

    def for_each_country(self, step: Callable) -> dict:
        with ThreadPoolExecutor(len(COUNTRIES)) as pool:
            return dict(zip(COUNTRIES, pool.map(step, COUNTRIES)))

    def bronze_rows(self) -> DataFrame:
        parts = [bronze.read_bronze(self.spark, bronze.bronze_dir(f"{self.root}/bronze", c, self.table),
                                    self._checkpoint("bronze", c)) for c in COUNTRIES]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        return out

    def silver_rows(self) -> DataFrame:
        return silver.read_silver(self.spark, self.silver_path, self.spec)

    def log_rows(self) -> DataFrame:
        return change_log.read_silver_log(self.spark, self.log_path, self.spec, buckets=self.buckets)


def _drops(spark: SparkSession, folder: str) -> list[DataFrame]:
    log = warehouse.rounds_log(spark, folder)
    early = F.col("created_at") < F.lit(SPLIT).cast("timestamp")
    return [log.filter(early), log.filter(~early)]


@entry_point
def stream_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Two landings, the second with new files and one more column, and an idle rerun."""
    streams = RoundStreams(spark, folder)
    early, late = _drops(spark, folder)
    for drop in (early.drop("win_count"), late):
        streams.land(drop)
        streams.for_each_country(streams.ingest)
    streams.for_each_country(streams.ingest)
    return streams.bronze_rows().drop(bronze.FILE_COLUMN, bronze.TIME_COLUMN)


@entry_point
def stream_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """A new column, a widened number, and a column whose type changes altogether."""
    streams = RoundStreams(spark, folder)
    early, late = _drops(spark, folder)
    text = F.concat(F.lit("closed "), F.col("is_closed").cast("string"))
    streams.land(late.withColumn("bet_count", F.col("bet_count").cast("long")))
    streams.for_each_country(streams.ingest)
    streams.land(early.drop("win_count").withColumns({"bet_count": F.col("bet_count").cast("int"), "is_closed": text}))
    streams.for_each_country(streams.ingest)
    streams.for_each_country(streams.ingest)
    return streams.bronze_rows().drop(bronze.FILE_COLUMN, bronze.TIME_COLUMN)


@entry_point
def stream_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Each landing drained into bronze and folded into silver."""
    streams = RoundStreams(spark, folder)
    for drop in _drops(spark, folder):
        streams.land(drop)
        streams.for_each_country(streams.ingest)
        streams.for_each_country(streams.append)
    return streams.log_rows()


@entry_point
def stream_silver_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """The same into the layout that rewrites the touched buckets."""
    streams = RoundStreams(spark, folder)
    for drop in _drops(spark, folder):
        streams.land(drop)
        streams.for_each_country(streams.ingest)
        streams.for_each_country(streams.merge)
    return streams.silver_rows()


@entry_point
def silver_log(spark: SparkSession, folder: str) -> DataFrame:
    """Reads of a change log behind a compacted base, before and after the log is folded in.

    A third landing brings all rows of the first once more; none of them is newer.
    """
    streams = RoundStreams(spark, folder)
    early, late = _drops(spark, folder)
    for drop, share in ((early, 0.0), (late, None), (early, None)):
        streams.land(drop)
        streams.for_each_country(streams.ingest)
        tables = streams.for_each_country(lambda country: streams.append(country, share))
    before = materialise(streams.log_rows(), "before-compaction")
    streams.for_each_country(lambda country: tables[country].compact())
    return before.withColumn("compacted", F.lit(0)).unionByName(streams.log_rows().withColumn("compacted", F.lit(1)))


@entry_point
def stream_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Ingested files and rows and upsert counts per landing and country; a landing is one file for each country."""
    streams = RoundStreams(spark, folder)
    rows = []
    for number, drop in enumerate(_drops(spark, folder), start=1):
        streams.land(drop, one_file=True)
        loaded = streams.for_each_country(streams.ingest)
        merged = streams.for_each_country(streams.merge)
        rows += [(number, c, loaded[c].files, loaded[c].rows, merged[c].inserted, merged[c].updated, merged[c].unchanged)
                 for c in COUNTRIES]
    return spark.createDataFrame(
        rows, "landing int, country_code string, files_ingested long, rows_ingested long, inserted long, updated long, unchanged long")
