import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierstone.contracts import contract
from tierstone.functions.keys import surrogate_key
from tierstone.functions.times import VIENNA
from tierstone.operators.enforce import enforce_schema
from tierstone.operators.history import build_history
from tierstone.plans import dimensions, facts, marts
from tierstone.sources import calendar


def fill(spark, table, rows, extra=""):
    """Rows given as dicts, brought to a contract."""
    keep = [c.split()[0] for c in extra.split(",") if c]
    names = sorted({k for r in rows for k in r})
    text = spark.createDataFrame([tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows],
                                 ", ".join(f"{n} string" for n in names))
    df = enforce_schema(text, contract(table).schema)
    if keep:
        keys = contract(table).primary_key
        df = df.join(text.select(keys, *[F.col(c).cast("int").alias(c) for c in keep]), keys)
    return df


def test_only_closed_rounds(spark):
    base = {"player_id": "A", "country_code": "de", "game_id": "X", "currency_code": "EUR", "is_promotional": 0,
            "bonus_bet_amount_eur": 0, "bonus_win_amount_eur": 0, "tax_amount_eur": 0, "bet_count": 1,
            "created_at": "2026-01-15 10:00:00", "ingested_at": "2026-01-15 10:05:00", "updated_at": "2026-01-15 10:01:00"}
    rounds = fill(spark, "ig_round", [
        {**base, "round_id": "ROUND-001", "is_closed": 1, "bet_amount_eur": 10.0, "win_amount_eur": 5.0},
        {**base, "round_id": "ROUND-002", "is_closed": 0, "bet_amount_eur": 20.0, "win_amount_eur": 0.0}])
    rows = facts.fact_gameround(rounds).collect()
    assert [(r.round_id, float(r.ggr_eur), r.sk_date_time) for r in rows] == [("ROUND-001", 5.0, 2026011511)]
    by_creation = facts.fact_gameround(rounds.withColumn("created_at", F.lit("2026-01-15 20:00:00").cast("timestamp")), hour_col="created_at")
    assert by_creation.first().sk_date_time == 2026011521


def test_high_water_mark_on_an_empty_target_loads_all(spark):
    rounds = fill(spark, "ig_round", [
        {"round_id": "1", "country_code": "de", "is_closed": 1, "updated_at": "2026-01-01 00:00:00"},
        {"round_id": "2", "country_code": "de", "is_closed": 1, "updated_at": "2026-01-02 00:00:00"}])
    full = facts.fact_gameround(rounds)
    assert facts.fact_gameround(rounds, full.limit(0)).count() == 2
    assert facts.fact_gameround(rounds, full).count() == 0
    assert [r.round_id for r in facts.fact_gameround(rounds, full, inclusive=True).collect()] == ["2"]


PAYMENT = {"country_code": "de", "status_code": "SUCCEEDED", "payment_type": "DEPOSIT", "gateway_name": "PAYMENT_IQ",
           "created_at": "2026-01-15 10:00:00", "succeeded_at": "2026-01-15 10:01:00"}


def test_net_amount_and_first_deposit(spark):
    pay = fill(spark, "ig_payment", [
        {**PAYMENT, "payment_id": "PAY-001", "payment_method": "CARD", "provider_name": "NUVEI", "amount_eur": 100.0, "fee_eur": 2.5, "first_of_type": 0},
        {**PAYMENT, "payment_id": "PAY-002", "payment_method": "WALLET", "provider_name": "PAYPAL", "amount_eur": 50.0, "first_of_type": 1},
        {**PAYMENT, "payment_id": "PAY-003", "payment_method": "VOUCHER", "provider_name": None, "amount_eur": 5.0}])
    methods = dimensions.dim_payment_method(pay)
    assert methods.count() == 2
    rows = {r.payment_id: r for r in facts.fact_payments(pay, methods).collect()}
    assert (float(rows["PAY-001"].net_amount_eur), rows["PAY-001"].is_first_deposit) == (97.5, 0)
    assert (float(rows["PAY-002"].net_amount_eur), rows["PAY-002"].fee_eur, rows["PAY-002"].is_first_deposit) == (50.0, None, 1)
    assert rows["PAY-001"].sk_payment_method and rows["PAY-003"].sk_payment_method is None
    assert rows["PAY-003"].is_first_deposit == 0


def test_declined_retries_and_open_payments_are_left_out(spark):
    pay = fill(spark, "ig_payment", [
        {**PAYMENT, "payment_id": "PAY-VALID"},
        {**PAYMENT, "payment_id": "PAY-RETRY", "declined_deposit_id": "PAY-ORIGINAL-001"},
        {**PAYMENT, "payment_id": "PAY-PENDING", "status_code": "PENDING"},
        {**PAYMENT, "payment_id": "PAY-OLD", "created_at": "2026-01-10 10:00:00"}])
    methods = dimensions.dim_payment_method(pay)
    assert {r.payment_id for r in facts.fact_payments(pay, methods).collect()} == {"PAY-VALID", "PAY-OLD"}
    recent = facts.fact_payments(pay, methods, incremental=True, as_of="2026-01-16")
    assert {r.payment_id for r in recent.collect()} == {"PAY-VALID"}


def txn(i, **how):
    return {"transaction_id": str(i), "player_id": "P", "country_code": "de", "game_id": " G ", "currency_code": "EUR",
            "transaction_type": "BET", "transaction_status": "SUCCEEDED", "created_at": "2025-06-01 10:15:00",
            "amount_eur": 10, "amount_real_eur": 7, "amount_bonus_eur": 3, "is_promotional": 0, **how}


def test_txn_kpi(spark):
    rows = [
        txn(1), txn(2, transaction_type="ROLLBACK_BET", amount_eur=4, amount_real_eur=4, amount_bonus_eur=None),
        txn(3, transaction_type="WIN", amount_eur=6, amount_real_eur=1, amount_bonus_eur=5, is_promotional=1),
        txn(4, transaction_type="ROLLBACK_WIN", amount_eur=2, amount_real_eur=2, amount_bonus_eur=0, is_promotional=1),
        txn(5, amount_eur=None), txn(6, transaction_status="FAILED"), txn(7, game_id="  "), txn(8, game_id=None),
        txn(9, player_id="TESTER"), txn(10, player_id="EX_TESTER"), txn(11, game_id="UNSEEN"),
        txn(12, created_at="2025-10-26 00:30:00"), txn(13, created_at="2025-10-26 01:30:00"),
        txn(14, player_id=None), txn(15, player_id="TESTER", country_code="at"),
    ]
    tag = {"country_code": "de", "target_type": "User", "is_active": 1}
    tags = fill(spark, "ig_player_tag", [
        {**tag, "tag_id": "1", "player_id": "TESTER", "tag_category": "TEST"},
        {**tag, "tag_id": "2", "player_id": "TESTER", "tag_category": "TEST"},
        {**tag, "tag_id": "3", "player_id": "EX_TESTER", "tag_category": "TEST", "is_active": 0},
        {**tag, "tag_id": "4", "player_id": "P", "tag_category": "CASINO_PLAYER"},
        {**tag, "tag_id": "5", "player_id": "P", "tag_category": "SPORTS_PLAYER", "is_active": 0},
        {**tag, "tag_id": "6", "player_id": "P", "tag_category": "TEST", "target_type": "Device"}])
    games = fill(spark, "ig_game_catalog", [{"game_id": "G", "country_code": "de", "game_vertical": "Casino", "game_studio": "S", "game_type": "SLOT"}])
    dim = dimensions.dim_game(games, fill(spark, "ig_brand_game_catalog", [{"brand_game_id": "x", "game_id": "other"}]))
    out = facts.fact_txn_kpi(fill(spark, "ig_transaction", rows, "is_promotional int"), tags, dim)
    got = {(r.player_id, r.country_code, r.game_id, r.sk_date_time): r for r in out.collect()}
    main = got.pop(("P", "de", "G", 2025060112))
    assert [float(main[c]) for c in ("bets_eur", "wins_eur", "ggr_eur", "bets_real_eur", "wins_real_eur", "ggr_real_eur",
                                     "bets_bonus_eur", "wins_bonus_eur", "ggr_bonus_eur", "promo_wins_bonus_eur", "total_promo_wins_eur")] == \
        [6, 4, 2, 3 + 7, -1, 11, 3 + 3, 5, 1, 5, 6]
    assert (main.src_row_count, main.is_casino_player, main.is_sports_player) == (5, 1, 0)
    assert (main.vertical, main.studio, main.game_type) == ("Casino", "S", "SLOT")
    assert got[("P", "de", "UNSEEN", 2025060112)].vertical == "UNKNOWN"
    assert got[("P", "de", "G", 2025102602)].src_row_count == 2, "both hours of the clock change share a key"
    assert set(got) == {("P", "de", "UNSEEN", 2025060112), ("P", "de", "G", 2025102602), ("EX_TESTER", "de", "G", 2025060112),
                        (None, "de", "G", 2025060112), ("TESTER", "at", "G", 2025060112)}
    plain = facts.fact_txn_kpi(fill(spark, "ig_transaction", rows), tags, dim)
    assert float(plain.agg(F.sum("promo_wins_bonus_eur")).first()[0]) == 0, "promotional is optional"


def test_game_revenue(spark):
    rows = [txn(1), txn(2, transaction_type="ROLLBACK_ROUND"), txn(3, transaction_type="CASHOUT"), txn(4, transaction_type="OTHER")]
    out = facts.fact_game_revenue(fill(spark, "ig_transaction", rows)).orderBy("transaction_id").collect()
    assert [(float(r.bet_eur), float(r.win_eur), float(r.ggr_eur)) for r in out] == [(10, 0, 10), (-10, 0, -10), (0, 10, -10), (0, 0, 0)]


def test_dim_game_keeps_its_grain(spark):
    games = fill(spark, "ig_game_catalog", [{"game_id": "1", "country_code": "de", "game_name": "n"}, {"game_id": "2", "country_code": "de"}])
    brand = fill(spark, "ig_brand_game_catalog", [
        {"brand_game_id": "a", "game_id": "1", "country_code": "de", "provider_name": "old", "updated_at": "2024-01-01 00:00:00"},
        {"brand_game_id": "b", "game_id": "1", "country_code": "de", "provider_name": "new", "updated_at": "2024-02-01 00:00:00",
         "disabled_at": "+10000-01-01 00:00:00", "enabled_at": "2024-01-01 00:00:00"},
        {"brand_game_id": "c", "game_id": "1", "country_code": "at", "provider_name": "foreign", "updated_at": "2024-03-01 00:00:00"}])
    rows = {r.game_id: r for r in dimensions.dim_game(games, brand).collect()}
    assert len(rows) == 2
    assert rows["1"].game_provider_id == "new" and rows["1"].brand_disabled_at is None and rows["1"].brand_enabled_at
    assert rows["2"].game_provider_id is None


def test_calendar(spark):
    spine = calendar.hour_spine(spark).cache()
    assert spine.count() == 35040
    assert spine.select("sk_date_time", "timezone").distinct().count() == 35038
    vienna = spine.filter(F.col("timezone") == VIENNA)
    assert vienna.filter("sk_date_time = 2025033002").count() == 0
    assert vienna.filter("sk_date_time = 2025102602").count() == 2
    row = vienna.filter("ts_utc = timestamp'2025-06-30 22:00:00'").first()
    assert (row.sk_date_time, row.hour, row.day, row.month, row.year, row.quarter) == (2025070100, 0, 1, 7, 2025, 3)
    hours = calendar.distinct_hours(spine)
    assert hours.count() == hours.select("sk_date_time").distinct().count() == 35038 - 17520
    assert [f.dataType.simpleString() for f in spine.schema][:7] == ["int", "date", "tinyint", "tinyint", "tinyint", "int", "tinyint"]


def test_hourly_mart(spark):
    schema = ("round_id string, sk_date_time int, sk_game string, country_code string, sk_player string, is_promotional int, bet_count int, "
              "win_count int, bet_amount_eur decimal(34,4), win_amount_eur decimal(34,4), bonus_bet_amount_eur decimal(34,4), "
              "bonus_win_amount_eur decimal(34,4), tax_amount_eur decimal(34,4)")
    from decimal import Decimal as D
    fact = spark.createDataFrame([
        ("1", 2025060310, "g", "de", "p1", 1, 2, 1, D(30), D(10), D(3), D(1), D(2)),
        ("2", 2025060310, "g", "de", "p1", 0, 1, 0, D(0), D(0), D(0), D(0), D(0)),
        ("3", 2025060310, "g", "de", "p2", 0, 1, 0, D(0), D(5), D(0), D(0), D(0)),
        ("4", 2025060223, "g", "de", "p2", 0, 1, 0, D(0), D(5), D(0), D(0), D(0))], schema)
    rows = {r.sk_date_time: r for r in marts.mart_gameround_hourly(fact, revenue_per_player=True).collect()}
    r = rows[2025060310]
    assert (r.rounds, r.active_players, r.total_bet_count, r.total_win_count, r.promo_rounds) == (3, 2, 4, 1, 1)
    assert [float(x) for x in (r.ggr_eur, r.ngr_eur, r.bonus_bet_ratio, r.win_rate, r.revenue_per_player)] == [15, 12, 0.1, 0.5, 15]
    late = rows[2025060223]
    assert (late.promo_rounds, late.bonus_bet_ratio, late.win_rate) == (None, None, None)
    recent = marts.mart_gameround_hourly(fact, incremental=True, as_of="2025-06-05", zero_fill=True)
    assert [(r.sk_date_time, r.promo_rounds) for r in recent.collect()] == [(2025060310, 1)]


@pytest.fixture()
def people(spark):
    player = "player_id string, country_code string, changed timestamp, player_alias string, region_code string, account_tier string, is_verified tinyint, created_at timestamp"
    tag = "tag_id string, player_id string, country_code string, changed timestamp, target_type string, tag_category string, is_active tinyint"
    d = lambda n: datetime(2024, 1, n)
    players = spark.createDataFrame([
        ("quiet", "de", d(1), "a", "b", "c", 1, d(1)), ("profile", "de", d(1), "a", "b", "c", 1, d(1)),
        ("profile", "de", d(9), " null ", "b\n", "c", 1, d(1)), ("tagged", "de", d(1), "a", "b", "c", 0, None),
        ("untagged", "de", d(1), "a", "b", "c", 0, d(1))], player)
    tags = spark.createDataFrame([
        ("1", "quiet", "de", d(1), "User", "VIP", 1), ("2", "quiet", "de", d(2), "User", "CASINO", 1),
        ("3", "tagged", "de", d(1), "User", "VIP", 1), ("3", "tagged", "de", d(8), "User", "VIP", 0),
        ("4", "untagged", "de", d(8), "Device", "VIP", 1)], tag)
    keys = ["player_id", "country_code"]
    return build_history(players, keys, "changed"), build_history(tags, ["tag_id", "country_code"], "changed")


def test_player_summary(spark, people):
    rows = {r.online_customer_id: r for r in marts.player_summary(*people, sent_at="2024-03-01 00:00:00").collect()}
    assert set(rows) == {"quiet", "profile", "tagged", "untagged"}
    assert rows["quiet"].tag_updated_at == datetime(2024, 1, 2)
    assert rows["tagged"].tag_updated_at is None and rows["untagged"].tag_updated_at is None
    assert rows["profile"].player_alias is None and rows["profile"].source_updated_at == datetime(2024, 1, 9)
    payload = json.loads(rows["profile"].payload_json)
    assert payload["summary"]["region"] == "b" and payload["summary"]["playerAlias"] is None
    assert json.loads(rows["tagged"].payload_json)["summary"]["createdOn"] is None
    assert all(r.dispatched_at is None and r.dispatch_error is None for r in rows.values())


def test_player_summary_increment(spark, people):
    loaded = spark.createDataFrame([(datetime(2024, 1, 5), datetime(2024, 1, 5))], "source_updated_at timestamp, tag_changed_at timestamp")
    changed = {r.online_customer_id for r in marts.player_summary(*people, loaded).collect()}
    assert changed == {"profile", "tagged"}, "a deactivated tag counts as a change"
    assert marts.player_summary(*people, loaded.limit(0)).count() == 4


def test_a_second_run_on_the_own_output_is_quiet(spark, people):
    loaded = marts.player_summary(*people, sent_at="2024-03-01 00:00:00")
    assert marts.player_summary(*people, loaded).count() == 0, "the newest change is a deactivation"


def test_tag_rollup_is_sorted(spark, people):
    row = marts.tag_rollup(people[1]).filter("player_id = 'quiet'").first()
    assert [t.tag_category for t in row.tag_categories] == ["CASINO", "VIP"]


def test_fact_keys_match_dimension_keys(spark):
    games = fill(spark, "ig_game_catalog", [{"game_id": "X", "country_code": "de"}])
    dim = dimensions.dim_game(games, fill(spark, "ig_brand_game_catalog", [{"brand_game_id": "x"}]))
    assert dim.first().sk_game == games.select(surrogate_key("game_id", "country_code").alias("k")).first().k
