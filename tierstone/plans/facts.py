"""Gold facts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.contracts import TENANT
from tierstone.functions import kpi
from tierstone.functions.keys import surrogate_key
from tierstone.functions.text import is_filled
from tierstone.functions.times import as_of_timestamp, hour_key
from tierstone.operators.incremental import above_watermark, since_lookback
from tierstone.plans.dimensions import METHOD_KEYS

# Fixed values.
SUCCEEDED = "SUCCEEDED"
USER_TARGET = "User"
TEST_TAG, CASINO_TAG, SPORTS_TAG = "TEST", "CASINO_PLAYER", "SPORTS_PLAYER"
UNKNOWN = "UNKNOWN"

KPI_GRAIN = ["sk_date_time", "player_id", "game_id", "currency_code", TENANT]
PLAYER = ["player_id", TENANT]
GAME = ["game_id", TENANT]


def player_flags(tags: DataFrame) -> DataFrame:
    """Per tagged player: active test, casino and sports flags, from one pass over the tags."""
    active = F.col("is_active") == 1
    def has(category: str) -> Column:
        return kpi.flag_any((F.col("tag_category") == category) & active)

    relevant = (F.col("target_type") == USER_TARGET) & F.col("tag_category").isin(TEST_TAG, CASINO_TAG, SPORTS_TAG)
    return tags.filter(relevant).groupBy(*PLAYER).agg(
        has(TEST_TAG).alias("is_test"),
        has(CASINO_TAG).alias("is_casino_player"),
        has(SPORTS_TAG).alias("is_sports_player"),
    )


def without_tagged(df: DataFrame, tags: DataFrame, category: str = TEST_TAG) -> DataFrame:
    """Rows of players who do not carry an active tag of the category."""
    tagged = tags.filter(
        (F.col("target_type") == USER_TARGET) & (F.col("tag_category") == category) & (F.col("is_active") == 1)
    ).select(*PLAYER)
    return df.join(tagged, PLAYER, "left_anti")


def succeeded_game_transactions(transactions: DataFrame) -> DataFrame:
    """Succeeded rows with a game, ids trimmed, Vienna hour key added."""
    rows = transactions.filter((F.col("transaction_status") == SUCCEEDED) & is_filled("game_id"))
    if "is_promotional" not in rows.columns:
        rows = rows.withColumn("is_promotional", F.lit(0))
    return rows.withColumns({"game_id": F.trim("game_id"), "sk_date_time": hour_key("created_at")})


def net_measures() -> list[Column]:
    """Bets and wins net of reversals for total, real and bonus money, and promotional wins."""
    out = []
    for suffix, amount in (("", "amount_eur"), ("_real", "amount_real_eur"), ("_bonus", "amount_bonus_eur")):
        out.append(kpi.net_bets(amount).alias(f"bets{suffix}_eur"))
        out.append(kpi.net_wins(amount).alias(f"wins{suffix}_eur"))
    out.append(kpi.promo_wins("amount_bonus_eur").alias("promo_wins_bonus_eur"))
    out.append(kpi.promo_wins("amount_real_eur", "amount_bonus_eur").alias("total_promo_wins_eur"))
    return out


def fact_txn_kpi(transactions: DataFrame, tags: DataFrame, games: DataFrame,
                 incremental: bool = False, lookback_days: int = 2,
                 as_of: date | str | None = None, now: datetime | str | None = None) -> DataFrame:
    """Hourly KPIs per (hour, player, game, currency, country).

    Rows are aggregated to the grain before any join: the map-side combine shrinks hot
    players first. Test players go out after that (their flag is constant within a
    group) together with the flag look-up, so the tags are read and shuffled once.
    """
    source = since_lookback(transactions, "created_at", lookback_days, as_of) if incremental else transactions
    grouped = succeeded_game_transactions(source).groupBy(*KPI_GRAIN).agg(
        *net_measures(), F.count("transaction_id").alias("src_row_count")
    )
    dim = games.select(*GAME, "vertical", "studio", F.col("type").alias("game_type"))
    rows = (
        grouped.join(player_flags(tags), PLAYER, "left")
        .filter(F.coalesce(F.col("is_test"), F.lit(0)) == 0)
        .join(dim, GAME, "left")
    )
    def ggr(suffix: str) -> Column:
        return kpi.ggr(F.col(f"bets{suffix}_eur"), F.col(f"wins{suffix}_eur")).alias(f"ggr{suffix}_eur")

    measures = []
    for suffix in ("", "_real", "_bonus"):
        measures += [F.col(f"bets{suffix}_eur"), F.col(f"wins{suffix}_eur"), ggr(suffix)]
    return rows.select(
        surrogate_key(*KPI_GRAIN).alias("sk_txn_kpi"),
        *KPI_GRAIN,
        *[F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in ("vertical", "studio", "game_type")],
        *measures,
        "promo_wins_bonus_eur", "total_promo_wins_eur",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("is_casino_player", "is_sports_player")],
        "src_row_count",
        as_of_timestamp(now).alias("last_update"),
    )


def fact_payments(payments: DataFrame, methods: DataFrame, incremental: bool = False,
                  lookback_days: int = 2, lookback_col: str = "created_at",
                  as_of: date | str | None = None, now: datetime | str | None = None) -> DataFrame:
    """One row per succeeded payment that is not a retry of a declined deposit."""
    source = since_lookback(payments, lookback_col, lookback_days, as_of) if incremental else payments
    rows = source.filter((F.col("status_code") == SUCCEEDED) & F.col("declined_deposit_id").isNull())
    dim = methods.select(*METHOD_KEYS, "sk_payment_method")
    net = kpi.zero_filled("amount_eur") - kpi.zero_filled("fee_eur")
    return rows.join(dim, list(METHOD_KEYS), "left").select(
        surrogate_key("payment_id", TENANT).alias("sk_payment"),
        "payment_id",
        hour_key(F.coalesce("succeeded_at", "created_at")).alias("sk_date_time"),
        "player_id", TENANT, "currency_code",
        "sk_payment_method", "payment_type", "payment_method", "provider_name", "gateway_name",
        F.coalesce(F.col("first_of_type"), F.lit(0)).cast("int").alias("is_first_deposit"),
        "amount_eur", "fee_eur", F.round(net, kpi.MONEY_SCALE).alias("net_amount_eur"),
        "converted_amount_eur", "converted_currency_code",
        "balance_before_eur", "balance_after_eur",
        "balance_before_real_eur", "balance_after_real_eur",
        "balance_before_bonus_eur", "balance_after_bonus_eur",
        "created_at", "succeeded_at",
        as_of_timestamp(now).alias("last_update"),
    )


def fact_gameround(rounds: DataFrame, loaded: DataFrame | None = None, hour_col: str = "ingested_at",
                   inclusive: bool = False) -> DataFrame:
    """One row per closed round; with ``loaded``, only rounds above its high-water mark."""
    source = rounds if loaded is None else above_watermark(rounds, loaded, "updated_at", inclusive)
    return source.filter(F.col("is_closed") == 1).select(
        "round_id",
        hour_key(hour_col).alias("sk_date_time"),
        surrogate_key(*PLAYER).alias("sk_player"),
        surrogate_key(*GAME).alias("sk_game"),
        TENANT, "currency_code", "is_promotional",
        "bet_amount_eur", "win_amount_eur", "bonus_bet_amount_eur", "bonus_win_amount_eur", "tax_amount_eur",
        (F.col("bet_amount_eur") - F.col("win_amount_eur")).alias("ggr_eur"),
        "bet_count", "win_count",
        "created_at", "finished_at", "updated_at",
    )


def fact_game_revenue(transactions: DataFrame) -> DataFrame:
    """One row per succeeded game transaction with its signed bet, win and revenue."""
    rows = succeeded_game_transactions(transactions)
    bet = kpi.signed("transaction_type", "amount_eur", kpi.BET_TYPES, kpi.BET_REVERSALS)
    win = kpi.signed("transaction_type", "amount_eur", kpi.WIN_TYPES, kpi.WIN_REVERSALS)
    return rows.select(
        "transaction_id", "sk_date_time",
        surrogate_key(*PLAYER).alias("sk_player"),
        surrogate_key(*GAME).alias("sk_game"),
        TENANT, "currency_code", "transaction_type",
        bet.alias("bet_eur"), win.alias("win_eur"), kpi.ggr(bet, win).alias("ggr_eur"),
        "created_at",
    )
