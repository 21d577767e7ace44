"""Gold dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.contracts import TENANT
from tierstone.functions.keys import surrogate_key
from tierstone.functions.times import null_if_sentinel
from tierstone.operators.enforce import latest_per_key

# Dimension column <- catalog column.
_GAME_COLUMNS = {
    "name": "game_name",
    "studio": "game_studio",
    "vertical": "game_vertical",
    "type": "game_type",
    "class": "game_class",
    "slug": "game_slug",
    "table_id": "table_id",
    "live": "is_live",
    "enabled": "is_enabled",
    "branded": "is_branded",
    "free_games": "is_free_games",
    "gamble": "is_gamble",
    "progressive_jackpot": "is_progressive_jackpot",
    "login_required": "is_login_required",
    "bonus_game": "is_bonus_game",
    "private": "is_private",
    "discardable": "is_discardable",
    "rtp": "rtp",
    "volatility": "volatility",
    "min_bet": "min_bet",
    "max_bet": "max_bet",
    "jackpot_id": "jackpot_id",
    "allowed_wallet_type": "allowed_wallet_type",
}
METHOD_KEYS = ("payment_method", "provider_name", "gateway_name", "payment_type")


def dim_game(games: DataFrame, brand_games: DataFrame) -> DataFrame:
    """One row per (game, country) with its latest brand settings.

    A game may have several brand rows; only the newest one joins, so the grain holds.
    """
    keys = ["game_id", TENANT]
    brand = latest_per_key(
        brand_games.select(*keys, "brand_game_id", "private_status", "provider_name",
                           F.col("is_enabled").alias("brand_enabled"), "enabled_at",
                           "first_enabled_at", "disabled_at", F.col("updated_at").alias("brand_updated_at")),
        keys, "brand_updated_at", ["brand_game_id"],
    )
    rows = games.join(brand, keys, "left")
    return rows.select(
        surrogate_key(*keys).alias("sk_game"),
        *keys,
        *[F.col(source).alias(name) for name, source in _GAME_COLUMNS.items()],
        "private_status",
        F.col("provider_name").alias("game_provider_id"),
        F.col("brand_enabled").alias("brand_game_enabled"),
        "released_at",
        null_if_sentinel("enabled_at").alias("brand_enabled_at"),
        null_if_sentinel("first_enabled_at").alias("brand_first_enabled_at"),
        null_if_sentinel("disabled_at").alias("brand_disabled_at"),
        F.col("ingested_at").alias("created_at"),
        "updated_at",
    )


def dim_payment_method(payments: DataFrame) -> DataFrame:
    """Every complete (method, provider, gateway, type) combination seen in payments."""
    seen = payments.select(*METHOD_KEYS).dropna(subset=list(METHOD_KEYS)).distinct()
    return seen.select(
        surrogate_key(*METHOD_KEYS).alias("sk_payment_method"),
        "payment_method", "payment_type", "provider_name", "gateway_name",
    )
