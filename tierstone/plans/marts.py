"""Gold marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.contracts import TENANT
from tierstone.functions import kpi
from tierstone.functions.payload import player_payload
from tierstone.functions.text import clean_str
from tierstone.operators.history import current_rows
from tierstone.operators.incremental import since_hour_lookback, watermark
from tierstone.operators.outbox import reset_dispatch
from tierstone.plans.facts import PLAYER, USER_TARGET

HOURLY_GRAIN = ["sk_date_time", "sk_game", TENANT]
SKETCH_BITS = 14


def mart_gameround_hourly(fact: DataFrame, incremental: bool = False, lookback_days: int = 2,
                          as_of: date | str | None = None, zero_fill: bool = False,
                          approximate_players: bool = False, revenue_per_player: bool = False,
                          player_sketch: bool = False) -> DataFrame:
    """Rounds, players and revenue per (hour, game, country).

    ``player_sketch`` stores a HyperLogLog sketch of the players, which ``roll_up`` merges.
    """
    source = since_hour_lookback(fact, "sk_date_time", lookback_days, as_of) if incremental else fact
    players = F.approx_count_distinct("sk_player") if approximate_players else F.count_distinct("sk_player")
    bet, win = F.sum("bet_amount_eur"), F.sum("win_amount_eur")
    bonus_bet, bonus_win = F.sum("bonus_bet_amount_eur"), F.sum("bonus_win_amount_eur")
    tax = F.sum("tax_amount_eur")
    measures = {
        "rounds": F.count("round_id"),
        "active_players": players,
        "total_bet_count": F.sum("bet_count"),
        "total_win_count": F.sum("win_count"),
        "promo_rounds": kpi.count_when(F.col("is_promotional") == 1, zero_fill),
        "bet_eur": F.round(bet, kpi.MONEY_SCALE),
        "win_eur": F.round(win, kpi.MONEY_SCALE),
        "bonus_bet_eur": F.round(bonus_bet, kpi.MONEY_SCALE),
        "bonus_win_eur": F.round(bonus_win, kpi.MONEY_SCALE),
        "tax_eur": F.round(tax, kpi.MONEY_SCALE),
        "ggr_eur": kpi.ggr(bet, win),
        "ngr_eur": F.round(bet - win - bonus_win - tax, kpi.MONEY_SCALE),
        "bonus_bet_ratio": kpi.safe_ratio(bonus_bet, bet),
        "win_rate": kpi.safe_ratio(win, bet),
    }
    if revenue_per_player:
        measures["revenue_per_player"] = kpi.safe_ratio(bet, players)
    if player_sketch:
        measures["players_sketch"] = F.hll_sketch_agg("sk_player", F.lit(SKETCH_BITS))
    return source.groupBy(*HOURLY_GRAIN).agg(*[m.alias(n) for n, m in measures.items()])


def roll_up(mart: DataFrame, span: Column, by: Sequence[str] = (TENANT,), out: str = "span") -> DataFrame:
    """Rounds, revenue and estimated players over longer spans, from the hourly mart alone.

    Counts of different players cannot be added up; their sketches can be united, with a
    relative standard error of 1.04 / sqrt(2 ** SKETCH_BITS), about 0.8 %.
    """
    return mart.groupBy(span.alias(out), *by).agg(
        F.sum("rounds").alias("rounds"),
        F.round(F.sum("bet_eur"), kpi.MONEY_SCALE).alias("bet_eur"),
        F.round(F.sum("ggr_eur"), kpi.MONEY_SCALE).alias("ggr_eur"),
        F.hll_sketch_estimate(F.hll_union_agg("players_sketch")).alias("active_players"),
    )


def tag_rollup(tags: DataFrame) -> DataFrame:
    """Per player: sorted set of active tag categories and the latest tag change.

    The set holds distinct categories only, so its size follows the category list, not
    the number of tag rows.
    """
    return tag_changes(tags).filter(F.size("tag_categories") > 0).drop("tag_changed_at")


def tag_changes(tags: DataFrame) -> DataFrame:
    """Per player with any tag: the active categories, their latest change, and the latest
    change of all tags, which a deactivation moves too."""
    active = F.col("is_active") == 1
    entry = F.struct(F.col("tag_category"), F.col("is_active"))
    return current_rows(tags).filter(F.col("target_type") == USER_TARGET).groupBy(*PLAYER).agg(
        F.array_sort(F.collect_set(F.when(active, entry))).alias("tag_categories"),
        F.max(F.when(active, F.col("updated_at"))).alias("tag_updated_at"),
        F.max("updated_at").alias("tag_changed_at"),
    )


def above_mark(rows: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """Rows updated after the largest value of another table's column; all if it has none."""
    if loaded.where(F.col(column).isNotNull()).isEmpty():
        return rows
    return rows.filter(F.col("updated_at") > watermark(loaded, column).scalar())


def changed_players(players: DataFrame, tags: DataFrame, loaded: DataFrame) -> DataFrame:
    """Keys of players whose profile or tags changed since the last load.

    Profile and tags are compared with a mark of their own. Both the mark and the changes
    go over all current user tags, so a deactivated tag is sent once and not again.
    """
    by_profile = above_mark(current_rows(players), loaded, "source_updated_at").select(*PLAYER)
    user_tags = current_rows(tags).filter(F.col("target_type") == USER_TARGET)
    by_tag = above_mark(user_tags, loaded, "tag_changed_at").select(*PLAYER)
    return by_profile.unionByName(by_tag).distinct()


def player_summary(players: DataFrame, tags: DataFrame, loaded: DataFrame | None = None,
                   sent_at: datetime | str | None = None) -> DataFrame:
    """Outbox rows: payload and change times per player, marked undelivered.

    ``players`` and ``tags`` are history tables; with ``loaded`` only changed players
    are staged again.
    """
    current = current_rows(players)
    if loaded is not None:
        current = current.join(changed_players(players, tags, loaded), PLAYER, "left_semi")
    rows = current.join(tag_changes(tags).select(*PLAYER, "tag_updated_at", "tag_changed_at"), PLAYER, "left")
    staged = rows.select(
        F.col("player_id").alias("online_customer_id"),
        TENANT,
        player_payload(sent_at=sent_at).alias("payload_json"),
        F.col("updated_at").alias("source_updated_at"),
        "tag_updated_at",
        "tag_changed_at",
        *[clean_str(c).alias(c) for c in ("player_alias", "region_code", "account_tier")],
        "is_verified",
    )
    return reset_dispatch(staged)
