"""Aggregate expressions of the gold layer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierstone.functions.times import col_of

# Transaction types that add to or reverse bets and wins.
BET_TYPES = ("BET", "RESERVED_BET")
BET_REVERSALS = ("ROLLBACK_BET", "ROLLBACK_RESERVED_BET", "ROLLBACK_ROUND")
WIN_TYPES = ("WIN", "PAYOUT", "CASHOUT")
WIN_REVERSALS = ("ROLLBACK_WIN", "ROLLBACK_CASHOUT")

MONEY_SCALE = 4
RATIO_SCALE = 6


def zero_filled(amount: Column | str) -> Column:
    return F.coalesce(col_of(amount), F.lit(0))


def signed(kind: Column | str, amount: Column | str, plus: Iterable[str], minus: Iterable[str]) -> Column:
    """``+amount`` for the plus types, ``-amount`` for the reversals, 0 otherwise."""
    x = zero_filled(amount)
    return F.when(col_of(kind).isin(*plus), x).when(col_of(kind).isin(*minus), -x).otherwise(F.lit(0))


def net_bets(amount: Column | str, kind: Column | str = "transaction_type") -> Column:
    return F.round(F.sum(signed(kind, amount, BET_TYPES, BET_REVERSALS)), MONEY_SCALE)


def net_wins(amount: Column | str, kind: Column | str = "transaction_type") -> Column:
    return F.round(F.sum(signed(kind, amount, WIN_TYPES, WIN_REVERSALS)), MONEY_SCALE)


def promo_wins(*amounts: Column | str, kind: Column | str = "transaction_type",
               promo: Column | str = "is_promotional") -> Column:
    """Promotional wins; reversals are not taken off by definition."""
    total = sum((zero_filled(a) for a in amounts[1:]), zero_filled(amounts[0]))
    hit = (col_of(promo) == 1) & col_of(kind).isin(*WIN_TYPES)
    return F.round(F.sum(F.when(hit, total).otherwise(F.lit(0))), MONEY_SCALE)


def flag_any(condition: Column) -> Column:
    """1 when any row of the group meets the condition, else 0."""
    return F.max(F.when(condition, 1).otherwise(0))


def count_when(condition: Column, zero_fill: bool = False) -> Column:
    """Rows meeting the condition; NULL when there is none unless ``zero_fill``."""
    n = F.sum(F.when(condition, 1))
    return F.coalesce(n, F.lit(0)) if zero_fill else n


def money_sum(amount: Column | str) -> Column:
    return F.round(F.sum(col_of(amount)), MONEY_SCALE)


def safe_ratio(numerator: Column, denominator: Column, scale: int = RATIO_SCALE) -> Column:
    """Rounded quotient, NULL when the denominator is 0."""
    return F.round(numerator / F.nullif(denominator, F.lit(0)), scale)


def ggr(bets: Column, wins: Column) -> Column:
    return F.round(bets - wins, MONEY_SCALE)
