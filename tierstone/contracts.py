"""Silver table contracts: primary key, schema, version column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TENANT = "country_code"

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "byte": T.ByteType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(34, 4),
}


@dataclass(frozen=True)
class TableContract:
    primary_key: str
    schema: T.StructType
    version_col: str = "version"

    @property
    def merge_keys(self) -> list[str]:
        """A row is identified by its primary key within one country."""
        return [self.primary_key, TENANT]


# The data contract. One field per line, "<name> <type>"; the first
# field of each table is its primary key and the only one that may not be NULL.
_FIELDS = {
    "ig_transaction": """
        transaction_id string
        player_id string
        game_id string
        country_code string
        currency_code string
        provider_name string
        studio_name string
        transaction_type string
        transaction_status string
        transaction_reason string
        record_version int
        created_at timestamp
        updated_at timestamp
        succeeded_at timestamp
        processed_at timestamp
        amount_eur money
        amount_real_eur money
        amount_bonus_eur money
        provider_amount_eur money
        wallet_amount_eur money
        tax_amount_eur money
        balance_before_eur money
        balance_after_eur money
        balance_before_real_eur money
        balance_after_real_eur money
        balance_before_bonus_eur money
        balance_after_bonus_eur money
        fx_rate double
        discardable byte
    """,
    "ig_player": """
        player_id string
        country_code string
        currency_code string
        brand_id string
        created_at timestamp
        updated_at timestamp
        modified_at timestamp
        first_deposit_at timestamp
        last_deposit_at timestamp
        last_login_at timestamp
        first_bet_at timestamp
        last_bet_at timestamp
        jurisdiction string
        player_alias string
        region_code string
        account_tier string
        segment_ids string
        tags string
        is_verified byte
        is_identity_verified byte
        is_contact_verified byte
        session_limit_remaining double
        loss_limit_remaining money
        deposit_limit_remaining money
        bet_limit_remaining money
        total_balance money
        total_bet money
        total_deposit money
        total_withdraw money
    """,
    "ig_payment": """
        payment_id string
        player_id string
        country_code string
        currency_code string
        payment_type string
        payment_method string
        provider_name string
        gateway_name string
        status_code string
        first_of_type byte
        amount_eur money
        fee_eur money
        converted_amount_eur money
        converted_currency_code string
        balance_before_eur money
        balance_after_eur money
        balance_before_real_eur money
        balance_after_real_eur money
        balance_before_bonus_eur money
        balance_after_bonus_eur money
        created_at timestamp
        completed_at timestamp
        succeeded_at timestamp
        declined_deposit_id string
        version int
    """,
    "ig_compliance_check": """
        check_id string
        player_id string
        country_code string
        check_type string
        check_status string
        reason string
        created_at timestamp
        updated_at timestamp
        modified_at timestamp
        version int
    """,
    "ig_round": """
        round_id string
        player_id string
        game_id string
        country_code string
        currency_code string
        is_promotional int
        is_closed int
        bet_amount_eur money
        win_amount_eur money
        bonus_bet_amount_eur money
        bonus_win_amount_eur money
        tax_amount_eur money
        bet_count int
        win_count int
        created_at timestamp
        finished_at timestamp
        updated_at timestamp
        ingested_at timestamp
        version int
    """,
    "ig_game_catalog": """
        game_id string
        country_code string
        game_name string
        game_studio string
        game_vertical string
        game_type string
        game_class string
        game_slug string
        table_id string
        is_live byte
        is_enabled byte
        is_branded byte
        is_free_games byte
        is_gamble byte
        is_progressive_jackpot byte
        is_login_required byte
        is_bonus_game byte
        is_private byte
        is_discardable byte
        rtp money
        volatility string
        min_bet money
        max_bet money
        jackpot_id string
        allowed_wallet_type string
        released_at timestamp
        created_at timestamp
        updated_at timestamp
        ingested_at timestamp
    """,
    "ig_brand_game_catalog": """
        brand_game_id string
        game_id string
        country_code string
        provider_name string
        is_enabled byte
        private_status string
        enabled_at timestamp
        first_enabled_at timestamp
        disabled_at timestamp
        updated_at timestamp
    """,
    "ig_player_tag": """
        tag_id string
        player_id string
        country_code string
        target_type string
        tag_category string
        is_active byte
        is_discardable byte
        ingested_at timestamp
        modified_at timestamp
        tag_creator_id string
        tag_updater_id string
        version int
    """,
    "ig_player_limit": """
        limit_id string
        player_id string
        country_code string
        limit_type string
        limit_status string
        limit_value money
        limit_value_eur money
        limit_value_base money
        currency_code string
        active_from timestamp
        active_until timestamp
        next_reset_time timestamp
        progress string
        creator_id string
        modifier_id string
        modified_at timestamp
        version int
    """,
}

# Version columns that are not called "version", and the older table
# names some ingestion jobs still pass.
_VERSION_COLUMNS = {
    "ig_transaction": "record_version",
    "ig_player": "modified_at",
    "ig_compliance_check": "modified_at",
    "ig_game_catalog": "updated_at",
    "ig_brand_game_catalog": "updated_at",
}
LEGACY_NAMES = {
    "gametransaction": "ig_transaction",
    "userdata": "ig_player",
    "payment": "ig_payment",
    "check": "ig_compliance_check",
    "gameround": "ig_round",
    "game": "ig_game_catalog",
    "brandgame": "ig_brand_game_catalog",
    "tag": "ig_player_tag",
    "userlimit": "ig_player_limit",
}
COUNTRIES = ("de", "at", "dk")


def _build(table: str, text: str) -> TableContract:
    fields = []
    for line in text.strip().splitlines():
        name, kind = line.split()
        fields.append(T.StructField(name, _TYPES[kind], nullable=bool(fields)))
    return TableContract(fields[0].name, T.StructType(fields), _VERSION_COLUMNS.get(table, "version"))


CONTRACTS: dict[str, TableContract] = {name: _build(name, text) for name, text in _FIELDS.items()}


def contract(table: str) -> TableContract:
    """Contract of a table, by current or legacy name.

    An unregistered table gets key ``<table>_id``, version column ``version`` and an
    empty schema, which the operators read as "pass the columns through".
    """
    known = CONTRACTS.get(LEGACY_NAMES.get(table, table))
    return known or TableContract(f"{table}_id", T.StructType([]))
