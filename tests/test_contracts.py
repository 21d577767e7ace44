import pytest
from pyspark.sql import types as T

from tierstone.contracts import CONTRACTS, LEGACY_NAMES, contract

SIZES = {"ig_transaction": 29, "ig_player": 29, "ig_payment": 25, "ig_compliance_check": 10, "ig_round": 19,
         "ig_game_catalog": 29, "ig_brand_game_catalog": 10, "ig_player_tag": 12, "ig_player_limit": 17}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract_is_complete(name):
    spec = CONTRACTS[name]
    fields = spec.schema.fieldNames()
    assert len(fields) == len(set(fields)) == SIZES[name]
    assert {spec.primary_key, spec.version_col, "country_code"} <= set(fields)
    assert not spec.schema[spec.primary_key].nullable
    assert spec.merge_keys == [spec.primary_key, "country_code"]


def test_nine_tables():
    assert set(CONTRACTS) == set(SIZES)


def test_lookup():
    assert contract("ig_round") is CONTRACTS["ig_round"]
    assert {contract(old) for old in LEGACY_NAMES} == set(CONTRACTS.values())


def test_unknown_table_gets_a_default():
    spec = contract("wallet")
    assert (spec.primary_key, spec.version_col, spec.schema) == ("wallet_id", "version", T.StructType([]))
