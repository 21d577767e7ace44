"""JSON payload of the player summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierstone.functions.text import clean_str
from tierstone.functions.times import as_of_timestamp, col_of, iso_utc

# Fixed values of the payload.
COLLECTION = "PlayerSummary"
EVENT_TYPE = "profile_refresh"


def player_payload(
    player_id: Column | str = "player_id",
    country: Column | str = "country_code",
    region: Column | str = "region_code",
    tier: Column | str = "account_tier",
    alias: Column | str = "player_alias",
    verified: Column | str = "is_verified",
    created: Column | str = "created_at",
    sent_at: Column | datetime | str | None = None,
) -> Column:
    """The nested payload as JSON text, NULL fields kept; built in the JVM."""
    summary = {
        "eventType": F.lit(EVENT_TYPE),
        "country": col_of(country),
        "region": clean_str(region),
        "accountTier": clean_str(tier),
        "playerAlias": clean_str(alias),
        "isVerified": col_of(verified),
        "createdOn": iso_utc(created),
    }
    body = {
        "collection": F.lit(COLLECTION),
        "playerId": col_of(player_id).cast("string"),
        "summary": F.struct(*[c.alias(n) for n, c in summary.items()]),
        "sentAt": iso_utc(as_of_timestamp(sent_at)),
    }
    return F.to_json(F.struct(*[c.alias(n) for n, c in body.items()]), {"ignoreNullFields": "false"})
