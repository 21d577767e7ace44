"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierstone.functions.times import col_of

NULL_TOKEN = "_surrogate_key_null_"


def surrogate_key(*parts: Column | str, null_token: str = NULL_TOKEN) -> Column:
    """md5 of the parts as strings joined by '-', NULL written as a token."""
    texts = [F.coalesce(col_of(p).cast("string"), F.lit(null_token)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))
