"""Set-based outbox: pending rows out, delivery results in."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.functions.text import truncated
from tierstone.functions.times import as_of_timestamp, col_of

OUTBOX_KEYS = ("online_customer_id", "country_code")

# Fixed values of the delivery protocol; status 0 stands for a timeout or network error.
STATUS_OK = 200
STATUS_REFUSED = (401, 403)
CLIENT_ERRORS = (400, 500)
MAX_ATTEMPTS = 3
BACKOFF_SECONDS = 2
ERROR_LENGTH = 2000

SENT, RETRY, DEAD = "sent", "retry", "dead_letter"


def reset_dispatch(df: DataFrame) -> DataFrame:
    """Mark staged rows as not yet delivered."""
    return df.withColumns({
        "dispatched_at": F.lit(None).cast("timestamp"),
        "dispatch_error": F.lit(None).cast("string"),
    })


def pending(outbox: DataFrame, include_failed: bool = True, oldest_first: bool = True) -> DataFrame:
    """Undelivered rows. Failed ones are offered again unless ``include_failed`` is off."""
    rows = outbox.filter(F.col("dispatched_at").isNull())
    if not include_failed:
        rows = rows.filter(F.col("dispatch_error").isNull())
    return rows.orderBy("source_updated_at") if oldest_first else rows


def outcome(status: Column | str, attempt: Column | str) -> Column:
    """What follows from one delivery attempt: sent, retry or dead_letter."""
    code, n = col_of(status), col_of(attempt)
    low, high = CLIENT_ERRORS
    final_client_error = (code >= low) & (code < high) & ~code.isin(*STATUS_REFUSED)
    return (
        F.when(code == STATUS_OK, SENT)
        .when(final_client_error | (n >= MAX_ATTEMPTS), DEAD)
        .otherwise(RETRY)
    )


def backoff_seconds(status: Column | str, attempt: Column | str) -> Column:
    """Wait before the next attempt: none after a refused token, else doubling; NULL if final."""
    code, n = col_of(status), col_of(attempt)
    wait = F.when(code.isin(*STATUS_REFUSED), F.lit(0)).otherwise(F.lit(BACKOFF_SECONDS) * F.pow(F.lit(2), n - 1))
    return F.when(outcome(code, n) == RETRY, wait.cast("int"))


def classify_attempts(attempts: DataFrame, status: str = "status", attempt: str = "attempt") -> DataFrame:
    return attempts.withColumns({
        "outcome": outcome(status, attempt),
        "retry_after_s": backoff_seconds(status, attempt),
    })


def apply_results(outbox: DataFrame, results: DataFrame, keys: Sequence[str] = OUTBOX_KEYS,
                  now: datetime | str | None = None) -> DataFrame:
    """Fold final results (one row per key: ``ok``, ``error``) into the outbox in one join.

    Delivered: time set, error cleared. Failed: error kept, cut to length, time untouched.
    """
    said = results.select(*keys, F.col("ok").alias("_ok"), F.col("error").alias("_error"))
    failed = F.col("_ok").isNotNull() & ~F.col("_ok")
    return (
        outbox.join(said, list(keys), "left")
        .withColumns({
            "dispatched_at": F.when(F.col("_ok"), as_of_timestamp(now)).otherwise(F.col("dispatched_at")),
            "dispatch_error": F.when(F.col("_ok"), F.lit(None))
            .when(failed, truncated("_error", ERROR_LENGTH))
            .otherwise(F.col("dispatch_error")),
        })
        .select(*outbox.columns)
    )


def dead_letters(outbox: DataFrame) -> DataFrame:
    return outbox.filter(F.col("dispatch_error").isNotNull() & F.col("dispatched_at").isNull())


def dispatch_summary(results: DataFrame, elapsed_seconds: Column | float | None = None) -> DataFrame:
    """Processed, delivered and failed counts, and rows per second where the time is known."""
    n = F.count(F.lit(1))
    measures = [n.alias("processed"), F.count_if(F.col("ok")).alias("succeeded"),
                F.count_if(~F.col("ok")).alias("failed")]
    if elapsed_seconds is not None:
        seconds = elapsed_seconds if isinstance(elapsed_seconds, Column) else F.lit(float(elapsed_seconds))
        measures.append(F.round(n / F.nullif(seconds, F.lit(0.0)), 1).alias("rows_per_second"))
    return results.agg(*measures)
