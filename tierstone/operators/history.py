"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.functions.keys import surrogate_key
from tierstone.functions.times import as_of_timestamp, open_end
from tierstone.operators.enforce import latest_per_key
from tierstone.operators.timeline import ROWS_PER_SLOT, find_slots, with_next

HISTORY_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def _versions(source: DataFrame, keys: Sequence[str], updated_at: str) -> DataFrame:
    """One row per (key, update time), opened at that time. NULL update times carry no order."""
    rows = latest_per_key(source.filter(F.col(updated_at).isNotNull()), [*keys, updated_at], updated_at)
    return rows.withColumns({"updated_at": F.col(updated_at), "valid_from": F.col(updated_at)})


def _chained(versions: DataFrame, keys: Sequence[str], slots) -> DataFrame:
    """Each version closed by the next one of its key, the last one open."""
    rows = with_next(versions, keys, "valid_from", "_until", slots)
    return rows.withColumns({
        "scd_id": surrogate_key(*keys, "updated_at"),
        "valid_to": F.coalesce(F.col("_until"), open_end()),
    }).drop("_until")


def build_history(log: DataFrame, keys: Sequence[str], updated_at: str,
                  rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """All versions of a change log as one history table."""
    slots = find_slots(log.select(*keys, updated_at), keys, updated_at, rows_per_slot)
    return _chained(_versions(log, keys, updated_at), keys, slots)


def is_current(valid_to: str = "valid_to") -> Column:
    return F.col(valid_to) == open_end()


def current_rows(history: DataFrame, valid_to: str = "valid_to") -> DataFrame:
    return history.filter(is_current(valid_to))


def snapshot(history: DataFrame, source: DataFrame, keys: Sequence[str], updated_at: str,
             run_at: datetime | str | None = None, hard_deletes: bool = True,
             rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """The history after one snapshot run over ``source``.

    New key: open row. Newer ``updated_at``: the open row is closed at that time and a
    new one opened; several newer versions of one key are chained. Older or equal:
    nothing. Open key missing from the source: closed at ``run_at`` (unless
    ``hard_deletes`` is off). Closed rows pass through.

    Keys are not NULL, as the contracts demand. Plain equality lets the joins, the
    aggregate and the window share one partitioning by key.
    """
    keys = list(keys)
    columns = history.columns
    open_rows = current_rows(history)
    marks = open_rows.select(*keys, F.col("updated_at").alias("_open_at"))

    incoming = _versions(source, keys, updated_at).join(marks, keys, "left")
    is_newer = F.col("_open_at").isNull() | (F.col("updated_at") > F.col("_open_at"))
    slots = find_slots(source.select(*keys, updated_at), keys, updated_at, rows_per_slot)
    added = _chained(incoming.filter(is_newer), keys, slots)

    arrived = source.select(*keys, F.col(updated_at).alias("_at")).join(marks, keys, "left")
    per_key = arrived.groupBy(*keys).agg(
        F.min(F.when(F.col("_at") > F.col("_open_at"), F.col("_at"))).alias("_closed_at"),
        F.first(F.lit(True)).alias("_seen"),
    )
    gone = F.col("_seen").isNull() & F.lit(hard_deletes)
    end = F.when(gone, as_of_timestamp(run_at)).otherwise(F.coalesce(F.col("_closed_at"), open_end()))
    kept = open_rows.join(per_key, keys, "left").withColumn("valid_to", end)

    closed = history.filter(~is_current())
    return closed.unionByName(kept.select(*columns)).unionByName(added.select(*columns))
