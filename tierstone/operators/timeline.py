"""Ordered look-ups within a key, for keys of any size.

A plain window puts all rows of a key into one task. Here a key with more rows than one
task should hold is cut along time into slots of about equal size; each row looks inside
its own (key, slot), and what lies in other slots of the key comes from a carry table
with one row per slot. Ordinary keys are a single slot and cost one shuffle, as usual.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOT = "_slot"
ROWS_PER_SLOT = 1_000_000
# Upper bound on cuts over all keys, so the tables of cuts and carries stay small enough
# to broadcast, and on slots of one key.
MAX_CUTS = 20_000
SLOTS_PER_KEY = 4096
QUANTILE_ACCURACY = 8 * SLOTS_PER_KEY


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys where NULL equals NULL; the right side's keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _micros(ts: Column | str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def _known(*columns: str) -> Column:
    test = F.lit(True)
    for c in columns:
        test = test & F.col(c).isNotNull()
    return test


def _cuts_before(cuts: Column, value: Column, inclusive: bool) -> Column:
    """How many of the sorted cuts lie before a value, by binary search."""
    steps = F.array(*[F.lit(SLOTS_PER_KEY >> i) for i in range(1, SLOTS_PER_KEY.bit_length())])

    def advance(low: Column, step: Column) -> Column:
        probe = F.get(cuts, low + step - 1)
        return low + F.when((probe <= value) if inclusive else (probe < value), step).otherwise(0)

    return F.aggregate(steps, F.lit(0), advance)


@dataclass(frozen=True)
class Slots:
    """The cuts of hot keys; ``cuts`` is None when no key is hot."""

    keys: tuple[str, ...]
    cuts: DataFrame | None = None

    def place(self, df: DataFrame, ts: str, spread_by: Sequence[str] = ()) -> DataFrame:
        """Add the slot of each row; -1 for rows of ordinary keys.

        Rows at a cut go before it. Rows that only look things up may also go to any of
        the slots meeting at their instant: with ``spread_by`` they are dealt out by a
        hash of these columns, which splits even a single crowded instant.
        """
        if self.cuts is None:
            return df.withColumn(SLOT, F.lit(-1))
        rows = null_safe_join(df, F.broadcast(self.cuts), self.keys)
        at, cuts = _micros(ts), F.col("_cuts")
        slot = _cuts_before(cuts, at, inclusive=False)
        if spread_by:
            rows = rows.withColumns({"_low": slot, "_high": _cuts_before(cuts, at, inclusive=True)})
            width = F.col("_high") - F.col("_low") + 1
            slot = F.col("_low") + F.pmod(F.xxhash64(*spread_by), width).cast("int")
        return rows.withColumn(SLOT, F.when(cuts.isNull(), -1).otherwise(slot)).drop("_cuts", "_low", "_high")

    def with_every_slot(self, per_slot: DataFrame) -> DataFrame:
        """One row per slot of the hot keys, filled where ``per_slot`` has a row."""
        every = self.cuts.select(*self.keys, F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias(SLOT))
        return null_safe_join(every, per_slot, [*self.keys, SLOT])


def find_slots(points: DataFrame, keys: Sequence[str], ts: str, rows_per_slot: int = ROWS_PER_SLOT) -> Slots:
    """Count rows per key (one narrow pass) and cut the keys that are too large at time quantiles.

    The cuts come to the driver once, so every later use sees the same ones; there are
    at most ``2 * MAX_CUTS``. Being approximate only shifts how even the slots are.
    """
    keys = tuple(keys)
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    seen = sizes.agg(F.sum("_n").alias("total"), F.max("_n").alias("largest")).first()
    target = max(rows_per_slot, math.ceil((seen.total or 0) / MAX_CUTS))
    if (seen.largest or 0) <= target:
        return Slots(keys)
    hot = sizes.filter(F.col("_n") > target)
    shares = F.expr("array(" + ",".join(f"{i / SLOTS_PER_KEY!r}D" for i in range(1, SLOTS_PER_KEY)) + ")")
    spots = (
        null_safe_join(points.withColumn("_at", _micros(ts)), F.broadcast(hot), keys, "inner")
        .groupBy(*keys)
        .agg(F.percentile_approx("_at", shares, QUANTILE_ACCURACY).alias("_all"), F.first("_n").alias("_n"))
    )
    doublings = F.ceil(F.log2(F.col("_n") / F.lit(target)))
    slots = F.least(F.lit(SLOTS_PER_KEY), F.pow(F.lit(2), doublings).cast("int"))
    stride = F.lit(SLOTS_PER_KEY) / slots
    cuts = F.transform(F.sequence(F.lit(1), slots - 1), lambda i: F.get("_all", (i * stride).cast("int") - 1))
    picked = spots.select(*keys, cuts.alias("_cuts"))
    return Slots(keys, points.sparkSession.createDataFrame(picked.collect(), picked.schema))


def _others(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(SLOT)


def with_next(df: DataFrame, keys: Sequence[str], order_col: str, out: str, slots: Slots) -> DataFrame:
    """Add the next larger ``order_col`` of the same key; NULL for its last row.

    ``order_col`` is a timestamp, unique within a key.
    """
    keys = list(keys)
    slot = [*keys, SLOT]
    rows = slots.place(df, order_col)
    if slots.cuts is not None:
        # A frame that comes dealt by key alone would keep a hot key's slots in one task.
        rows = rows.repartition(*slot)
    found = F.lead(order_col).over(Window.partitionBy(*slot).orderBy(order_col))
    if slots.cuts is None:
        return rows.withColumn(out, found).drop(SLOT)
    heads = rows.filter(F.col(SLOT) >= 0).groupBy(*slot).agg(F.min(order_col).alias("_head"))
    later = _others(keys).rowsBetween(1, Window.unboundedFollowing)
    carry = slots.with_every_slot(heads).select(*slot, F.first("_head", ignorenulls=True).over(later).alias("_carry"))
    rows = null_safe_join(rows.withColumn("_next", found), F.broadcast(carry), slot)
    return rows.withColumn(out, F.coalesce("_next", "_carry")).drop(SLOT, "_next", "_carry")


def _timeline(events: DataFrame, ts: str, facts: DataFrame, slots: Slots) -> tuple[DataFrame, DataFrame]:
    """Placed facts (rows with ``_t``, ``_side`` 0), and these merged with the placed events (``_side`` 1)."""
    hashable = [f.name for f in events.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    marks = slots.place(events.withColumns({"_t": F.col(ts), "_side": F.lit(1)}), "_t", spread_by=hashable)
    placed = slots.place(facts.withColumn("_side", F.lit(0)), "_t")
    return placed, marks.unionByName(placed, allowMissingColumns=True)


def _points(events: DataFrame, keys: Sequence[str], ts: str, facts: DataFrame) -> DataFrame:
    return events.select(*keys, F.col(ts).alias("_t")).unionByName(facts.select(*keys, "_t"))


def _so_far(slot: Sequence[str]):
    return (Window.partitionBy(*slot).orderBy("_t", "_side")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def as_of_join(events: DataFrame, history: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str],
               valid_from: str = "valid_from", valid_to: str = "valid_to",
               rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """Attach the history row valid at each event: ``valid_from <= ts < valid_to``.

    ``history`` holds non-overlapping intervals per key. Every event comes back exactly
    once, with NULLs where nothing was valid. Work is linear in events plus history:
    both are merged on one timeline instead of being joined pair by pair.
    """
    keys = list(keys)
    slot = [*keys, SLOT]
    version = F.struct(F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"),
                       *[F.col(c).alias(f"_h_{c}") for c in columns])
    facts = history.filter(_known(*keys, valid_from)).select(
        *keys, F.col(valid_from).alias("_t"), version.alias("_version"))
    slots = find_slots(_points(events, keys, ts, facts), keys, "_t", rows_per_slot)
    placed, line = _timeline(events, ts, facts, slots)
    line = line.withColumn("_found", F.last("_version", ignorenulls=True).over(_so_far(slot)))
    rows = line.filter(F.col("_side") == 1)
    if slots.cuts is not None:
        last = placed.filter(F.col(SLOT) >= 0).groupBy(*slot).agg(F.max_by("_version", "_t").alias("_last"))
        earlier = _others(keys).rowsBetween(Window.unboundedPreceding, -1)
        carry = slots.with_every_slot(last).select(
            *slot, F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
        rows = null_safe_join(rows, F.broadcast(carry), slot).withColumn("_found", F.coalesce("_found", "_carry"))
    valid = F.col(ts) < F.col("_found")["_to"]
    return rows.select(
        *[F.col(c) for c in events.columns],
        *[F.when(valid, F.col("_found")[f"_h_{c}"]).alias(c) for c in columns],
    )


def active_flags_at(events: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str,
                    label_col: str, labels: dict[str, str], valid_from: str = "valid_from",
                    valid_to: str = "valid_to", rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """1/0 per label: was an interval with that label open at the event's time?

    Intervals of a key may overlap. Each adds 1 at ``valid_from`` and takes 1 off at
    ``valid_to`` (NULL: never); the running balance at the event decides. ``labels``
    maps a value of ``label_col`` to its output column.
    """
    keys = list(keys)
    slot = [*keys, SLOT]
    outs = list(labels.values())
    ends = F.array(
        F.struct(F.col(valid_from).alias("t"), F.lit(1).alias("d")),
        F.struct(F.col(valid_to).alias("t"), F.lit(-1).alias("d")),
    )
    edges = (
        intervals.filter(F.col(label_col).isin(*labels) & _known(*keys, valid_from))
        .select(*keys, label_col, F.explode(ends).alias("_end")).filter(F.col("_end.t").isNotNull())
    )
    # Edges at one instant add up first, so a crowded instant is one row.
    facts = edges.groupBy(*keys, F.col("_end.t").alias("_t")).agg(*[
        F.sum(F.when(F.col(label_col) == v, F.col("_end.d")).otherwise(0)).alias(f"_d_{o}") for v, o in labels.items()
    ])
    slots = find_slots(_points(events, keys, ts, facts), keys, "_t", rows_per_slot)
    placed, line = _timeline(events, ts, facts, slots)
    so_far = _so_far(slot)
    rows = line.withColumns({f"_sum_{o}": F.coalesce(F.sum(f"_d_{o}").over(so_far), F.lit(0)) for o in outs})
    rows = rows.filter(F.col("_side") == 1)
    if slots.cuts is not None:
        totals = placed.filter(F.col(SLOT) >= 0).groupBy(*slot).agg(*[F.sum(f"_d_{o}").alias(f"_d_{o}") for o in outs])
        earlier = _others(keys).rowsBetween(Window.unboundedPreceding, -1)
        carry = slots.with_every_slot(totals).select(
            *slot, *[F.sum(f"_d_{o}").over(earlier).alias(f"_carry_{o}") for o in outs])
        rows = null_safe_join(rows, F.broadcast(carry), slot).withColumns(
            {f"_sum_{o}": F.col(f"_sum_{o}") + F.coalesce(F.col(f"_carry_{o}"), F.lit(0)) for o in outs})
    return rows.select(*[F.col(c) for c in events.columns],
                       *[(F.col(f"_sum_{o}") > 0).cast("int").alias(o) for o in outs])
