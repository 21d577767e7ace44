"""All intervals in force at each event, intervals of a key overlapping as they may.

Each interval is filed under the size of its length, a power of two, and under the bins of
that width that it touches, two at most; each event looks into one bin for every size that
occurs. In a bin of its own size an interval covers a good share of the time, so the join
looks at few pairs that it does not return, short and long intervals alike, and no interval
is spelt out over all the time it spans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE, BIN = "_size", "_bin"


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def rows_in_force(events: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str],
                  valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """One row per event and interval with ``valid_from <= ts < valid_to``: the event's columns and ``columns``.

    An interval without an end is open; one without a start, or with a NULL in its key, is
    never in force. Events that nothing covers give no row.
    """
    keys = list(keys)
    span = events.agg(F.min(_micros(ts)).alias("first"), F.max(_micros(ts)).alias("last")).first()
    if span["first"] is None:
        span = {"first": 0, "last": 0}
    # What lies outside the time of the events only makes intervals longer.
    start = F.greatest(_micros(valid_from), F.lit(span["first"]))
    end = F.least(F.coalesce(_micros(valid_to), F.lit(span["last"] + 1)), F.lit(span["last"] + 1))
    known = F.col(valid_from).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    filed = intervals.filter(known).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], start.alias("_from"), end.alias("_to"), *[F.col(c).alias(f"_v_{c}") for c in columns]).filter("_from < _to")
    size = F.ceil(F.log2((F.col("_to") - F.col("_from")).cast("double"))).cast("int")
    filed = filed.withColumn(SIZE, size).withColumn("_width", F.expr(f"shiftleft(1L, {SIZE})"))
    first = span["first"]
    bins = F.expr(f"sequence((_from - {first}L) div _width, (_to - 1 - {first}L) div _width)")
    filed = filed.withColumn(BIN, F.explode(bins)).drop("_width")
    sizes = sorted(r[0] for r in filed.select(SIZE).distinct().collect())  # sizes are powers of two: 64 at most
    places = F.array(*[
        F.struct(F.lit(s).alias("size"), F.expr(f"(_at - {first}L) div {1 << s}L").alias("bin")) for s in sizes
    ]) if sizes else F.array().cast("array<struct<size:int,bin:bigint>>")
    looking = events.withColumn("_at", _micros(ts)).withColumn("_place", F.explode(places))
    same = (F.col("_place.size") == F.col(SIZE)) & (F.col("_place.bin") == F.col(BIN))
    for key in keys:
        same = same & (F.col(key) == F.col(f"_k_{key}"))
    found = looking.join(filed, same).filter((F.col("_from") <= F.col("_at")) & (F.col("_at") < F.col("_to")))
    return found.select(*events.columns, *[F.col(f"_v_{c}").alias(c) for c in columns])
