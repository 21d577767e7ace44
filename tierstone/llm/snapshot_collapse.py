"""Chat formatting after collapsing cumulative snapshots.

Chat logs often hold a conversation again and again, each time with more turns. Every
turn gets a rolling hash of the turns so far; a conversation whose last hash is the hash
of a shorter prefix of another conversation is a snapshot of it and goes. Conversations
with the same turns leave the one with the smallest conv_id. What remains is rendered.

The rolling hash is a running sum: each turn adds four numbers taken from the SHA-256 of
its place, role and text, so a prefix is known by its length and sums of 60-bit numbers.

Conversations may be of any length up to their rendering: turns are dealt by ranges of
(conversation, turn), every range counts and sums on its own, and what the earlier ranges of
a conversation amount to is carried in from a table of one row for each of them. So no task
holds a long conversation, nor all rows without a conv_id.

Defined cases: turns are ordered by ``turn``, then role and text, nulls first; repeated
rows are turns of their own; null roles and texts differ from empty ones and render as
empty; rows of a null conv_id form one conversation; an empty table gives no row; other
columns play no part. A rendered conversation is one row of the result, so its text must fit
one row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstone.session import materialise

LANES = ["lane_1", "lane_2", "lane_3", "lane_4"]
PREFIX = ["at", *LANES]
# The form of a turn in the rendered text (fixed values).
TURN_FORM = "<|im_start|>%s\n%s<|im_end|>\n"


def _marked(value: Column) -> Column:
    """A text by its length and content, so that joined fields stay apart."""
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def _carried_in(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Adds to each row, for each of ``sums``, the total over the earlier slots of its conversation."""
    earlier = Window.partitionBy("conv_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    per_slot = rows.groupBy("conv_id", "slot").agg(*[total.alias(name) for name, total in sums.items()])
    before = per_slot.select(
        F.col("conv_id").alias("_conv"), F.col("slot").alias("_slot"),
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"before_{name}") for name in sums])
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("slot") == F.col("_slot"))
    return rows.join(before, same).drop("_conv", "_slot")


def rolling_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, place ``at`` of the turn, whether it is the ``last``, and the sums up to it."""
    order = ["turn", "role", "text", "copy"]
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("copy", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("conv_id", *order).withColumn("slot", F.spark_partition_id())
    rows = materialise(rows, "turn-slots")
    inside = Window.partitionBy("conv_id", "slot").orderBy(*order)
    rows = _carried_in(rows.withColumn("local", F.row_number().over(inside)), {"turns": F.count(F.lit(1))})
    at = F.col("before_turns") + F.col("local")
    digest = F.sha2(F.concat_ws("|", at.cast("string"), _marked(F.col("role")), _marked(F.col("text"))), 256)
    rows = rows.select("conv_id", "slot", at.alias("at"), digest.alias("digest"))
    part = lambda k: F.conv(F.substring("digest", 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")
    rows = rows.select("conv_id", "slot", "at", *[part(k).alias(name) for k, name in enumerate(LANES)])
    rows = _carried_in(materialise(rows, "turn-digests"), {name: F.sum(name) for name in LANES})
    upto = Window.partitionBy("conv_id", "slot").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.sum(name).over(upto) + F.col(f"before_{name}")).cast("decimal(38,0)").alias(name) for name in LANES]
    rows = rows.select("conv_id", "at", *sums)
    longest = rows.groupBy("conv_id").agg(F.max("at").alias("n")).withColumnRenamed("conv_id", "_conv")
    return rows.join(longest, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("at") == F.col("n")), "left").select(
        "conv_id", "at", F.col("n").isNotNull().alias("last"), *LANES)


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id of the conversations that stay, and how many equal ones it stands for."""
    hashes = materialise(rolling_hashes(turns), "turn-hashes")
    whole = hashes.where("last").groupBy(*PREFIX).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    shorter = hashes.where("not last").select(*PREFIX).distinct()
    return whole.join(shorter, PREFIX, "left_anti").select("conv_id", "copies", F.col("at").cast("bigint").alias("n_turns"))


def collapse_and_render(turns: DataFrame) -> DataFrame:
    """One row per conversation that stays: conv_id, n_turns, copies, text."""
    stays = maximal_conversations(turns)
    rendered = F.format_string(TURN_FORM, F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    kept = turns.select("conv_id", "turn", "role", "text").join(
        stays.select(F.col("conv_id").alias("kept_id"), "n_turns", "copies"), F.col("conv_id").eqNullSafe(F.col("kept_id")))
    row = F.struct("turn", "role", "text", rendered.alias("line"))
    return kept.groupBy("conv_id", "n_turns", "copies").agg(
        F.concat_ws("", F.transform(F.sort_array(F.collect_list(row)), lambda r: r["line"])).alias("text"))
