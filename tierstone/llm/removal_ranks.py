"""Audit of how document filters interact, for every order they could be applied in.

A document's failed filters are a row of a mask matrix: 0 where it fails, infinite where it
passes. The inverse of each order is a row of a position matrix: the step at which each
filter acts. The min-plus product of the two, the minimum over filters of mask plus
position, is the step that removes the document. Documents with equal masks share it, so
Spark only counts documents by part, mask and label (everything before is the work of the
corpus: flags, copies, labels), and the counts, at most one for each mask and part, are
scattered to (order, step) by their removal step.

Copies are found by the SHA-256 of the text: the smallest doc_id of each text is joined
back on text and doc_id together, so a large group of copies is never one key of a join.

Defined cases: a null text is empty; an empty text has no words, so it fails A and no
other; a null doc_id is neither smaller nor larger than another, so such a row fails no
copy filter and has no label; repeated rows count one by one and are not copies of each
other; of several labels of one document the highest count; null labels are no label; a
null part is the empty string; an empty table gives no row; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{name} bigint" for name in COUNTS)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The letter of the filter on copies, which is no expression of one row.
COPY = "E"


def text_filters(text: str = "text") -> dict[str, Column]:
    """The conditions under which a text fails, as expressions over its words (an array column ``words``)."""
    n_words, chars = F.size("words").cast("bigint"), F.col(text)
    n_chars = F.length(chars).cast("bigint")
    capitals = n_chars - F.length(F.translate(chars, UPPER, ""))
    return {
        "A": n_words < 200,
        "B": 100 * F.size(F.array_distinct("words")).cast("bigint") < 50 * n_words,
        "C": 100 * capitals > 2 * n_chars,
        "D": chars.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, part: str, letters: str, filters: Mapping[str, Column]) -> DataFrame:
    """One row per group of rows alike in doc_id, text and part: doc_id, part, mask, n.

    Bit i of the mask is set where the filter of the i-th letter fails.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumns({"words": words, "text_key": F.unhex(F.sha2("text", 256))})
    mask = sum((F.when(failed, 1 << letters.index(letter)).otherwise(0) for letter, failed in filters.items()), F.lit(0))
    rows = rows.select("doc_id", "text_key", "part", mask.alias("mask"))
    rows = rows.groupBy("text_key", "doc_id", "part").agg(F.first("mask").alias("mask"), F.count(F.lit(1)).alias("n"))
    if COPY not in letters:
        return rows.select("doc_id", "part", "mask", "n")
    least = rows.where("doc_id is not null").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    least = least.withColumn("stays", F.lit(True))
    fails = F.col("doc_id").isNotNull() & F.col("stays").isNull()
    return rows.join(least, ["text_key", "doc_id"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(fails, 1 << letters.index(COPY)).otherwise(0)).alias("mask"), "n")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic``, 1 where the document is so labelled. Rows without an id join nothing."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    named = rows.where("doc_id is not null").join(marks, "doc_id", "left")
    nameless = rows.where("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    return named.unionByName(nameless).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def removal_steps(masks: np.ndarray, orders: list[tuple[int, ...]], n_filters: int) -> np.ndarray:
    """Min-plus product of masks and inverse orders: the removing step, from 0; ``n_filters`` where none removes."""
    fails = (masks[:, None] >> np.arange(n_filters)) & 1
    cost = np.where(fails == 1, 0, n_filters)
    positions = np.argsort(np.array(orders), axis=1)
    return np.minimum((cost[:, None, :] + positions[None]).min(axis=2), n_filters)


def _scatter(letters: str):
    """Per part, from the counts by mask: one row for each order and step."""
    k = len(letters)
    orders = list(permutations(range(k)))
    names = pa.array(["".join(letters[f] for f in order) for order in orders for _ in range(k)])
    steps = pa.array(list(range(1, k + 1)) * len(orders), pa.int32())
    acting = np.array(orders)
    at = np.arange(len(orders))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                masks = np.array([c["mask"] for c in row["counts"]])
                weights = np.array([[c["n"], c["good"], c["toxic"]] for c in row["counts"]], np.int64)
                fails = (masks[:, None] >> np.arange(k)) & 1
                removing = removal_steps(masks, orders, k)
                taken = np.zeros((len(orders), k + 1, 3), np.int64)
                for steps_of, weight in zip(removing, weights):
                    np.add.at(taken, (at, steps_of), weight)
                removed = taken[:, :k, 0]
                failing = (fails * weights[:, :1]).sum(axis=0)[acting]
                alone = np.array([weights[masks == 1 << f, 0].sum() for f in range(k)], np.int64)[acting]
                value = np.zeros(k, np.int64)
                np.add.at(value, acting, removed)
                found = {
                    "kept": weights[:, 0].sum() - removed.cumsum(axis=1), "removed": removed, "redundant": failing - removed,
                    "unique_fails": alone, "good_lost": taken[:, :k, 1], "toxic_lost": taken[:, :k, 2], "shapley": value[acting],
                }
                columns = [pa.array([row["part"]] * len(names)), names, steps]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *[pa.array(found[c].ravel(), pa.int64()) for c in COUNTS]], ["part", "filter_order", "step", *COUNTS])

    return run


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", filters: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per part, order of the filters and step.

    ``filters`` are failure conditions by letter, over ``text`` and ``words``; a filter on
    copies named E always comes besides. A document that fails a filter but was removed
    before is redundant there: all that fail it, less those it removes.
    """
    filters = text_filters() if filters is None else dict(filters)
    letters = "".join(sorted([*filters, COPY]))
    rows = with_labels(failures(docs, part, letters, filters), labels)
    counts = rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    # At most one entry for each of the masks, 32 with five filters.
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return by_part.mapInArrow(_scatter(letters), SCHEMA)
