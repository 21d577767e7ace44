"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Sorting the distinct blocks gives
each an integer name; adjacent names are paired and the sorted distinct pairs are named
again, until every document is left with one name. Two documents get the same last name
exactly when their normalised texts are equal: a name stands for one block or one pair,
never for a hash value.

Blocks are sorted by fingerprint first and by content within a fingerprint, so the bytes
of a block travel once (for the distinct blocks, combined before the shuffle) and later
rounds move integers only.

Defined cases: a null text counts as empty; empty texts are equal to each other; repeated
rows are members of their group like any others, and one of them stays; a null doc_id is
a row like any other, but stays only where its group has no other id; an empty table
gives an empty result; other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.session import materialise

BLOCK_BYTES = 4096
# A name holds its level above these bits, so names of different levels differ.
LEVEL_BITS = 57
ROW = ["doc_id", "sha"]


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def text_rows(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """doc_id, the normalised text as bytes, and its SHA-256."""
    body = normalised(F.col("text")) if text is None else text
    rows = docs.select("doc_id", body.cast("binary").alias("body"))
    return rows.withColumn("sha", F.unhex(F.sha2("body", 256)))


def _blocks(rows: DataFrame, block_bytes: int, fingerprint: Callable[[Column], Column]) -> DataFrame:
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / F.lit(block_bytes))).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.substring(F.col("body"), i * block_bytes + 1, F.lit(block_bytes)),
    )
    rows = rows.withColumn("n", n)
    rows = rows.select(*[c for c in rows.columns if c != "body"], F.posexplode(cut).alias("pos", "block"))
    return rows.withColumn("print", fingerprint(F.col("block")))


def _named(keys: DataFrame, order: list[str], level: int, label: str) -> DataFrame:
    """The distinct keys with integer names that grow in their sorted order.

    Written once: names stay the same however often a later stage is run again.
    """
    ordered = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    name = F.monotonically_increasing_id() + F.lit(level << LEVEL_BITS)
    return materialise(ordered.withColumn("name", name), label)


def document_names(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, fingerprint: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """doc_id, sha, copies (input rows alike in both) and the last name of each document."""
    contents = _blocks(text_rows(docs), block_bytes, fingerprint).select("print", "block").distinct()
    prints = materialise(contents.groupBy("print").agg(F.count(F.lit(1)).alias("contents")), "block-prints")
    places = _blocks(text_rows(docs), block_bytes, fingerprint)
    clashes = prints.where("contents > 1")
    if clashes.isEmpty():
        places = places.withColumn("rank", F.lit(0))
        keys = prints.select("print", F.lit(0).alias("rank"))
    else:
        # Different blocks of one fingerprint are told apart by their content.
        ranked = contents.join(clashes, "print", "left_semi").selectExpr(
            "print", "block", "row_number() over (partition by print order by block) - 1 as rank")
        ranked = materialise(ranked, "block-clashes")
        places = places.join(ranked, ["print", "block"], "left").withColumn("rank", F.coalesce("rank", F.lit(0)))
        keys = prints.select("print", F.explode(F.sequence(F.lit(0), F.col("contents").cast("int") - 1)).alias("rank"))
    names = _named(keys, ["print", "rank"], 0, "block-names")
    places = places.groupBy(*ROW, "n", "pos", "print", "rank").agg(F.count(F.lit(1)).alias("copies"))
    state = materialise(places.join(names, ["print", "rank"]).select(*ROW, "copies", "n", "pos", "name"), "block-state")

    ended, level = [], 0
    while True:
        ended.append(state.where("n = 1").select(*ROW, "copies", "name"))
        open_rows = state.where("n > 1")
        if open_rows.isEmpty():
            return reduce(DataFrame.unionByName, ended)
        level += 1
        half = F.when(F.col("pos") % 2 == 0, F.col("name"))
        other = F.when(F.col("pos") % 2 == 1, F.col("name"))
        pairs = open_rows.groupBy(*ROW, "copies", "n", F.floor(F.col("pos") / 2).alias("pos")).agg(
            F.max(half).alias("left_name"), F.coalesce(F.max(other), F.lit(-1)).alias("right_name"))
        both = ["left_name", "right_name"]
        names = _named(pairs.select(*both).distinct(), both, level, f"pair-names-{level}")
        state = materialise(
            pairs.join(names, both).select(
                *ROW, "copies", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"),
            f"pair-state-{level}",
        )


def _grouped(named: DataFrame) -> DataFrame:
    groups = named.groupBy("name").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return named.join(groups, "name").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def groups_of_equal_texts(docs: DataFrame, block_bytes: int = BLOCK_BYTES, **options) -> DataFrame:
    """One row per input row: doc_id, sha, keep_id, group_size, kept."""
    rows = _grouped(document_names(docs, block_bytes, **options))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(*ROW, "keep_id", "group_size", (F.col("kept") & (F.col("copy") == 1)).alias("kept"))


def drop_exact_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that stay, with all their columns."""
    stays = materialise(_grouped(document_names(docs, block_bytes)).where("kept").select(*ROW, "copies"), "exact-kept")
    keyed = docs.withColumn("__sha", F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)))
    wanted = stays.select(F.col("doc_id").alias("__doc_id"), F.col("sha").alias("__sha_kept"))
    same = keyed["doc_id"].eqNullSafe(wanted["__doc_id"]) & (keyed["__sha"] == wanted["__sha_kept"])
    left = keyed.join(wanted, same, "left_semi")
    if not stays.where("copies > 1").isEmpty():
        # Rows alike in id and text cannot be told apart by the join: one of them stays.
        left = left.dropDuplicates(["doc_id", "__sha"])
    return left.drop("__sha")
