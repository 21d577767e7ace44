"""The operators of this subpackage over whole tables, as named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm import (
    block_naming, bwt_repeats, compression_toxicity, gru_lm, hilbert_zones, html_regions, order_minhash, packing,
    pattern_bootstrap, removal_ranks, site_quality, snapshot_collapse, wu_manber,
)
from tierstone.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


@query
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = block_naming.groups_of_equal_texts(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


@query
def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot_collapse.collapse_and_render(table(spark, folder, "conversations"))


@query
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = wu_manber.find_benchmark(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_regions.extract(table(spark, folder, "pages"))


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return compression_toxicity.score(docs, compression_toxicity.fit(docs, table(spark, folder, "labels")))


@query
def op2_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: the smallest doc_id of its near-copy class, and whether it is the one that stays."""
    found = order_minhash.near_copies(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "kept")


@query
def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = bwt_repeats.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("runs").cast("bigint").alias("n_spans"), "kept_sha256")


@query
def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return gru_lm.score(table(spark, folder, "documents"))


@query
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """The source of a document is its host, the language its path."""
    return site_quality.classify(
        table(spark, folder, "documents"), table(spark, folder, "labels"), F.col("source"), F.coalesce("lang", F.lit("")))


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return removal_ranks.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op12_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest are of the base spans; ``spans`` has the added ones too, ``n_added`` counts them."""
    found = pattern_bootstrap.find(table(spark, folder, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(pattern_bootstrap.KINDS)
    ]
    every = F.array_sort(F.concat("base", "added"))
    return found.select(
        "doc_id", *counts, F.sha2(pattern_bootstrap.written(F.col("base")), 256).alias("base_sha256"),
        pattern_bootstrap.written(every).alias("spans"), F.size("added").cast("bigint").alias("n_added"))


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh id has the next label; every fiftieth is an anchor."""
    moved = ((F.col("label").cast("bigint") + 1) % 10).cast("int")
    vectors = table(spark, folder, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label")))
    return hilbert_zones.hard_negatives(vectors, F.col("vec_id") % 50 == 0)
