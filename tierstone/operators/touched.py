"""Derived tables kept up to date by recomputing exactly the groups their changes touch.

A look-back window recomputes recent groups and misses what changes later. Here the changed
rows themselves say which groups are stale: those they fall into now and those they fell
into before. These groups are rebuilt from all their rows and swapped in as a whole, so a
group whose rows have all gone disappears. The work follows the changes, however late they are.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.operators.merge import _has_table, _in_partitions, overwrite_table, replace_partitions
from tierstone.session import materialise
from tierstone.sources.tables import delete_path, is_complete, read_text, write_text


def touched_groups(grain: Sequence[str], *images: DataFrame) -> DataFrame:
    """The groups that rows fall into, each once. Pass the changed rows as they are and as they were."""
    return reduce(DataFrame.unionByName, [image.select(*grain) for image in images]).distinct()


def _matched(df: DataFrame, touched: DataFrame, grain: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join in which NULL is a value like others."""
    marks = touched.select(*[F.col(c).alias(f"_t_{c}") for c in grain])
    on = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in grain]
    return df.join(marks, on, how)


def rows_of_groups(source: DataFrame, touched: DataFrame, grain: Sequence[str]) -> DataFrame:
    """All source rows of the touched groups."""
    return _matched(source, touched, grain, "left_semi")


def swap_groups(target: DataFrame, rebuilt: DataFrame, touched: DataFrame, grain: Sequence[str]) -> DataFrame:
    """The target with the touched groups replaced by what was rebuilt of them."""
    return _matched(target, touched, grain, "left_anti").unionByName(rebuilt.select(*target.columns))


def finish_swap(spark: SparkSession, path: str, partition_by: Sequence[str], stage: str) -> None:
    """Publish a swap that an interrupted run left complete under ``stage``; then clear the stage."""
    if is_complete(spark, f"{stage}/result"):
        replace_partitions(spark.read.parquet(f"{stage}/result"), path, partition_by)
        for folder in json.loads(read_text(spark, f"{stage}/emptied.json")):
            delete_path(spark, f"{path}/{folder}")
    delete_path(spark, stage)


def swap_table(spark: SparkSession, path: str, rebuilt: DataFrame, touched: DataFrame, grain: Sequence[str],
               partition_by: str, partition: Column, stage: str) -> None:
    """``swap_groups`` on a stored table, rewriting only the partitions that hold touched groups.

    ``partition`` derives the partition column, a whole number, from the grain, so old and
    new rows of a group share one partition. The new partitions are complete in ``stage``
    before the table is touched; partitions left without rows are removed.
    """
    finish_swap(spark, path, [partition_by], stage)
    marks = materialise(touched.withColumn(partition_by, partition), "touched-groups")
    if marks.isEmpty():
        return
    folders = marks.select(partition_by).distinct()
    target = spark.read.parquet(path).filter(_in_partitions(folders, [partition_by]))
    after = materialise(swap_groups(target, rebuilt.withColumn(partition_by, partition), marks, grain), "swapped-groups")
    # One folder for each day or month that was touched; their names are bounded by the table's layout.
    gone = folders.join(after.select(partition_by).distinct(), partition_by, "left_anti")
    names = [f"{partition_by}={r[0]}" for r in gone.collect()]
    write_text(spark, f"{stage}/emptied.json", json.dumps(names))
    after.write.mode("overwrite").parquet(f"{stage}/result")
    finish_swap(spark, path, [partition_by], stage)


def maintain(spark: SparkSession, path: str, build: Callable[[DataFrame | None], DataFrame],
             touched: Callable[[DataFrame], DataFrame], grain: Sequence[str], partition_by: str, partition: Column,
             stage: str, full_refresh: bool = False) -> None:
    """Run a model whose stale groups are known: load it, or swap what its changes touch.

    ``build(None)`` is the full load, ``build(groups)`` the rows of some groups;
    ``touched(stored)`` names the stale ones, given the table as it is.
    """
    finish_swap(spark, path, [partition_by], stage)
    if full_refresh or not _has_table(spark, path):
        overwrite_table(build(None).withColumn(partition_by, partition), path, [partition_by])
        return
    groups = materialise(touched(spark.read.parquet(path)), "stale-groups")
    swap_table(spark, path, build(groups), groups, grain, partition_by, partition, stage)
