"""Upserts and keyed merges over DataFrames, and their table-writing forms.

Changes are classified and applied separately for a small change set against a large
target: the target is read once narrow (keys and version) and once wide, and neither
read needs a shuffle as long as Spark's own size check lets it broadcast the change
set. Beyond that size the same joins run as sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierstone.contracts import TableContract
from tierstone.session import COMPRESSION
from tierstone.sources.tables import child_names, delete_path, is_complete, move_path, path_exists

ACTION = "_action"
INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


def _filled(keys: Sequence[str]) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).isNotNull()
    return test


def classify_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    """Source rows with ``_action``: insert, update (strictly newer version) or unchanged.

    ``source`` has one row per key (``latest_per_key``). NULL keys match nothing and are
    inserts. A NULL version on either side never updates.
    """
    keys = list(keys)
    wanted = source.select(*keys).filter(_filled(keys))
    stored = (
        target.select(*keys, F.col(version_col).alias("_stored"), F.lit(True).alias("_hit"))
        .join(wanted, keys, "left_semi")
    )
    action = (
        F.when(F.col("_hit").isNull(), INSERT)
        .when(F.col(version_col) > F.col("_stored"), UPDATE)
        .otherwise(UNCHANGED)
    )
    return (
        source.join(stored, keys, "left")
        .select(*[F.col(c) for c in source.columns], action.alias(ACTION))
    )


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after a classified change set."""
    keys = list(keys)
    replaced = changes.filter(F.col(ACTION) == UPDATE).select(*keys)
    written = changes.filter(F.col(ACTION) != UNCHANGED).drop(ACTION)
    return target.join(replaced, keys, "left_anti").unionByName(written.select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    """Version-guarded upsert in one pass over both sides, for a source of the target's size.

    Newer source rows replace whole target rows, unknown keys are inserted, the rest
    stays. Each side is read and shuffled once. For a small source against a large
    target use ``classify_upsert`` and ``apply_changes``.
    """
    keys = list(keys)
    columns = target.columns
    stored = target.select(*keys, F.struct(*columns).alias("_t"))
    arrived = source.select(*keys, F.struct(*columns).alias("_s"))
    newer = F.col("_t").isNull() | (F.col("_s")[version_col] > F.col("_t")[version_col])
    row = F.when(newer, F.col("_s")).otherwise(F.col("_t"))
    return stored.join(arrived, keys, "full_outer").select(row.alias("_row")).select("_row.*")


def _action_counts() -> list[Column]:
    names = {"inserted": INSERT, "updated": UPDATE, "unchanged": UNCHANGED}
    return [F.count_if(F.col(ACTION) == action).alias(name) for name, action in names.items()]


def upsert_metrics(changes: DataFrame) -> DataFrame:
    """One row: inserted, updated and unchanged counts of a classified change set."""
    return changes.agg(*_action_counts())


def observed_changes(changes: DataFrame) -> tuple[DataFrame, Observation]:
    """The change set, and the same counts, known as soon as it has been written once."""
    seen = Observation()
    return changes.observe(seen, *_action_counts()), seen


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def keyed_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], check_unique: bool = False,
                partition_by: Sequence[str] = ()) -> DataFrame:
    """Last write wins: source rows replace target rows with the same key, others stay.

    ``check_unique`` runs a job first that rejects a source with duplicate keys; sources
    grouped by the same keys do not need it. With ``partition_by`` the target rows that stay
    are dealt by these columns; the source's rows are where they are.
    """
    keys = list(keys)
    if check_unique and not duplicate_keys(source.filter(_filled(keys)), keys).isEmpty():
        raise ValueError(f"merge source has several rows per key {keys}")
    kept = target.join(source.select(*keys), keys, "left_anti")
    return _sized_for(kept, partition_by).unionByName(source.select(*target.columns))


def replace_window(target: DataFrame, source: DataFrame, in_window: Column) -> DataFrame:
    """Delete the target's window, then insert the rebuilt rows: no join at all.

    Also removes groups whose source rows have vanished, which a merge would keep.
    """
    return target.filter(~F.coalesce(in_window, F.lit(False))).unionByName(source.select(*target.columns))


# --- table-writing forms ----------------------------------------------------------


def _sized_for(df: DataFrame, partition_by: Sequence[str], clustered: bool = False) -> DataFrame:
    """Rows of one partition together, so that each gets few files.

    Rebalancing leaves the sizes to adaptive execution: small partitions share a task,
    a large one is split over several. ``clustered`` rows lie together already.
    """
    return df.hint("rebalance", *partition_by) if partition_by and not clustered else df


def _write(df: DataFrame, path: str, partition_by: Sequence[str], overwrite: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", overwrite).option("compression", COMPRESSION)
        .partitionBy(*partition_by).parquet(path))


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), clustered: bool = False) -> None:
    """Full rebuild; the new schema replaces the old one. ``clustered``: each task has rows of few partitions."""
    _write(_sized_for(df, partition_by, clustered), path, partition_by, "static")


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions ``df`` has rows for."""
    _write(_sized_for(df, partition_by), path, partition_by, "dynamic")


def finish_stage(spark: SparkSession, path: str, partition_by: Sequence[str], stage: str) -> None:
    """Publish a result an interrupted run left complete under ``stage``; then clear the stage.

    A result in partition folders is moved, folder by folder; what a broken run has moved is not in the stage any more.
    """
    if is_complete(spark, f"{stage}/result"):
        if any("=" in name for name in child_names(spark, f"{stage}/result")):
            for folder in _leaf_folders(spark, f"{stage}/result", len(partition_by)):
                move_path(spark, f"{stage}/result/{folder}", f"{path}/{folder}")
            spark.catalog.refreshByPath(path)
        elif any(name.endswith(".parquet") for name in child_names(spark, f"{stage}/result")):
            replace_partitions(spark.read.parquet(f"{stage}/result"), path, partition_by)
    delete_path(spark, stage)


def _leaf_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders at a depth, relative to ``path``."""
    found = [""]
    for _ in range(depth):
        found = [f"{above}/{n}".lstrip("/") for above in found for n in child_names(spark, f"{path}/{above}") if "=" in n]
    return found


def _in_partitions(df: DataFrame, columns: Sequence[str]) -> Column:
    """Whether a row lies in a partition ``df`` has rows for.

    The partition values come to the driver; their number is bounded by the table's layout.
    Those of a single column are one list, which prunes folders for any number of days.
    """
    if len(columns) == 1:
        values = [r[0] for r in df.select(*columns).distinct().collect()]
        listed = F.col(columns[0]).isin([v for v in values if v is not None])
        return listed | F.col(columns[0]).isNull() if None in values else listed
    tests = [F.lit(False)]
    for values in df.select(*columns).distinct().collect():
        same = F.lit(True)
        for name, value in values.asDict().items():
            same = same & F.col(name).eqNullSafe(F.lit(value))
        tests.append(same)
    while len(tests) > 1:  # pairwise, so that the expression stays shallow
        tests = [a | b for a, b in zip_longest(tests[::2], tests[1::2], fillvalue=F.lit(False))]
    return tests[0]


def _has_table(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is there; an unfinished one needs a full refresh first."""
    if not path_exists(spark, path):
        return False
    if not is_complete(spark, path):
        raise RuntimeError(f"the last write of {path} did not finish; run a full refresh")
    return True


def merge_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                partition_by: Sequence[str], stage: str, clustered: bool = False) -> None:
    """Keyed merge into a parquet table, rewriting only the partitions the source touches.

    Every partition column must be determined by the key: then a key's old row sits in
    the partition its new row goes to. A partition per day or month keeps the rewrite as
    small as the look-back.

    The source is computed once, into ``stage``, and the merged partitions are complete
    there before the table is touched: an interrupted move loses nothing, because
    the next run finishes it first. Both are staged by partition, so that rows are dealt
    by it once. ``stage`` belongs to the table and lies in the same file system.
    """
    finish_stage(spark, path, partition_by, stage)
    if not _has_table(spark, path):
        overwrite_table(source, path, partition_by, clustered)
        return
    _write(_sized_for(source, partition_by, clustered), f"{stage}/source", partition_by, "static")
    arrived = spark.read.schema(source.schema).parquet(f"{stage}/source")
    target = spark.read.schema(source.schema).parquet(path).filter(_in_partitions(arrived, partition_by))
    _write(keyed_merge(target, arrived, keys, partition_by=partition_by), f"{stage}/result", partition_by, "static")
    finish_stage(spark, path, partition_by, stage)


def load_incremental(spark: SparkSession, path: str, build: Callable[[DataFrame | None], DataFrame],
                     keys: Sequence[str], partition_by: Sequence[str], stage: str,
                     full_refresh: bool = False, clustered: bool = False) -> None:
    """Run an incremental model: ``build(loaded)`` merged on the keys.

    ``build(None)`` is the full load, used when the table is missing and on
    ``full_refresh``, where it replaces the table.
    """
    finish_stage(spark, path, partition_by, stage)
    if full_refresh or not _has_table(spark, path):
        overwrite_table(build(None), path, partition_by, clustered)
    else:
        merge_table(spark, path, build(spark.read.parquet(path)), keys, partition_by, stage, clustered)


def merge_into_catalog(table: str, source: DataFrame, spec: TableContract) -> None:
    """The same upsert as one MERGE, for catalogs with row-level operations."""
    name = table.split(".")[-1]
    same = F.lit(True)
    for k in spec.merge_keys:
        same = same & (F.col(f"{name}.{k}") == F.col(f"s.{k}"))
    newer = F.col(f"s.{spec.version_col}") > F.col(f"{name}.{spec.version_col}")
    source.alias("s").mergeInto(table, same).whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()
