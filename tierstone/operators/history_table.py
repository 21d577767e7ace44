"""A slowly changing dimension, type 2, as a stored table.

* ``closed/run=<n>``: the versions that run n closed, appended and never touched again;
* ``open/<generation>/key_bucket=<b>``: the current versions, by key hash;
* ``head/<n>``: what run n left, written last.

A run reads the open rows and the source, finds the keys that changed, came or went, and
writes their closed versions and the buckets they fall into. What is closed already is
neither read nor written, so a run's work does not grow with the length of the history. A
run that breaks off leaves the table as it was; its files are replaced by the next run.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.operators.history import current_rows, is_current, snapshot
from tierstone.session import materialise
from tierstone.sources import heads
from tierstone.sources.heads import BUCKET, Head

RUN = "run"
BUCKETS = 16


class HistoryTable:
    """``buckets`` is fixed for the life of the table; one run at a time."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], updated_at: str, source_schema: T.StructType, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.updated_at, self.buckets = spark, path, list(keys), updated_at, buckets
        stamp, text = T.TimestampType(), T.StringType()
        added = [("updated_at", stamp), ("valid_from", stamp), ("scd_id", text), ("valid_to", stamp)]
        known = [f for f in source_schema.fields if f.name not in dict(added)]
        self.schema = T.StructType([*known, *[T.StructField(n, t) for n, t in added]])
        self.open_folder = f"{path}/open"

    def _read(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _open(self, head: Head, buckets: Sequence[int] | None = None) -> DataFrame:
        return self._read(heads.bucket_paths(self.open_folder, head, buckets))

    def current(self) -> DataFrame:
        """The open versions alone."""
        return self._open(heads.newest(self.spark, self.path))

    def closed(self) -> DataFrame:
        """The closed versions of all finished runs."""
        runs = heads.newest(self.spark, self.path).notes.get("runs", [])
        return self._read([f"{self.path}/closed/{RUN}={n}" for n in runs])

    def read(self) -> DataFrame:
        return self.current().unionByName(self.closed())

    def changed_keys(self, open_rows: DataFrame, source: DataFrame, hard_deletes: bool) -> DataFrame:
        """Keys with a version newer than the open one, without an open one, or missing from the source; with their bucket."""
        at = F.col(self.updated_at)
        arrived = source.groupBy(*self.keys).agg(F.max(at).alias("_newest"), F.first(F.lit(True)).alias("_seen"))
        marks = open_rows.select(*self.keys, F.col("updated_at").alias("_open_at"))
        newer = F.col("_newest").isNotNull() & (F.col("_open_at").isNull() | (F.col("_newest") > F.col("_open_at")))
        gone = F.col("_seen").isNull() & F.lit(hard_deletes)
        both = arrived.join(marks, self.keys, "full_outer").filter(newer | gone)
        return both.select(*self.keys, heads.bucket_of(self.keys, self.buckets).alias(BUCKET))

    def step(self, source: DataFrame, run_at: datetime | str | None = None, hard_deletes: bool = True) -> bool:
        """One snapshot run over the source, as ``history.snapshot`` defines it; whether anything changed."""
        head = heads.newest(self.spark, self.path)
        heads.remove_old_buckets(self.spark, self.open_folder, head)
        heads.remove_old_heads(self.spark, self.path)
        touched = materialise(self.changed_keys(self._open(head), source, hard_deletes), "changed-keys")
        buckets = [r[0] for r in touched.select(BUCKET).distinct().collect()]  # no more than the table has
        if not buckets:
            return False
        keys, number = touched.select(*self.keys), head.number + 1
        stored = self._open(head, buckets)
        # Each open row is read once more for its bucket, and the source for the changed keys.
        before = stored.join(keys, self.keys, "left_semi").select(*self.schema.fieldNames())
        rows = source.join(keys, self.keys, "left_semi").select(*source.columns)
        after = materialise(
            snapshot(before, rows, self.keys, self.updated_at, run_at, hard_deletes).select(*self.schema.fieldNames()), "changed-versions")
        after.filter(~is_current()).write.mode("overwrite").parquet(f"{self.path}/closed/{RUN}={number}")
        kept = stored.join(keys, self.keys, "left_anti").select(*self.schema.fieldNames())
        opened = kept.unionByName(current_rows(after)).withColumn(BUCKET, heads.bucket_of(self.keys, self.buckets))
        heads.write_buckets(opened.hint("rebalance", BUCKET), self.open_folder, number)
        filled = {int(r[0]) for r in opened.select(BUCKET).distinct().collect()}
        generations = {b: g for b, g in head.generations.items() if b not in buckets} | dict.fromkeys(sorted(filled), number)
        heads.publish(self.spark, self.path, Head(number, generations, {"runs": [*head.notes.get("runs", []), number]}))
        return True
