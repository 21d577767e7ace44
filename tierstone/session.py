"""Session settings the library depends on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SCAN_BYTES = 16 << 20
# Of the files this library writes.
COMPRESSION = "zstd"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC: hour keys and dates are defined on UTC instants.

    Scans are split into tasks of ``SCAN_BYTES`` at most. Packed rows of a contract take some
    thirty times as much memory as in the file; larger tasks spill them in every sort before a
    shuffle. A smaller limit of the session stays.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > SCAN_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SCAN_BYTES))
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on local masters."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tierstone-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for one run under the shared root."""
    return f"{shared_root(spark)}/tierstone/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage with files that outlive an executor, for frames that several
    branches of a plan (or several jobs) read.
    """
    path = scratch_dir(df.sparkSession, label)
    writer = df.write.mode("errorifexists").option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(run: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function whose jobs leave no shuffle files behind.

    A stream runs its batches in a session of its own, so the setting reaches no other job.
    Elsewhere shuffle files wait for the driver to collect garbage.
    """

    def tidied(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set(CLEANUP_CONF, "true")
        run(batch, batch_id)

    return tidied


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for functions that run in Python there."""
    context = spark.sparkContext
    if getattr(context, "_tierstone_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tierstone-")) / "tierstone.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent).as_posix())
    context.addPyFile(str(archive))
    context._tierstone_shipped = True
