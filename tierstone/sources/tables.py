"""Table scans and the few file-system questions the writers ask."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether an earlier write to ``path`` finished."""
    return path_exists(spark, f"{path}/_SUCCESS")


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder, in place of what is there."""
    fs, p = _fs(spark, target)
    fs.delete(p, True)
    fs.mkdirs(p.getParent())
    if not fs.rename(_fs(spark, source)[1], p):
        raise OSError(f"{source} could not be moved to {target}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly in ``path``."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def has_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> bool:
    """Whether any file with the suffix lies in ``path`` or below; stops at the first."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    listing = fs.listFiles(p, True)
    while listing.hasNext():
        if listing.next().getPath().getName().endswith(suffix):
            return True
    return False


def file_paths(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """All files with the suffix in ``path`` and below, sorted."""
    fs, p = _fs(spark, path)
    found, listing = [], fs.listFiles(p, True) if fs.exists(p) else None
    while listing is not None and listing.hasNext():
        file = listing.next().getPath().toString()
        if file.endswith(suffix):
            found.append(file)
    return sorted(found)


def first_line(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(spark.sparkContext._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    line = reader.readLine()
    reader.close()
    return line


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file that is there whole or not at all."""
    unfinished = f"{path}.unfinished"
    write_text(spark, unfinished, text)
    fs, p = _fs(spark, path)
    if not fs.rename(_fs(spark, unfinished)[1], p):
        raise FileExistsError(path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files in ``path`` and below, 0 if there is none."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               merge_schema: bool = False) -> DataFrame:
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    return (reader.schema(schema) if schema is not None else reader).parquet(path)
