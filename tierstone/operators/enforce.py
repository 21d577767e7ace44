"""Schema enforcement, audit columns, latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.contracts import TENANT
from tierstone.functions.times import as_of_timestamp

# Column of raw texts that did not convert.
RESCUED = "_rescued"
# Types without an order; they cannot break ties.
_UNORDERED = (T.MapType, T.VariantType)


def enforce_schema(df: DataFrame, schema: T.StructType, mode: str = "strict") -> DataFrame:
    """Project ``df`` onto a contract: cast known columns, NULL for missing, drop unknown.

    ``strict`` fails on a malformed value, ``try`` turns it into NULL. An empty schema
    passes the frame through.
    """
    if not schema.fields:
        return df
    present = set(df.columns)
    columns = []
    for field in schema.fields:
        if field.name not in present:
            value = F.lit(None).cast(field.dataType)
        elif mode == "try":
            value = F.col(field.name).try_cast(field.dataType)
        else:
            value = F.col(field.name).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def malformed_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in which at least one filled value does not convert to the contract type."""
    bad = F.lit(False)
    for field in schema.fields:
        if field.name in df.columns:
            bad = bad | (F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull())
    return df.filter(bad)


def rescue(df: DataFrame, schema: T.StructType, out: str = RESCUED) -> DataFrame:
    """The contract's columns as ``try`` gives them, and what they lost: a map of column to raw text.

    The map is NULL where every filled value converts. One pass does both; ``split_rescued``
    parts the rows afterwards.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    lost = []
    for field in schema.fields:
        if field.name in kinds and kinds[field.name] != field.dataType:
            bad = F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull()
            lost.append(F.when(bad, F.struct(F.lit(field.name).alias("k"), F.col(field.name).cast("string").alias("v"))))
    if RESCUED in kinds:  # found by the reader already
        kept = F.map_entries(F.coalesce(F.col(RESCUED), F.create_map().cast("map<string,string>")))
        kept = F.transform(kept, lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v")))
    else:
        kept = F.array().cast("array<struct<k:string,v:string>>")
    found = F.concat(kept, F.filter(F.array(*lost), lambda e: e.isNotNull())) if lost else kept
    entries = F.map_from_entries(found)
    return enforce_schema(df.withColumn("_lost", F.when(F.size(found) > 0, entries)), T.StructType([
        *schema.fields, T.StructField("_lost", T.MapType(T.StringType(), T.StringType()))]), "try").withColumnRenamed("_lost", out)


def split_rescued(rows: DataFrame, out: str = RESCUED) -> tuple[DataFrame, DataFrame]:
    """Good rows in contract shape, and quarantined ones with the map of what they lost."""
    return rows.filter(F.col(out).isNull()).drop(out), rows.filter(F.col(out).isNotNull())


def stamp(df: DataFrame, country: str | None = None, now: datetime | str | None = None,
          out: str = "last_update") -> DataFrame:
    """Overwrite the country column (where given) and add the audit time."""
    extra = {out: as_of_timestamp(now)}
    if country is not None:
        extra[TENANT] = F.lit(country)
    return df.withColumns(extra)


def tie_break_order(df: DataFrame, leading: Sequence[Column], skip: Sequence[str]) -> list[Column]:
    """``leading`` followed by every other sortable column, so that the order is total."""
    rest = [f.name for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, _UNORDERED)]
    return [*leading, *[F.col(c).desc_nulls_last() for c in sorted(rest)]]


def latest_per_key(df: DataFrame, keys: str | Sequence[str], version_col: str,
                   tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the highest version, NULL versions last.

    Ties go to the largest remaining columns, so reruns pick the same row. Spark keeps
    only one row per key and input partition before the shuffle (window group limit),
    so a hot key costs at most one row per map task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    newest = F.col(version_col).desc_nulls_last()
    if tie_breakers is None:
        order = tie_break_order(df, [newest], [*keys, version_col])
    else:
        order = [newest, *[F.col(c).desc_nulls_last() for c in tie_breakers]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
