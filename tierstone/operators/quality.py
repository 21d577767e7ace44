"""Data-quality checks. Each returns the failing rows or values: no rows means pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tierstone.functions.times import as_of_date, col_of, hour_key_date

TOLERANCE = 1e-4
BAD_SHARE_LIMIT = 0.01


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Repeated keys with their row count; keys with a NULL part are not compared."""
    keys = [columns] if isinstance(columns, str) else list(columns)
    return (
        df.select(*keys).dropna(subset=keys)
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def _outside(column: Column, values: Sequence[str]) -> Column:
    return ~column.isin(*values)


def accepted_values(df: DataFrame, column: str, values: Sequence[str], ignore_case: bool = False) -> DataFrame:
    """Values outside the list with their row count; NULL passes."""
    if ignore_case:
        failing = _outside(F.upper(column), [v.upper() for v in values])
    else:
        failing = _outside(F.col(column), values)
    return (
        df.filter(failing).groupBy(F.col(column).alias("failing_value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values with no parent row, with their row count; NULL passes.

    Child values are counted before the join, so a hot value is one row there.
    """
    values = (
        child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("failing_value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(F.col(parent_column).alias("failing_value"))
    return values.join(known, "failing_value", "left_anti")


def formula_mismatch(df: DataFrame, stored: Column | str, expected: Column, tolerance: float = TOLERANCE) -> DataFrame:
    gap = F.abs(col_of(stored) - expected)
    return df.withColumns({"expected": expected, "deviation": gap}).filter(F.col("deviation") > tolerance)


def not_positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) <= 0)


def future_hour_keys(df: DataFrame, key: str = "sk_date_time", as_of: date | str | None = None) -> DataFrame:
    return df.filter(hour_key_date(key) > as_of_date(as_of))


def empty_table(df: DataFrame) -> DataFrame:
    """One row when the table has none."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") == 0)


def bad_share(df: DataFrame, bad: Column, limit: float = BAD_SHARE_LIMIT) -> DataFrame:
    """One row (rows, bad rows, share) when the share of bad rows reaches the limit."""
    stats = df.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(bad).alias("bad_rows"))
    share = F.col("bad_rows") / F.nullif(F.col("row_count"), F.lit(0))
    return stats.withColumn("bad_share", share).filter(F.col("bad_share") >= limit)


def column_contract(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Differences between the frame's columns and the contract, order included."""
    actual = list(df.columns)
    if actual == list(expected):
        return []
    missing = [f"missing: {c}" for c in expected if c not in actual]
    extra = [f"unexpected: {c}" for c in actual if c not in expected]
    return missing + extra or ["columns are in another order"]


def missing_map_keys(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.map_contains_key(F.col(column), F.lit(k))
    return df.filter(~F.coalesce(complete, F.lit(False)))


def out_of_order(df: DataFrame, low: str, middle: str, high: str) -> DataFrame:
    return df.filter((F.col(high) < F.col(middle)) | (F.col(middle) < F.col(low)))


@dataclass(frozen=True)
class RowCheck:
    """A check every row answers alone: ``failing`` is true for a bad row."""

    name: str
    failing: Column
    severity: str = "error"


class ObservedChecks:
    """Row checks counted by whatever job writes or reads ``rows``, without a pass of their own."""

    def __init__(self, df: DataFrame, checks: Sequence[RowCheck]):
        self.spark, self.checks, self.seen = df.sparkSession, list(checks), Observation()
        self.rows = df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c.failing).alias(f"_{i}") for i, c in enumerate(checks)])

    def report(self) -> DataFrame:
        """(check_name, severity, failures); waits for the first job over ``rows``."""
        counts = self.seen.get
        found = [(c.name, c.severity, counts[f"_{i}"]) for i, c in enumerate(self.checks)]
        return self.spark.createDataFrame(found, "check_name string, severity string, failures bigint")


def run_row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All row checks in one pass: (check_name, severity, failures)."""
    counts = df.agg(*[F.count_if(c.failing).alias(f"_{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"),
                 F.col(f"_{i}").alias("failures"))
        for i, c in enumerate(checks)
    ])
    return counts.select(F.inline(rows))


def tally(named: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """Failure counts of checks given as name -> (severity, failing rows)."""
    out = None
    for name, (severity, failing) in named.items():
        one = failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "failures")
        out = one if out is None else out.unionByName(one)
    return out


def require_clean(report: DataFrame) -> None:
    """Raise when a check of severity ``error`` failed. The report has one row per check."""
    broken = [r.check_name for r in report.filter((F.col("severity") == "error") & (F.col("failures") > 0)).collect()]
    if broken:
        raise ValueError(f"data checks failed: {', '.join(sorted(broken))}")
