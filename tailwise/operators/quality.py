"""Data quality checks that return report rows, one aggregation per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import count_when, ratio


class QualityError(ValueError):
    """Raised in strict mode when a check fails."""


def _empty(df: DataFrame, column: str) -> Column:
    is_null = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, T.StringType):
        return is_null | (F.col(column) == "")
    return is_null


def check_nulls(df: DataFrame, columns: Sequence[str], threshold: float = 0.0) -> DataFrame:
    """Null (or empty string) count and share per column, from one scan for all columns.

    Columns the table does not have are skipped.
    """
    present = [c for c in columns if c in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[count_when(_empty(df, c)).alias(c) for c in present],
    )
    share = F.coalesce(ratio("null_count", "total_rows"), F.lit(0.0))
    return (
        counts.unpivot(["total_rows"], present, "column_name", "null_count")
        .withColumn("null_pct", share)
        .withColumn("passed", F.col("null_pct") <= threshold)
    )


def check_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total against distinct keys.

    Rows are counted per key first: the map side combines repeats of a frequent key, and the final
    sum adds up partial totals, so no task holds all rows of a key.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    )
    duplicates = F.col("total_rows") - F.col("distinct_rows")
    return counted.withColumns(
        {
            "duplicate_rows": duplicates,
            "duplicate_pct": F.coalesce(F.try_divide(duplicates, F.col("total_rows")), F.lit(0.0)),
            "passed": duplicates == 0,
        }
    )


def check_value_range(
    df: DataFrame, column: str, minimum: float | None = None, maximum: float | None = None
) -> DataFrame:
    """Actual minimum and maximum and the number of values outside the limits."""
    value = F.col(column)
    outside = F.lit(False)
    if minimum is not None:
        outside = outside | (value < minimum)
    if maximum is not None:
        outside = outside | (value > maximum)
    stats = df.agg(
        F.min(value).alias("actual_min"),
        F.max(value).alias("actual_max"),
        count_when(outside).alias("violations"),
    )
    return stats.select(
        F.lit(column).alias("column_name"),
        "actual_min",
        "actual_max",
        F.lit(minimum).cast("double").alias("expected_min"),
        F.lit(maximum).cast("double").alias("expected_max"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def check_domain(
    df: DataFrame, required: Sequence[str], allowed: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Missing values of required columns and values outside an enumeration, in one scan."""
    rules = {f"{c} is required": _empty(df, c) for c in required}
    for column, values in allowed.items():
        unknown = F.col(column).isNotNull() & ~F.col(column).isin(*values)
        rules[f"{column} in enumeration"] = unknown
    names = list(rules)
    counts = df.agg(*[count_when(bad).alias(name) for name, bad in rules.items()])
    return counts.unpivot([], names, "rule", "violations").withColumn(
        "passed", F.col("violations") == 0
    )


def orphan_payments(payments: DataFrame, claims: DataFrame) -> DataFrame:
    """Payments whose claim does not exist."""
    return payments.join(claims.select("claim_id"), "claim_id", "left_anti")


def quality_summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: how many of its rows passed and failed."""
    parts = []
    for name, report in checks.items():
        parts.append(
            report.agg(
                F.lit(name).alias("check_name"),
                F.count(F.lit(1)).alias("total_checks"),
                count_when(F.col("passed")).alias("passed_checks"),
                count_when(~F.col("passed")).alias("failed_checks"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def enforce(report: DataFrame) -> None:
    """Strict mode: raise with every failed row of a check report (one row per column or rule)."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        raise QualityError("; ".join(str(row.asDict()) for row in failed))
