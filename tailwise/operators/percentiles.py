"""Exact medians of large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Values whose magnitudes lie within about 0.1 % of each other share a bucket.
_BUCKETS_PER_E_FOLD = 1000


def _bucket(value: Column) -> Column:
    """A monotone integer of the value: at most ~140,000 buckets over the whole double range of money."""
    magnitude = F.floor(F.log1p(F.abs(value)) * _BUCKETS_PER_E_FOLD)
    return (F.signum(value) * magnitude).cast("long")


def grouped_median(
    df: DataFrame, keys: Sequence[str], value: str, into: str = "median"
) -> DataFrame:
    """Exact median of ``value`` per group, without bringing a group into one task.

    The built-in exact percentile keeps all distinct values of a group in one buffer. Here equal
    values are first counted (combined before the shuffle and spread over all tasks by value);
    counts per value bucket locate the one or two buckets that hold the middle ranks; only those
    buckets are ordered.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", _bucket(F.col("v")))
    )
    group = Window.partitionBy(*keys)
    below = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counts.groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("in_bucket"))
        .withColumns(
            {
                "before": F.coalesce(F.sum("in_bucket").over(below), F.lit(0)),
                "total": F.sum("in_bucket").over(group),
            }
        )
    )
    low = F.floor((F.col("total") + 1) / 2).cast("long")
    high = (F.floor(F.col("total") / 2) + 1).cast("long")
    first, last = F.col("before") + 1, F.col("before") + F.col("in_bucket")
    middle = buckets.withColumns({"low": low, "high": high}).filter(
        F.col("low").between(first, last) | F.col("high").between(first, last)
    )
    target = middle.select(
        *[F.col(k).alias(f"middle_{k}") for k in keys],
        F.col("bucket").alias("middle_bucket"),
        "before",
        "low",
        "high",
    )
    same_group = [F.col(k).eqNullSafe(F.col(f"middle_{k}")) for k in keys]
    candidates = counts.join(target, [*same_group, F.col("bucket") == F.col("middle_bucket")])
    within = Window.partitionBy(*keys, "bucket").orderBy("v")
    upto = F.col("before") + F.sum("n").over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = candidates.withColumn("upto", upto)
    start = F.col("upto") - F.col("n") + 1

    def holds(rank: str) -> Column:
        return F.max(F.when(F.col(rank).between(start, F.col("upto")), F.col("v")))

    return ranked.groupBy(*keys).agg(((holds("low") + holds("high")) / 2).alias(into))
