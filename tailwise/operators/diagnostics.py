"""Checks of the assumptions behind Chain Ladder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import count_when
from .chainladder import SEGMENT, link_ratios


def full_cells(rows: Column, columns: Column) -> Column:
    """Cells of a full triangle: row i of J columns has J - i cells, and none from row J on."""
    filled = F.least(rows, columns)
    return filled * columns - F.floor(filled * (filled - 1) / 2)


def completeness(cells: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Observed cells against the cells a full triangle of this shape would have."""
    shape = cells.groupBy(*by).agg(
        F.count_distinct("origin_period").alias("n_origins"),
        F.count_distinct("development_period").alias("n_development_periods"),
        F.count("cumulative_value").alias("actual_cells"),
    )
    rows, columns = F.col("n_origins"), F.col("n_development_periods")
    expected = full_cells(rows, columns)
    return shape.withColumn("expected_cells", expected.cast("long")).withColumn(
        "completeness_pct", F.try_divide(F.col("actual_cells"), F.col("expected_cells")) * 100.0
    )


def development_stability(cells: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Spread of the link ratios per age, with the population standard deviation.

    Ages without a pair stay in the result with n = 0; the last age, which has no next, does not.
    """
    mean = F.col("mean_factor")
    ratios = link_ratios(cells, by)
    last = F.max("development_period").over(Window.partitionBy(*by))
    return (
        ratios.withColumn("last_age", last)
        .filter(F.col("development_period") < F.col("last_age"))
        .groupBy(*by, "development_period")
        .agg(
            F.count("link_ratio").alias("n_observations"),
            F.avg("link_ratio").alias("mean_factor"),
            F.median("link_ratio").alias("median_factor"),
            F.stddev_pop("link_ratio").alias("std_factor"),
            F.min("link_ratio").alias("min_factor"),
            F.max("link_ratio").alias("max_factor"),
        )
        .withColumn(
            "cv",
            F.when(mean > 0, F.try_divide("std_factor", mean)).when(mean.isNotNull(), F.lit(0.0)),
        )
    )


def _scored_ratios(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    ages = Window.partitionBy(*by, "development_period")
    ratios = link_ratios(cells, by).filter(F.col("link_ratio").isNotNull())
    return ratios.withColumns(
        {
            "n_observations": F.count("link_ratio").over(ages),
            "mean_factor": F.avg("link_ratio").over(ages),
            "std_factor": F.stddev_pop("link_ratio").over(ages),
        }
    ).withColumn(
        "z_score",
        F.when(
            F.col("std_factor") > 0,
            F.try_divide(F.col("link_ratio") - F.col("mean_factor"), F.col("std_factor")),
        ).otherwise(F.lit(0.0)),
    )


def detect_outliers(
    cells: DataFrame, by: Sequence[str] = SEGMENT, threshold: float = 2.0
) -> DataFrame:
    """Link ratios more than ``threshold`` standard deviations from their age's mean."""
    scored = _scored_ratios(cells, by)
    extreme = (F.col("n_observations") >= 3) & (F.abs("z_score") > threshold)
    return scored.filter(extreme).select(
        *by,
        "origin_period",
        "development_period",
        "link_ratio",
        "mean_factor",
        "z_score",
        F.when(F.col("z_score") > 0, "HIGH").otherwise("LOW").alias("outlier_type"),
    )


def triangle_quality(
    cells: DataFrame,
    by: Sequence[str] = SEGMENT,
    threshold: float = 2.0,
    max_cv: float = 0.3,
    min_completeness: float = 90.0,
) -> DataFrame:
    """GOOD, FAIR or POOR per segment: how many of three checks raise an issue.

    Stability and outliers are counted from windows over the ratios, then folded together with the
    shape, so the cells are read once.
    """
    ages = Window.partitionBy(*by, "development_period")
    ratios = link_ratios(cells, by).withColumns(
        {
            "n_observations": F.count("link_ratio").over(ages),
            "mean_factor": F.avg("link_ratio").over(ages),
            "std_factor": F.stddev_pop("link_ratio").over(ages),
        }
    )
    mean, std = F.col("mean_factor"), F.col("std_factor")
    unstable = (mean > 0) & (F.try_divide(std, mean) > max_cv)
    distance = F.abs(F.try_divide(F.col("link_ratio") - mean, std))
    outlier = (F.col("n_observations") >= 3) & (std > 0) & (distance > threshold)
    folded = ratios.groupBy(*by).agg(
        F.count_distinct(F.when(unstable, F.col("development_period"))).alias("high_cv_periods"),
        count_when(outlier).alias("n_outliers"),
        F.count_distinct("origin_period").alias("n_origins"),
        F.count_distinct("development_period").alias("n_ages"),
        F.count("cumulative_value").alias("actual_cells"),
    )
    rows, columns = F.col("n_origins"), F.col("n_ages")
    expected = full_cells(rows, columns)
    complete = F.try_divide(F.col("actual_cells"), expected) * 100.0
    scored = folded.withColumn("completeness_pct", complete)
    issues = (
        (F.col("high_cv_periods") > 0).cast("int")
        + (F.col("n_outliers") > 0).cast("int")
        + (F.col("completeness_pct") < min_completeness).cast("int")
    )
    counted = scored.withColumn("n_issues", issues)
    grade = F.when(F.col("n_issues") == 0, "GOOD").when(F.col("n_issues") == 1, "FAIR")
    return counted.select(
        *by,
        "high_cv_periods",
        "n_outliers",
        "completeness_pct",
        "n_issues",
        grade.otherwise("POOR").alias("overall_quality"),
    )
