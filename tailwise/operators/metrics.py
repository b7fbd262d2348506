"""Reserve summary, metric views, metric catalogue and alerts."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import band, ratio, rounded

# Solvency bands and alert limits.
ADEQUACY_BANDS = [(1.0, "ADEQUATE"), (0.85, "MARGINAL")]
TRAFFIC_LIGHTS = [(1.0, "GREEN"), (0.85, "YELLOW")]
MIN_ADEQUACY = 0.85
MAX_HIGH_RISK_EXPOSURE = 1_000_000.0


def adequacy_status(adequacy: Column) -> Column:
    return band(adequacy, ADEQUACY_BANDS, "DEFICIENT")


# --- reserve summary -------------------------------------------------------------------------


def _totals(estimates: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return estimates.groupBy(*by).agg(
        F.coalesce(F.sum("latest_cumulative"), F.lit(0.0)).alias("total_paid"),
        F.coalesce(F.sum("ibnr"), F.lit(0.0)).alias("total_ibnr"),
        F.coalesce(F.sum("ultimate_loss"), F.lit(0.0)).alias("total_ultimate"),
    )


def _labelled(totals: DataFrame, as_of: dt.date) -> DataFrame:
    labels = {"as_of_date": F.lit(as_of), "triangle_type": F.lit("paid"), "loss_type": F.lit("ALL")}
    return totals.withColumns({k: v for k, v in labels.items() if k not in totals.columns})


def reserve_summary(estimates: DataFrame, loading: DataFrame, as_of: dt.date) -> DataFrame:
    """Totals with the risk loading applied to the IBNR; adequacy is the loading itself.

    ``estimates`` holds one row per origin (not detail *and* total rows); ``loading`` is one row.
    """
    factor, ibnr = F.col("ai_adjustment_factor"), F.col("total_ibnr")
    return _labelled(_totals(estimates).crossJoin(loading), as_of).withColumns(
        {
            "held_reserves": ibnr * factor,
            "reserve_adequacy": factor,
            "reserve_margin": ibnr * (factor - 1),
        }
    )


def reserve_summary_held(loaded: DataFrame, as_of: dt.date) -> DataFrame:
    """Totals where the loaded IBNR is held; adequacy is held / IBNR (1 when there is none).

    ``loaded`` is the output of ``load_for_risk``.
    """
    totals = loaded.agg(
        F.sum("latest_cumulative").alias("total_paid"),
        F.sum("ibnr").alias("total_ibnr"),
        F.sum("ultimate_loss").alias("total_ultimate"),
        F.sum("ai_adjusted_ibnr").alias("held_reserves"),
        F.max("ai_adjustment_factor").alias("ai_adjustment_factor"),
    )
    held, ibnr = F.col("held_reserves"), F.col("total_ibnr")
    adequacy = F.when(ibnr > 0, F.try_divide(held, ibnr)).otherwise(F.lit(1.0))
    return _labelled(totals, as_of).withColumns(
        {"reserve_adequacy": adequacy, "reserve_margin": held - ibnr}
    )


def reserve_summary_by_segment(
    estimates: DataFrame, loading: DataFrame, as_of: dt.date, by: str = "loss_type"
) -> DataFrame:
    """The loaded summary with one row per segment."""
    factor, ibnr = F.col("ai_adjustment_factor"), F.col("total_ibnr")
    return _labelled(_totals(estimates, (by,)).crossJoin(loading), as_of).withColumns(
        {
            "held_reserves": ibnr * factor,
            "reserve_adequacy": factor,
            "reserve_margin": ibnr * (factor - 1),
        }
    )


# --- views -----------------------------------------------------------------------------------


def reserve_adequacy_view(summary: DataFrame) -> DataFrame:
    """The summary's own adequacy with its status."""
    return summary.select(
        "as_of_date",
        "loss_type",
        F.col("total_ultimate").alias("estimated_ultimate_loss"),
        "held_reserves",
        "reserve_adequacy",
        adequacy_status(F.col("reserve_adequacy")).alias("adequacy_status"),
        "total_ibnr",
        "reserve_margin",
        "ai_adjustment_factor",
    )


def reserve_adequacy_recomputed(summary: DataFrame) -> DataFrame:
    """Adequacy as held reserves over ultimate (1 when the ultimate is 0)."""
    held, ultimate = F.col("held_reserves"), F.col("total_ultimate")
    status = (
        F.when(held >= ultimate, "ADEQUATE")
        .when(held >= ultimate * MIN_ADEQUACY, "MARGINAL")
        .otherwise("DEFICIENT")
    )
    return summary.select(
        "as_of_date",
        "loss_type",
        ultimate.alias("estimated_ultimate_loss"),
        "held_reserves",
        F.when(ultimate > 0, F.try_divide(held, ultimate))
        .otherwise(F.lit(1.0))
        .alias("reserve_adequacy"),
        status.alias("adequacy_status"),
        "total_ibnr",
        (held - F.col("total_ibnr")).alias("reserve_margin"),
    )


def adequacy_of_held(estimates: DataFrame, held: DataFrame, by: str = "loss_type") -> DataFrame:
    """Adequacy of given held amounts (``by, held_reserves``) against fitted ultimates.

    A segment with an ultimate and nothing held stays, with 0 held.
    """
    totals = _totals(estimates, (by,)).join(held.select(by, "held_reserves"), by, "left")
    totals = totals.withColumn("held_reserves", F.coalesce("held_reserves", F.lit(0.0)))
    ultimate, amount = F.col("total_ultimate"), F.col("held_reserves")
    adequacy = F.when(ultimate > 0, F.try_divide(amount, ultimate)).otherwise(F.lit(1.0))
    return totals.select(
        by,
        "held_reserves",
        ultimate.alias("estimated_ultimate"),
        F.col("total_ibnr").alias("estimated_ibnr"),
        adequacy.alias("reserve_adequacy"),
        (amount - F.col("total_ibnr")).alias("reserve_margin"),
        adequacy_status(adequacy).alias("adequacy_status"),
    )


def ibnr_by_origin(estimates: DataFrame, places: int | None = 1) -> DataFrame:
    """Estimates under their reporting names; ``places=None`` leaves the percentage unrounded."""
    percent = F.col("percent_reported") * 100
    return estimates.select(
        F.col("origin_period").alias("origin_year"),
        "loss_type",
        F.lit("paid").alias("triangle_type"),
        F.col("latest_cumulative").alias("paid_to_date"),
        F.col("ultimate_loss").alias("projected_ultimate"),
        F.col("ibnr").alias("estimated_ibnr"),
        (percent if places is None else F.round(percent, places)).alias("percent_developed"),
    )


def risk_exposure(summary: DataFrame) -> DataFrame:
    return summary.select(
        "origin_year",
        "loss_type",
        "total_claims",
        "high_risk_claims",
        F.round("high_risk_pct", 1).alias("high_risk_percentage"),
        "total_incurred",
        F.col("high_risk_incurred").alias("high_risk_exposure"),
        F.round("high_risk_incurred_pct", 1).alias("high_risk_exposure_pct"),
        F.round("avg_risk_score", 3).alias("avg_risk_score"),
    )


def executive_dashboard(summary: DataFrame) -> DataFrame:
    factor = F.coalesce("ai_adjustment_factor", F.lit(1.0))
    return summary.select(
        "as_of_date",
        "loss_type",
        "total_paid",
        "total_ibnr",
        "total_ultimate",
        "held_reserves",
        "reserve_adequacy",
        "reserve_margin",
        "ai_adjustment_factor",
        (F.col("total_ibnr") * factor).alias("risk_adjusted_ibnr"),
        band(F.col("reserve_adequacy"), TRAFFIC_LIGHTS, "RED").alias("status_indicator"),
    )


def development_factor_view(factors: DataFrame) -> DataFrame:
    """Factors rounded for display."""
    return rounded(
        rounded(factors, 4, ["ata_factor", "cdf_to_ultimate"]), 1, ["percent_developed"]
    )


def claims_watchlist(classified: DataFrame) -> DataFrame:
    """High-risk claims with their score rounded."""
    return classified.filter("high_risk_flag").select(
        "claim_id",
        "loss_date",
        "origin_year",
        "loss_type",
        "county",
        "state",
        "claim_status",
        "risk_category",
        F.round("risk_score", 2).alias("risk_score"),
        "risk_keywords",
        "total_paid",
        "current_reserve",
        "incurred_amount",
        "adjuster_notes",
    )


def loss_ratio(
    incurred: DataFrame, premium: DataFrame, keys: tuple[str, ...] = ("origin_period", "loss_type")
) -> DataFrame:
    """Incurred losses over earned premium; ``premium`` has the keys and ``earned_premium``."""
    losses = incurred.groupBy(*keys).agg(F.sum("incurred_amount").alias("incurred_loss"))
    joined = losses.join(premium, list(keys), "left")
    return joined.withColumn("loss_ratio", ratio("incurred_loss", "earned_premium"))


# --- catalogue and alerts --------------------------------------------------------------------


class Metric(NamedTuple):
    """A named measure and the expression that computes it from its columns."""

    unit: str
    inputs: tuple[str, ...]
    expression: Column


def metric_catalogue() -> dict[str, Metric]:
    """The named metrics. Built on call, because expressions need a running session."""
    c = F.col
    return {
        "reserve_adequacy": Metric(
            "ratio",
            ("held_reserves", "total_ultimate"),
            ratio("held_reserves", "total_ultimate"),
        ),
        "ibnr": Metric(
            "currency",
            ("ultimate_loss", "latest_cumulative"),
            c("ultimate_loss") - c("latest_cumulative"),
        ),
        "loss_ratio": Metric(
            "percentage", ("incurred_loss", "earned_premium"), ratio("incurred_loss", "earned_premium")
        ),
        "development_factor": Metric(
            "ratio", ("next_value", "cumulative_value"), ratio("next_value", "cumulative_value")
        ),
        "reserve_margin": Metric(
            "currency", ("held_reserves", "total_ibnr"), c("held_reserves") - c("total_ibnr")
        ),
        "high_risk_exposure": Metric(
            "currency",
            ("high_risk_flag", "incurred_amount"),
            F.sum(F.when(c("high_risk_flag"), c("incurred_amount")).otherwise(F.lit(0.0))),
        ),
        "risk_adjusted_ibnr": Metric(
            "currency",
            ("total_ibnr", "ai_adjustment_factor"),
            c("total_ibnr") * F.coalesce("ai_adjustment_factor", F.lit(1.0)),
        ),
    }


# Bounds of the bands of the two metrics that have them.
ADEQUACY_BOUNDS = ((1.0, "adequate"), (0.85, "marginal"), (0.0, "deficient"))
LOSS_RATIO_BOUNDS = ((0.5, "excellent"), (0.65, "good"), (0.8, "fair"))


def band_of(metric: str, value: Column) -> Column:
    """The band of a value: adequacy by lower bounds, the loss ratio by upper bounds, else NULL."""
    band = F.lit(None).cast("string")
    if metric == "reserve_adequacy":
        for bound, label in reversed(ADEQUACY_BOUNDS):
            band = F.when(value >= bound, label).otherwise(band)
    elif metric == "loss_ratio":
        band = F.when(value.isNotNull(), "poor")
        for bound, label in reversed(LOSS_RATIO_BOUNDS):
            band = F.when(value <= bound, label).otherwise(band)
    return band


def metric_value(name: str, row: DataFrame) -> DataFrame:
    """One row (metric, unit, value, band) from the inputs the catalogue names for the metric."""
    metric = metric_catalogue()[name]
    measured = row.select(metric.expression.cast("double").alias("value"))
    return measured.select(
        F.lit(name).alias("metric"), F.lit(metric.unit).alias("unit"), "value", band_of(name, F.col("value")).alias("band")
    )


def summary_metrics(summary: DataFrame) -> DataFrame:
    """The catalogue's summary-level metrics as (metric, value) rows for each segment."""
    catalogue = metric_catalogue()
    names = ["reserve_adequacy", "reserve_margin", "risk_adjusted_ibnr"]
    measured = summary.select("loss_type", *[catalogue[n].expression.alias(n) for n in names])
    return measured.unpivot(["loss_type"], names, "metric", "value")


def alerts(
    summary: DataFrame,
    exposure: DataFrame,
    min_adequacy: float = MIN_ADEQUACY,
    max_exposure: float = MAX_HIGH_RISK_EXPOSURE,
) -> DataFrame:
    """Breached limits as rows. ``exposure`` is one row with ``high_risk_incurred``."""
    adequacy = summary.select(
        "loss_type",
        F.lit("reserve_adequacy").alias("metric"),
        F.col("reserve_adequacy").alias("value"),
        F.lit(float(min_adequacy)).alias("limit_value"),
    ).filter(F.col("value") < F.col("limit_value"))
    risk = exposure.select(
        F.lit("ALL").alias("loss_type"),
        F.lit("high_risk_exposure").alias("metric"),
        F.col("high_risk_incurred").alias("value"),
        F.lit(float(max_exposure)).alias("limit_value"),
    ).filter(F.col("value") > F.col("limit_value"))
    return adequacy.unionByName(risk)
