"""Report queries over the estimates, factors, cells and scored claims."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import band, count_when, money_text, percent_text, sum_when
from ..session import materialise
from .claims import older_than
from .metrics import adequacy_status
from .percentiles import grouped_median

LIGHTS = ("🟢", "🟡", "🔴")


def _rows(df: DataFrame, fields: tuple[str, ...], rows: list[tuple[Column, ...]]) -> DataFrame:
    """Turn each input row into several labelled output rows (one scan, no union)."""
    entries = [F.struct(*[c.alias(f) for f, c in zip(fields, row)]) for row in rows]
    return df.select(F.inline(F.array(*entries)))


# --- reserves --------------------------------------------------------------------------------


def kpi_counters(summary: DataFrame) -> DataFrame:
    """The headline numbers, plain and formatted."""
    extra_pct = F.round((F.col("ai_adjustment_factor") - 1) * 100, 1)
    return summary.select(
        money_text(F.col("total_ibnr")).alias("total_ibnr_formatted"),
        "total_ibnr",
        percent_text(F.round(F.col("reserve_adequacy") * 100, 1)).alias("adequacy_formatted"),
        "reserve_adequacy",
        adequacy_status(F.col("reserve_adequacy")).alias("status"),
        money_text(F.col("total_ultimate")).alias("ultimate_formatted"),
        "total_ultimate",
        extra_pct.alias("additional_reserve_pct"),
        percent_text(extra_pct, "+").alias("additional_reserve_formatted"),
        "ai_adjustment_factor",
    )


def executive_summary(summary: DataFrame) -> DataFrame:
    """Metric / value rows."""
    money = [
        ("Total Paid to Date", "total_paid"),
        ("Total IBNR Reserve", "total_ibnr"),
        ("Total Ultimate Loss", "total_ultimate"),
        ("Held Reserves", "held_reserves"),
        ("Reserve Margin", "reserve_margin"),
    ]
    rows = [(F.lit(label), money_text(F.col(column))) for label, column in money]
    adequacy = percent_text(F.round(F.col("reserve_adequacy") * 100, 1))
    rows.append((F.lit("Reserve Adequacy"), adequacy))
    return _rows(summary, ("metric", "value"), rows)


def adequacy_by_loss_type(adequacy_view: DataFrame) -> DataFrame:
    return adequacy_view.select(
        "loss_type",
        F.round(F.col("reserve_adequacy") * 100, 1).alias("adequacy_pct"),
        "adequacy_status",
        "estimated_ultimate_loss",
        "held_reserves",
        "reserve_margin",
    )


def origin_development(ibnr_view: DataFrame) -> DataFrame:
    """Paid, IBNR and developed / remaining share per origin."""
    developed = F.round("percent_developed", 1)
    return ibnr_view.select(
        "origin_year",
        "loss_type",
        "paid_to_date",
        "projected_ultimate",
        "estimated_ibnr",
        developed.alias("percent_developed"),
        (F.lit(100.0) - developed).alias("percent_remaining"),
    )


def factor_trend(factors: DataFrame) -> DataFrame:
    """Factors with a label for the development stage."""
    age = F.col("development_period")
    label = F.concat(
        F.lit("Period "), age.cast("string"), F.lit(" → "), (age + 1).cast("string")
    )
    return factors.select(
        "loss_type",
        label.alias("development_stage"),
        "development_period",
        F.round("ata_factor", 4).alias("ata_factor"),
        F.round("cdf_to_ultimate", 4).alias("cdf_to_ultimate"),
        F.round("percent_developed", 1).alias("percent_developed"),
    )


def heatmap_cells(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("cumulative_value").isNotNull()).select(
        "origin_period", "development_period", "cumulative_value"
    )


def segment_reserve_totals(estimates: DataFrame) -> DataFrame:
    """Totals per loss type with the number of origins and the mean developed share."""
    return estimates.groupBy("loss_type").agg(
        F.sum("latest_cumulative").alias("total_paid"),
        F.sum("ibnr").alias("total_ibnr"),
        F.sum("ultimate_loss").alias("total_ultimate"),
        F.count(F.lit(1)).alias("origin_years"),
        (F.avg("percent_reported") * 100).alias("avg_percent_developed"),
    )


def consistency_check(estimates: DataFrame, total_label: str = "ALL") -> DataFrame:
    """IBNR of the total rows against the sum of the segments."""
    is_total = F.col("loss_type") == total_label
    sums = estimates.agg(
        sum_when(is_total, "ibnr").alias("all_ibnr"),
        sum_when(~is_total, "ibnr").alias("parts_ibnr"),
    )
    return sums.withColumn("difference", F.round(F.col("all_ibnr") - F.col("parts_ibnr"), 2))


def boardroom(summary: DataFrame, findings: DataFrame) -> DataFrame:
    """One page of rows with a traffic light; both inputs are single rows."""
    green, yellow, red = LIGHTS
    adequacy, factor = F.col("reserve_adequacy"), F.col("ai_adjustment_factor")
    solvency = band(adequacy, [(1.0, green), (0.85, yellow)], red)
    loading = F.when(factor <= 1.1, green).when(factor <= 1.25, yellow).otherwise(red)
    rows = [
        (
            F.lit("Total Reserves Held"),
            money_text(F.col("held_reserves")),
            F.lit("Amount set aside for future claims"),
            solvency,
        ),
        (
            F.lit("Reserve Adequacy"),
            percent_text(F.round(adequacy * 100, 0)),
            F.lit("Held reserves vs estimated ultimate"),
            solvency,
        ),
        (
            F.lit("AI Risk Adjustment"),
            percent_text(F.round((factor - 1) * 100, 1), "+"),
            F.lit("Additional reserve for hidden risks"),
            loading,
        ),
        (
            F.lit("High Risk Claims"),
            F.col("high_risk_claims").cast("string"),
            F.lit("Claims flagged by AI for mold/litigation"),
            F.lit("⚠️"),
        ),
    ]
    both = summary.crossJoin(findings.select("high_risk_claims"))
    return _rows(both, ("metric", "value", "description", "status"), rows)


# --- claims and risk -------------------------------------------------------------------------


def claims_by_risk_category(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_category").agg(
        F.count(F.lit(1)).alias("claim_count"), F.sum("incurred_amount").alias("total_exposure")
    )


def high_risk_trend(exposure: DataFrame) -> DataFrame:
    """Risk exposure per origin year, weighted back from the loss-type rows."""
    yearly = exposure.groupBy("origin_year").agg(
        F.sum("total_claims").alias("total_claims"),
        F.sum("high_risk_claims").alias("high_risk_claims"),
        F.sum("total_incurred").alias("total_incurred"),
        F.sum("high_risk_exposure").alias("high_risk_exposure"),
    )
    claims_pct = F.try_divide(F.col("high_risk_claims"), F.col("total_claims")) * 100
    exposure_pct = F.try_divide("high_risk_exposure", "total_incurred") * 100
    return yearly.withColumns(
        {
            "high_risk_pct": F.round(claims_pct, 1),
            "high_risk_exposure_pct": F.round(exposure_pct, 1),
        }
    ).drop("total_incurred")


def risk_score_bucket(score: Column) -> Column:
    # The five bands of the histogram.
    return (
        F.when(score == 0, "0 - No Risk")
        .when(score < 0.3, "0.01-0.30 Low")
        .when(score < 0.5, "0.30-0.50 Medium")
        .when(score < 0.7, "0.50-0.70 High")
        .otherwise("0.70+ Critical")
    )


def risk_score_histogram(scored: DataFrame) -> DataFrame:
    return (
        scored.withColumn("risk_bucket", risk_score_bucket(F.col("risk_score")))
        .groupBy("risk_bucket")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.sum("incurred_amount").alias("total_exposure"),
        )
    )


def top_high_risk_claims(scored: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` riskiest claims; each task keeps its own top ``n`` before they are merged."""
    return (
        scored.filter("high_risk_flag")
        .select(
            "claim_id",
            "loss_date",
            "loss_type",
            "county",
            "risk_category",
            F.round("risk_score", 2).alias("risk_score"),
            "incurred_amount",
            "adjuster_notes",
        )
        .orderBy(F.desc("risk_score"), F.desc("incurred_amount"), "claim_id")
        .limit(n)
    )


def keyword_frequency(scored: DataFrame) -> DataFrame:
    return (
        scored.select(F.explode("risk_keywords").alias("keyword"))
        .groupBy("keyword")
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
    )


def claims_by_status(claims: DataFrame) -> DataFrame:
    return claims.groupBy("claim_status").agg(
        F.count(F.lit(1)).alias("claim_count"), F.sum("incurred_amount").alias("total_incurred")
    )


def claims_by_loss_type(claims: DataFrame) -> DataFrame:
    return claims.groupBy("loss_type").agg(
        F.count(F.lit(1)).alias("claim_count"),
        F.sum("incurred_amount").alias("total_incurred"),
        F.avg("incurred_amount").alias("avg_incurred"),
    )


def claims_by_place(scored: DataFrame) -> DataFrame:
    return (
        scored.filter(F.col("county").isNotNull())
        .groupBy("county", "state")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.sum("incurred_amount").alias("total_incurred"),
            count_when(F.col("high_risk_flag")).alias("high_risk_count"),
        )
    )


def age_bucket(days: Column) -> Column:
    # Upper day limits of the age bands.
    return (
        F.when(days <= 365, "0-12 months")
        .when(days <= 730, "13-24 months")
        .when(days <= 1095, "25-36 months")
        .when(days <= 1825, "37-60 months")
        .otherwise("60+ months")
    )


def open_claims_by_age(claims: DataFrame, as_of: dt.date) -> DataFrame:
    """Open claims per age band, oldest band last (``band_order``)."""
    days = F.date_diff(F.lit(as_of), "loss_date")
    order = (
        F.when(F.col("age_bucket") == "0-12 months", 1)
        .when(F.col("age_bucket") == "13-24 months", 2)
        .when(F.col("age_bucket") == "25-36 months", 3)
        .when(F.col("age_bucket") == "37-60 months", 4)
        .otherwise(5)
    )
    return (
        claims.filter(F.col("claim_status") == "Open")
        .withColumn("age_bucket", age_bucket(days))
        .groupBy("age_bucket")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.sum("incurred_amount").alias("total_incurred"),
        )
        .withColumn("band_order", order)
        .orderBy("band_order")
    )


def claims_by_catastrophe(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy(F.coalesce("catastrophe_code", F.lit("Non-CAT")).alias("catastrophe_code"))
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.sum("incurred_amount").alias("total_incurred"),
            sum_when(F.col("high_risk_flag"), "incurred_amount").alias("high_risk_incurred"),
        )
    )


def claim_size_trend(claims: DataFrame) -> DataFrame:
    """Count, mean, exact median and maximum of the incurred amount per origin year.

    The two columns are written once, because the median looks at them more than once.
    """
    claims = materialise(claims.select("origin_year", "incurred_amount"), "claim-sizes")
    stats = claims.groupBy("origin_year").agg(
        F.count(F.lit(1)).alias("claim_count"),
        F.avg("incurred_amount").alias("avg_incurred"),
        F.max("incurred_amount").alias("max_incurred"),
    )
    medians = grouped_median(claims, ["origin_year"], "incurred_amount", "median_incurred")
    return stats.join(medians, "origin_year", "left")


def segment_exposure(
    scored: DataFrame, loss_type: str, county: str, months: int, as_of: dt.date
) -> DataFrame:
    """Exposure of one loss type in one county for claims older than ``months`` months."""
    chosen = scored.filter((F.col("loss_type") == loss_type) & (F.col("county") == county))
    return older_than(chosen, months, as_of).agg(
        F.lit(f"{loss_type} - {county} ({months}+ months)").alias("segment"),
        F.count(F.lit(1)).alias("claim_count"),
        F.sum("incurred_amount").alias("total_exposure"),
        sum_when(F.col("high_risk_flag"), "incurred_amount").alias("high_risk_exposure"),
        F.avg("risk_score").alias("avg_risk_score"),
    )


def county_high_risk(scored: DataFrame, county: str) -> DataFrame:
    return scored.filter((F.col("county") == county) & F.col("high_risk_flag"))


def mold_claims(scored: DataFrame) -> DataFrame:
    """Claims of the water damage category or with a keyword that contains "mold"."""
    has_mold = F.exists("risk_keywords", lambda k: k.contains("mold"))
    return scored.filter((F.col("risk_category") == "water_damage") | has_mold)


def litigation_claims(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("risk_category") == "litigation")


def deficient_loss_types(adequacy_view: DataFrame) -> DataFrame:
    return adequacy_view.filter(F.col("adequacy_status") == "DEFICIENT")


def place_ranking(scored: DataFrame, level: str) -> DataFrame:
    """Exposure per county or state, largest first."""
    return (
        scored.groupBy(level)
        .agg(
            F.sum("incurred_amount").alias("total_exposure"),
            sum_when(F.col("high_risk_flag"), "incurred_amount").alias("high_risk_exposure"),
            F.count(F.lit(1)).alias("claim_count"),
        )
        .orderBy(F.desc("total_exposure"))
    )


# --- development reports ---------------------------------------------------------------------


def expectation_scatter(compared: DataFrame) -> DataFrame:
    """Points of the actual-versus-expected chart."""
    label = F.concat(
        F.lit("OY "), F.col("origin_period").cast("string"),
        F.lit(" Dev "), F.col("development_period").cast("string"),
    )
    return compared.filter(F.col("expected_value") > 0).select(
        "loss_type", "expected_value", "actual_value", label.alias("label"),
        "development_flag", "pct_deviation",
    )


def factor_ranges(diagnostics: DataFrame) -> DataFrame:
    """Factor with its range, variation in percent and a light for the stability flag."""
    age = F.col("development_period")
    label = F.concat(F.lit("Dev "), age.cast("string"), F.lit("→"), (age + 1).cast("string"))
    green, yellow, red = LIGHTS
    flag = F.col("stability_flag")
    light = F.when(flag == "STABLE", green).when(flag == "LIMITED_DATA", yellow).otherwise(red)
    return diagnostics.select(
        "loss_type",
        label.alias("development_age"),
        "development_period",
        F.col("ata_factor").alias("selected_ata"),
        F.col("ata_simple_avg").alias("simple_average"),
        "ata_min",
        "ata_max",
        "n_observations",
        F.round(F.col("cv") * 100, 1).alias("coefficient_of_variation_pct"),
        F.round("range_pct", 1).alias("range_as_pct_of_selected"),
        "stability_flag",
        light.alias("status_indicator"),
    )


def calendar_years_from(calendar: DataFrame, first_year: int = 2015) -> DataFrame:
    return calendar.filter(F.col("calendar_year") >= first_year).select(
        "calendar_year",
        F.round("total_incremental", 0).alias("total_emergence"),
        "n_origin_years",
        F.round("avg_incremental", 0).alias("avg_per_origin_year"),
    )


def exhibit_text(exhibit: DataFrame) -> DataFrame:
    """The exhibit with its percentages as text."""
    return exhibit.select(
        "loss_type",
        "development_age",
        "ata_selected",
        "ata_simple_avg",
        "ata_min",
        "ata_max",
        "cdf_to_ultimate",
        percent_text(F.col("pct_developed")).alias("pct_developed"),
        "n_observations",
        percent_text(F.col("cv_pct")).alias("cv_pct"),
        "selection_method",
    )
