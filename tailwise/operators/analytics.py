"""Reserve analytics built on the annotated cells and the estimates.

Each function derives its result from one input by windows or small arrays; the only joins are
with one-row scenario or per-origin assumption tables the caller supplies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import band, count_when, ratio, rounded
from .chainladder import SEGMENT, add_cdf, age_profile, ata_factors, reserve_estimates

# The standard tail scenarios.
TAIL_SCENARIOS = (
    ("No Tail", 1.00),
    ("Light Tail (2%)", 1.02),
    ("Moderate Tail (5%)", 1.05),
    ("Heavy Tail (10%)", 1.10),
    ("Very Heavy Tail (15%)", 1.15),
)


def actual_vs_expected(
    cells: DataFrame, by: Sequence[str] = SEGMENT, tolerance: float = 0.15
) -> DataFrame:
    """Each value against the value one age before × the factor of that age.

    Where the age before is a hole in the triangle nothing is expected, and the row is left out.
    """
    by_age = Window.partitionBy(*by).orderBy("development_period").rangeBetween(-1, -1)
    origin = Window.partitionBy(*by, "origin_period").orderBy("development_period")
    expected, actual = F.col("expected_value"), F.col("actual_value")
    compared = age_profile(cells, by).select(
        *by,
        "origin_period",
        "development_period",
        F.col("cumulative_value").alias("actual_value"),
        F.when(
            F.lag("development_period").over(origin) == F.col("development_period") - 1,
            F.lag("cumulative_value").over(origin) * F.max("ata_factor").over(by_age),
        ).alias("expected_value"),
    )
    deviation = F.try_divide(actual - expected, expected)
    unusual = F.coalesce(F.abs(deviation) > tolerance, F.lit(False))
    return compared.filter(expected.isNotNull()).withColumns(
        {
            "residual": actual - expected,
            "pct_deviation": F.when(expected > 0, deviation * 100).otherwise(F.lit(0.0)),
            "development_flag": F.when(unusual, "UNUSUAL").otherwise("NORMAL"),
        }
    )


def residuals_by_age(compared: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    return compared.groupBy(*by, "development_period").agg(
        F.avg("residual").alias("avg_residual"),
        F.avg("pct_deviation").alias("avg_pct_deviation"),
        F.count(F.lit(1)).alias("n_observations"),
        count_when(F.col("development_flag") == "UNUSUAL").alias("unusual_count"),
    )


def ata_diagnostics(factors: DataFrame) -> DataFrame:
    """Variation and range of the factors; high variability outranks limited data."""
    cv = ratio("ata_stddev", "ata_factor")
    flag = (
        F.when(cv > 0.1, "HIGH_VARIABILITY")
        .when(F.col("n_observations") < 3, "LIMITED_DATA")
        .otherwise("STABLE")
    )
    return factors.withColumns(
        {
            "cv": cv,
            "range_pct": ratio(F.col("ata_max") - F.col("ata_min"), F.col("ata_factor")) * 100,
            "stability_flag": flag,
        }
    )


def development_exhibit(links: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Rounded factor table with the selection method implied by the number of observations."""
    factors = add_cdf(ata_factors(links, by), by)
    age = F.col("development_period")
    method = band(
        F.col("n_observations"), [(5, "Volume Weighted"), (3, "Simple Average")], "Judgmental"
    )
    exhibit = factors.select(
        *by,
        "development_period",
        F.concat(age.cast("string"), F.lit(" to "), (age + 1).cast("string")).alias("development_age"),
        F.col("ata_factor").alias("ata_selected"),
        "ata_simple_avg",
        "ata_min",
        "ata_max",
        "cdf_to_ultimate",
        F.round("percent_developed", 1).alias("pct_developed"),
        "n_observations",
        F.round(ratio("ata_stddev", "ata_factor") * 100, 1).alias("cv_pct"),
        F.col("ata_stddev").alias("std_dev"),
        method.alias("selection_method"),
    )
    four_places = ["ata_selected", "ata_simple_avg", "ata_min", "ata_max", "cdf_to_ultimate", "std_dev"]
    return rounded(exhibit, 4, four_places)


def ibnr_runoff(
    cells: DataFrame, by: Sequence[str] = SEGMENT, tail: float = 1.0, floor: bool = True
) -> DataFrame:
    """Emergence of each origin's IBNR over its future ages.

    The pattern of a segment (one entry per age) travels as an array next to each origin and is
    unfolded to the ages still to come. A last row past the final age holds what the tail adds, so
    the emergence of an origin adds up to its IBNR before flooring.
    """
    segment = Window.partitionBy(*by)
    pattern = F.collect_list(
        F.when(
            F.col("leads_age"),
            F.struct(F.col("development_period").alias("age"), F.col("cdf_to_ultimate").alias("cdf")),
        )
    ).over(segment)
    profile = age_profile(cells, by, tail).withColumn("pattern", F.sort_array(pattern))
    beyond = F.struct(
        (F.max("development_period").over(segment) + 1).alias("age"), F.lit(1.0).alias("cdf")
    )
    profile = profile.withColumn("pattern", F.concat("pattern", F.array(beyond)))

    latest = F.col("cumulative_value")
    ultimate = latest * F.col("cdf_to_ultimate")
    origins = profile.filter("is_latest").select(
        *by,
        "origin_period",
        F.col("development_period").alias("current_age"),
        ultimate.alias("ultimate_loss"),
        (ultimate - latest).alias("ibnr"),
        F.col("pattern"),
    )
    if floor:
        origins = origins.filter(F.col("ibnr") > 0)
    steps = F.zip_with(
        F.slice("pattern", 2, F.size("pattern") - 1),
        F.slice("pattern", 1, F.size("pattern") - 1),
        lambda after, before: F.struct(
            after["age"].alias("age"),
            (1 / after["cdf"] - 1 / before["cdf"]).alias("emergence"),
            (1 / after["cdf"]).alias("emerged"),
        ),
    )
    ahead = F.filter(steps, lambda s: (s["age"] > F.col("current_age")) & (s["emergence"] != 0))
    unfolded = origins.select(
        *by, "origin_period", "ultimate_loss", "ibnr", F.explode(ahead).alias("step")
    )
    return unfolded.select(
        *by,
        "origin_period",
        F.col("step.age").alias("future_development_period"),
        (F.col("ultimate_loss") * F.col("step.emergence")).alias("projected_emergence"),
        "ibnr",
        "ultimate_loss",
        F.col("step.emergence").alias("incremental_emergence_pct"),
        F.col("step.emerged").alias("cumulative_emergence_pct"),
    )


def runoff_by_period(runoff: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    return (
        runoff.filter(F.col("projected_emergence") > 0)
        .groupBy(*by, "future_development_period")
        .agg(
            F.sum("projected_emergence").alias("total_emergence"),
            F.count_distinct("origin_period").alias("origin_years_contributing"),
        )
    )


def growth_curve_fit(cells: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Log-logistic growth curve fitted to the development pattern by least squares.

    The logit of the developed share is regressed on the log of the age (counted from 1): the
    slope is omega and theta = exp(-intercept / omega). Ages at or below a CDF of 1.001 are fully
    developed and carry no information.
    """
    segment = Window.partitionBy(*by)
    share = F.try_divide(F.lit(1.0), F.col("cdf_to_ultimate"))
    age = (F.col("development_period") + 1).cast("double")
    points = (
        age_profile(cells, by)
        .filter(F.col("leads_age") & F.col("ata_factor").isNotNull())
        .filter(F.col("cdf_to_ultimate") > 1.001)
        .select(
            *by,
            "development_period",
            age.alias("age"),
            share.alias("actual_pct_developed"),
            F.ln(age).alias("x"),
            F.ln(share / (1 - share + F.lit(0.001))).alias("y"),
        )
    )
    fitted = points.withColumns(
        {
            "omega_param": F.regr_slope("y", "x").over(segment),
            "intercept": F.regr_intercept("y", "x").over(segment),
        }
    ).withColumn("theta_param", F.exp(-F.try_divide("intercept", "omega_param")))
    grown = F.pow("age", "omega_param")
    curve = F.try_divide(grown, grown + F.pow("theta_param", "omega_param"))
    return fitted.select(
        *by,
        "development_period",
        "actual_pct_developed",
        curve.alias("fitted_pct_developed"),
        (F.col("actual_pct_developed") - curve).alias("residual"),
        "omega_param",
        "theta_param",
        F.lit("loglogistic").alias("curve_type"),
    )


def growth_curve_parameters(fit: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    return fit.groupBy(*by, "curve_type", "omega_param", "theta_param").agg(
        (F.avg(F.abs("residual")) * 100).alias("mean_abs_error_pct")
    )


def method_comparison(
    estimates: DataFrame, by: Sequence[str] = SEGMENT, mature: float = 0.9
) -> DataFrame:
    """Chain Ladder, Bornhuetter-Ferguson and Benktander ultimates side by side.

    The a-priori ultimate is the mean ultimate of the segment's mature origins.
    """
    reported = F.col("percent_reported")
    apriori = F.avg(F.when(reported > mature, F.col("ultimate_loss"))).over(Window.partitionBy(*by))
    prepared = estimates.withColumn("apriori_ultimate", apriori)
    bf_ibnr = (1 - reported) * F.col("apriori_ultimate")
    cl, bf = F.col("cl_ultimate"), F.col("bf_ultimate")
    compared = prepared.select(
        *by,
        "origin_period",
        F.col("latest_cumulative").alias("paid_to_date"),
        "percent_reported",
        "apriori_ultimate",
        F.col("ultimate_loss").alias("cl_ultimate"),
        F.col("ibnr").alias("cl_ibnr"),
        (F.col("latest_cumulative") + bf_ibnr).alias("bf_ultimate"),
        bf_ibnr.alias("bf_ibnr"),
    )
    return compared.withColumns(
        {
            "cl_bf_diff": cl - bf,
            "ibnr_diff": F.col("cl_ibnr") - F.col("bf_ibnr"),
            "benktander_ultimate": reported * cl + (1 - reported) * bf,
        }
    )


def method_totals(compared: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Total IBNR per method, one row each, from a single aggregation."""
    totals = compared.groupBy(*by).agg(
        F.sum("cl_ibnr").alias("Chain Ladder"),
        F.sum("bf_ibnr").alias("Bornhuetter-Ferguson"),
        (F.sum("benktander_ultimate") - F.sum("paid_to_date")).alias("Benktander"),
    )
    methods = ["Chain Ladder", "Bornhuetter-Ferguson", "Benktander"]
    return totals.unpivot(list(by), methods, "method", "total_ibnr")


def reserve_variability(
    cells: DataFrame, by: Sequence[str] = SEGMENT, tail: float = 1.0
) -> DataFrame:
    """Log-normal style range around each IBNR from the average variation of the factors."""
    segment = Window.partitionBy(*by)
    ages = Window.partitionBy(*by, "development_period")
    spread = F.stddev_samp("link_ratio").over(ages)
    profile = age_profile(cells, by, tail).withColumn(
        "age_cv", F.when(F.col("leads_age"), ratio(spread, F.col("ata_factor")))
    )
    cv = F.sqrt(F.avg(F.col("age_cv") * F.col("age_cv")).over(segment))
    latest = F.col("cumulative_value")
    ibnr = latest * F.col("cdf_to_ultimate") - latest
    chosen = (
        profile.withColumn("estimated_cv", cv)
        .filter("is_latest")
        .select(*by, "origin_period", ibnr.alias("ibnr_mid"), "estimated_cv")
        .filter(F.col("ibnr_mid") > 0)
    )
    mid, width = F.col("ibnr_mid"), F.col("estimated_cv")
    return chosen.withColumns(
        {
            "standard_error": mid * width,
            "ibnr_low_95": mid * F.exp(F.lit(-1.96) * width),
            "ibnr_75th_pct": mid * F.exp(F.lit(0.675) * width),
            "ibnr_high_95": mid * F.exp(F.lit(1.96) * width),
            "range_95": mid * (F.exp(F.lit(1.96) * width) - F.exp(F.lit(-1.96) * width)),
        }
    )


def variability_totals(variability: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    return variability.groupBy(*by).agg(
        F.round(F.sum("ibnr_low_95"), 0).alias("total_ibnr_low"),
        F.round(F.sum("ibnr_mid"), 0).alias("total_ibnr_point"),
        F.round(F.sum("ibnr_75th_pct"), 0).alias("total_ibnr_75th"),
        F.round(F.sum("ibnr_high_95"), 0).alias("total_ibnr_high"),
        F.round(F.sum("range_95"), 0).alias("total_uncertainty_range"),
    )


def tail_sensitivity(
    estimates: DataFrame,
    by: Sequence[str] = SEGMENT,
    scenarios: Sequence[tuple[str, float]] = TAIL_SCENARIOS,
) -> DataFrame:
    """Total IBNR under each tail factor. The scenarios ride along as a literal array."""
    options = F.array(
        *[
            F.struct(F.lit(name).alias("scenario"), F.lit(float(factor)).alias("tail_factor"))
            for name, factor in scenarios
        ]
    )
    totals = estimates.groupBy(*by).agg(F.sum("ibnr").alias("total_ibnr_base"))
    crossed = totals.select(*by, "total_ibnr_base", F.inline(options))
    base, factor = F.col("total_ibnr_base"), F.col("tail_factor")
    return crossed.withColumns(
        {
            "adjusted_ibnr": base * factor,
            "tail_ibnr_addition": base * (factor - 1),
            "pct_increase": (factor - 1) * 100,
        }
    )


def credibility_blend(
    estimates: DataFrame,
    credibility: DataFrame,
    default_z: float = 0.5,
    default_case_reserve: float = 99.0,
) -> DataFrame:
    """Blend of Chain Ladder and a damped alternative, weighted by z per origin.

    The alternative lies 12 % below Chain Ladder for an undeveloped origin, converges to it as the
    origin develops, and is never below 110 % of paid. ``credibility`` has ``origin_period, z,
    case_reserve``; origins it does not list get the defaults.
    """
    joined = estimates.join(credibility, "origin_period", "left")
    cl, paid = F.col("ultimate_loss"), F.col("latest_cumulative")
    damping = F.lit(1.0) - F.lit(0.12) * (F.lit(1.0) - F.col("percent_reported"))
    z = F.coalesce("z", F.lit(default_z))
    blended = joined.withColumns(
        {
            "case_reserve": F.coalesce("case_reserve", F.lit(default_case_reserve)),
            "credibility": z,
            "bf_ultimate": F.greatest(cl * damping, paid * F.lit(1.1)),
        }
    ).drop("z")
    weight = F.col("credibility")
    return blended.withColumn(
        "ultimate_reserve", weight * cl + (1 - weight) * F.col("bf_ultimate")
    ).withColumn("ibnr_reserve", F.col("ultimate_reserve") - paid - F.col("case_reserve"))


def add_manual_reserve(blended: DataFrame, adjustments: DataFrame) -> DataFrame:
    """Add a manual amount per origin (``origin_period, additional``) to ultimate and IBNR."""
    joined = blended.join(adjustments, "origin_period", "left")
    extra = F.coalesce("additional", F.lit(0.0))
    return joined.withColumn("additional", extra).withColumns(
        {
            "total_ultimate": F.col("ultimate_reserve") + F.col("additional"),
            "total_ibnr": F.col("ibnr_reserve") + F.col("additional"),
        }
    )


def estimates_for_tails(
    cells: DataFrame, tail: float, by: Sequence[str] = SEGMENT
) -> DataFrame:
    """Estimates refitted with a tail factor, labelled with it."""
    return reserve_estimates(cells, by, tail).withColumn("tail_factor", F.lit(float(tail)))
